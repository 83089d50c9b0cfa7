"""Training-data operators: tokenising, deduplication, extraction, scoring, archives."""
