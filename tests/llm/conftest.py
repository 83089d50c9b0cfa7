import pytest

LONG = "word " * 40_000


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one-word, very long and repeated texts, and ties."""
    return [None, "", " \n\t", "one", "Ünïcode ﬁ 日本語 😀 text", LONG, "same text here for all of us", "same text here for all of us",
            "a\x00b <s></s> ▁ ", "x" * 3000]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_texts):
    """The odd texts under ids with a null and a repeated row, and columns named like results."""
    rows = [(i if i != 3 else None, t, "src", "clash", 7.0) for i, t in enumerate(odd_texts)]
    rows.append(rows[6])
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score string, removed_spans double")
