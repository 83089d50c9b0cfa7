"""Ranked lexical search by one automaton over all query items' terms.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, A-Z
lowered.  All terms of the items, each between two boundaries, make one
Aho-Corasick automaton.  It is broadcast and run over the documents' texts, in
which every other character has become a boundary, so its matches are whole terms
and are counted as the text goes by; no index of the documents is built.

1. The scan writes of each document its number of terms and the (term, tf) of the
   automaton's terms it holds.
2. Spark adds up N, L and the terms' document frequencies.
3. A second pass over those counts maps terms to items, adds up each document's
   integer scores by item, and keeps a task's best ``top`` of each item; the best of
   all tasks are ranked in two steps.

With N documents that hold a term, L terms in all, n terms in the document and df
documents with the term: weight w = floor(1000 ln((2N+2)/(2df+1))), length
m = 10 + (90 n N) div L, score = sum of w ((10^9 tf) div (1000 tf + 8 m)).

Items are taken in parts of ``part_bytes`` of text, one automaton and one pass each, so
what is broadcast is bounded whatever the number of items.

Defined results: null texts have no terms; items without terms, or of which no
document holds a term of positive weight, give no row; rows with equal item ids
are one item with the terms of all; each document row is ranked for itself, also
with an equal or a null id (ascending ids, null last); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm.common import LOWER, distinct, text_slices, word_spans, written

TOP = 10
#: Bytes of item texts whose automaton is broadcast at once.
PART_BYTES = 4 << 20
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BOUNDARY = 32
#: Bytes as the automaton reads them: terms lowered, all else a boundary.
_READ = np.where(_TERM, LOWER, _BOUNDARY).astype(np.uint8)
_SLICE, _SALTS = 1 << 20, 64


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, as the automaton reads them: UTF-8 bytes, one character each."""
    return bytes(_READ[np.frombuffer((text or "").encode(), np.uint8)]).decode("latin-1").split(" ")


class ItemTerms:
    """The distinct terms of a part of the items, and the items of each term."""

    def __init__(self, items: list[tuple[object, str | None]]):
        owners: dict[str, set[int]] = {}
        places: dict[object, int] = {}
        for item, text in items:
            place = places.setdefault(item, len(places))
            for term in terms_of(text):
                if term:
                    owners.setdefault(term, set()).add(place)
        self.items = list(places)
        self.terms = sorted(owners)
        counts = [len(owners[t]) for t in self.terms]
        #: Items of term t: owners[bounds[t]:bounds[t + 1]].
        self.bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.owners = np.array([i for t in self.terms for i in sorted(owners[t])], np.int64)

    def automaton(self) -> ahocorasick.Automaton:
        """Built in the tasks: the terms are smaller than their automaton."""
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word(f" {term} ", number)
        found.make_automaton()
        return found


def term_counts(automaton: ahocorasick.Automaton, kinds: int, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """n of each row, and (row, term, tf) by row and term."""
    rows = len(bounds) - 1
    _, _, row = word_spans(data, bounds, _TERM)
    # a boundary before each row and at the end: no term reaches into the next row
    text = np.insert(_READ[data], bounds, _BOUNDARY)
    starts = bounds[:-1] + np.arange(rows)
    flat = np.fromiter(itertools.chain.from_iterable(automaton.iter(text.tobytes().decode("latin-1"))), np.int64) if kinds else np.zeros(0, np.int64)
    # a match ends on the boundary after its term
    place = np.searchsorted(starts, flat[::2] - 1, "right") - 1
    key, tf = distinct(place * max(kinds, 1) + flat[1::2])
    return np.bincount(row, minlength=rows), key // max(kinds, 1), key % max(kinds, 1), tf


def matched_terms(documents: DataFrame, terms, key: str, text: str) -> DataFrame:
    """(key, n, terms, tfs) of every document that has a term; ``terms`` is a broadcast :class:`ItemTerms`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, automaton = len(terms.value.terms), terms.value.automaton()
        for rows, data, bounds in text_slices(batches, "text", _SLICE):
            n, row, term, tf = term_counts(automaton, kinds, data, bounds)
            edges = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
            out = pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(edges, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(edges, pa.array(tf, pa.int64()))], names=["key", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, n long, terms array<int>, tfs array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _best(found: pa.Table, top: int) -> pa.Table:
    """The ``top`` rows of each item, highest scores and then least keys first (null last)."""
    found = found.take(pa.compute.sort_indices(found, sort_keys=[("item", "ascending"), ("score", "descending"), ("key", "ascending")]))
    item = found.column("item").to_numpy()
    first = np.searchsorted(item, item, "left")
    return found.filter(pa.array(np.arange(len(item)) - first < top))


def _scored(matched: DataFrame, terms, weights, documents: int, length: int, top: int) -> DataFrame:
    """(item, key, score): a task's best documents of each item."""
    kind = matched.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = terms.value, weights.value
        items = len(own.items)
        best: pa.Table | None = None
        bar = np.zeros(items, np.int64)  # a document must reach it to be among the task's best so far
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n = batch.column(1).to_numpy()
                term, tf = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
                sizes = batch.column(2).value_lengths().to_numpy()
                row = np.repeat(np.arange(len(n)), sizes)
                m = 10 + 90 * n * documents // length
                part = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                spread = np.diff(own.bounds)[term]
                offset = np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
                item = own.owners[np.repeat(own.bounds[term], spread) + offset]
                place = np.repeat(row, spread) * items + item
                if not len(place):
                    continue
                order = np.argsort(place)
                place = place[order]
                first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                pair, score = place[first], np.add.reduceat(np.repeat(part, spread)[order], first)
                good = (score > 0) & (score >= bar[pair % items])
                if not good.any():
                    continue
                found = pa.table({"item": (pair[good] % items).astype(np.int32), "key": batch.column(0).take(pa.array(pair[good] // items)), "score": score[good]})
                best = _best(found if best is None else pa.concat_tables([best, found]), top)
                held = best.column("item").to_numpy()
                full = np.searchsorted(held, np.arange(items), "right") - np.searchsorted(held, np.arange(items), "left") >= top
                last = np.searchsorted(held, np.flatnonzero(full), "right") - 1
                bar[full] = best.column("score").to_numpy()[last]
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return matched.mapInArrow(run, f"item int, key {kind}, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """(item, rank, key, score): the best of all tasks; first by a salt, so that no task gets all of an item."""
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("key", "score"), F.lit(_SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
            .select("item", "rank", "key", "score"))


def rank_documents(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                   item_text: str = "text", top: int = TOP, part_bytes: int = PART_BYTES) -> DataFrame:
    """(item, rank, key, score): the ``top`` highest-scoring documents of each item."""
    spark = documents.sparkSession
    asked = items.select(F.col(item).alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-int(size) // part_bytes))
    out = None
    for part in range(parts):
        # all rows of an item fall into one part
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part) if parts > 1 else asked
        known = ItemTerms([(r["item"], r["text"]) for r in own.collect()])
        terms = spark.sparkContext.broadcast(known)
        matched = written(matched_terms(documents, terms, key, text), "search-terms")
        total, length = matched.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # at most one row for each of the part's terms
        df = matched.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = np.zeros(len(known.terms), np.int64)
        for r in df:
            weights[r["term"]] = weight(total, r["df"])
        ranked = _ranked(_scored(matched, terms, spark.sparkContext.broadcast(weights), total, length, top), top)
        kind = items.schema[item].dataType.simpleString()
        names = spark.createDataFrame([(i, x) for i, x in enumerate(known.items)], f"place int, item {kind}")
        ranked = ranked.withColumnRenamed("item", "place").join(F.broadcast(names), "place").select("item", "rank", "key", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out
