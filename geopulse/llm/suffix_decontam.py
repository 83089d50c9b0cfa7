"""Benchmark decontamination with suffix arrays of the training text.

Each shard of the training documents (a slice of a partition) gets a suffix
array over its words: the sorted ten-word prefixes of its suffixes.  Suffixes
whose first two words stand together nowhere in the benchmark can't begin a
match and are left out.  Every test suffix is binary-searched in the array; the
equal range gives all verbatim matches and their places.  Matches of successive suffixes
of an item at successive places continue each other: joined, they are the longest
verbatim matches, each with its place in the document and in the item.

The benchmark's index goes to the tasks; its size is checked first, and a larger
benchmark is worked through in parts of bounded size, one pass each, so results
do not depend on its size.

Words: bytes 0-9, a-z (A-Z lowered) and non-ASCII characters.  A window is ten
consecutive words of an item; an item of fewer words, but not none, is a window.

Defined results: null texts have no words; equal items count each under its id;
a null item id is the empty string; repeated rows are handled alone; an empty
benchmark hits nothing; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import LOWER, SpanHash, text_slices, utf8, word_spans, written

WINDOW = 10
#: Bytes of benchmark text whose index one pass holds in a task.
PART_BYTES = 16 << 20
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word."""
    lower = LOWER[data]
    start, end, row = word_spans(lower, bounds, _WORD)
    return SpanHash(lower, 11).of(start, end), row


def _prefixes(ids: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The next WINDOW word ids from each position as comparable byte strings (0 past the row)."""
    out = np.zeros((len(at), WINDOW), ">u4")
    for k in range(WINDOW):
        inside = at + k < len(ids)
        here = at[inside] + k
        out[inside, k] = np.where(row[here] == row[at[inside]], ids[here], 0)
    return out.view(f"S{4 * WINDOW}").ravel()


@dataclass
class BenchmarkIndex:
    """Distinct windows of a part of the benchmark."""

    vocabulary: np.ndarray  # sorted word hashes; a word's id is its place + 1
    pairs: np.ndarray  # sorted ids of two adjacent words
    lone: np.ndarray  # ids of one-word items
    windows: np.ndarray  # sorted distinct prefixes
    lengths: np.ndarray  # words in each window
    items: list[list[int]]  # items of each window, as places in names
    names: list[str]
    places: list[list[tuple[int, int]]]  # (item, word) of every occurrence of each window

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)


def build_index(items: list[tuple[str, str]]) -> BenchmarkIndex:
    """Index of (item id, text) pairs."""
    data, bounds = utf8(pa.array([t for _, t in items], pa.large_string()))
    hashes, row = words_of(data, bounds)
    index = BenchmarkIndex(np.unique(hashes), np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, f"S{4 * WINDOW}"),
                           np.zeros(0, np.int64), [], [i for i, _ in items], [])
    if not len(hashes):
        return index
    ids = index.ids(hashes)
    left = np.flatnonzero(row[1:] == row[:-1])
    index.pairs = np.unique((ids[left].astype(np.uint64) << np.uint64(32)) | ids[left + 1])
    count = np.bincount(row, minlength=len(items))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    offset = np.arange(len(ids)) - first[row]
    begin = np.flatnonzero((offset + WINDOW <= count[row]) | ((offset == 0) & (count[row] < WINDOW)))
    index.lone = np.unique(ids[begin[count[row[begin]] == 1]])
    keys = _prefixes(ids, row, begin)
    index.windows, which = np.unique(keys, return_inverse=True)
    index.lengths = np.zeros(len(index.windows), np.int64)
    index.lengths[which] = np.minimum(count[row[begin]], WINDOW)
    index.places = [[] for _ in index.windows]
    for w, i, word in zip(which.tolist(), row[begin].tolist(), offset[begin].tolist(), strict=True):
        index.places[w].append((i, word))
    index.items = [sorted({i for i, _ in x}) for x in index.places]
    return index


def suffix_array(ids: np.ndarray, row: np.ndarray, index: BenchmarkIndex) -> tuple[np.ndarray, np.ndarray]:
    """Sorted prefixes of the suffixes that can match, and their positions."""
    following = np.zeros(len(ids), np.uint64)
    same = np.flatnonzero(row[1:] == row[:-1])
    following[same] = ids[same + 1]
    pair = (ids.astype(np.uint64) << np.uint64(32)) | following
    able = np.zeros(len(ids), bool)
    if len(index.pairs):
        at = np.minimum(np.searchsorted(index.pairs, pair), len(index.pairs) - 1)
        able = index.pairs[at] == pair
    if len(index.lone):
        able |= np.isin(ids, index.lone)
    places = np.flatnonzero(able & (ids > 0))
    keys = _prefixes(ids, row, places)
    order = np.argsort(keys, kind="stable")
    return keys[order], places[order]


def search(keys: np.ndarray, index: BenchmarkIndex) -> tuple[np.ndarray, np.ndarray]:
    """The range of the suffix array that begins with each window."""
    low = np.searchsorted(keys, index.windows, "left")
    above = index.windows.copy()
    for length in np.unique(index.lengths[index.lengths < WINDOW]):
        short = index.lengths == length
        raw = np.array(above[short]).view(np.uint8).reshape(-1, 4 * WINDOW).copy()
        raw[:, 4 * length:] = 255
        above[short] = raw.view(f"S{4 * WINDOW}").ravel()
    return low, np.searchsorted(keys, above, "right")


def _longest(at: list[int], of: list[tuple[int, int, int]], first: np.ndarray, row: np.ndarray) -> dict[int, dict[int, tuple[int, int, int]]]:
    """By row and item the longest match (words, first word, first word in the item; ties: the first place), from
    the words ``at`` which windows were found and their (item, word, words)."""
    runs: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for p, (item, word, words) in zip(at, of, strict=True):
        runs.setdefault((item, p - word), []).append((p, word, words))
    best: dict[int, dict[int, tuple[int, int, int]]] = {}
    for (item, _), found in runs.items():  # windows on one diagonal are at successive places in both texts
        found.sort()
        start, end, word = found[0][0], found[0][0] + found[0][2], found[0][1]
        matches = []
        for p, w, words in found[1:]:
            if p > end - words + 1 or row[p] != row[start]:
                matches.append((start, end, word))
                start, word = p, w
            end = p + words
        for a, b, w in [*matches, (start, end, word)]:
            r = int(row[a])
            match = (b - a, a - int(first[r]), w)
            known = best.setdefault(r, {}).get(item)
            if known is None or (-match[0], *match[1:]) < (-known[0], *known[1:]):
                best[r][item] = match
    return best


def _hits(data: np.ndarray, bounds: np.ndarray, index: BenchmarkIndex) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]], list[list[dict]]]:
    """Words, maximal hit spans (first word, words), hit items and their longest matches of each row."""
    rows = len(bounds) - 1
    hashes, row = words_of(data, bounds)
    count = np.bincount(row, minlength=rows)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    items: list[set[str]] = [set() for _ in range(rows)]
    longest: list[list[dict]] = [[] for _ in range(rows)]
    keys, places = suffix_array(index.ids(hashes), row, index)
    low, high = search(keys, index)
    found = np.flatnonzero(high > low)
    if len(found):
        change = np.zeros(len(hashes) + 1, np.int64)
        seen: list[int] = []
        seen_as: list[tuple[int, int, int]] = []
        for w in found.tolist():
            at = places[low[w]:high[w]]
            np.add.at(change, at, 1)
            np.add.at(change, at + index.lengths[w], -1)
            names = [index.names[i] for i in index.items[w]]
            for item, word in index.places[w]:
                seen.extend(at.tolist())
                seen_as.extend([(item, word, int(index.lengths[w]))] * len(at))
            for r in np.unique(row[at]).tolist():
                items[r].update(names)
        hit = np.cumsum(change[:-1]) > 0
        first = np.concatenate([[0], np.cumsum(count)])
        edge = np.zeros(len(hit), bool)
        edge[first[:-1][count > 0]] = True
        start = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
        stop_edge = np.concatenate([edge[1:], [True]])
        stop = np.flatnonzero(hit & (stop_edge | ~np.concatenate([hit[1:], [False]]))) + 1
        for a, b in zip(start.tolist(), stop.tolist(), strict=True):
            spans[row[a]].append((a - int(first[row[a]]), b - a))
        for r, found_in in _longest(seen, seen_as, first, row).items():
            longest[r] = sorted(({"item": index.names[i], "start": a, "item_start": w, "words": n} for i, (n, a, w) in found_in.items()),
                                key=lambda m: (m["item"], m["item_start"]))
    return count, spans, [sorted(x) for x in items], longest


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, length in sorted([*a, *b]):
        if out and start <= out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], start + length - out[-1][0]))
        else:
            out.append((start, length))
    return out


_SPANS = "array<struct<start:int,words:int>>"
_MATCHES = "array<struct<item:string,start:int,item_start:int,words:int>>"
_RESULTS = ("n_words", "hit_spans", "hit_items", "longest_matches")


def find_matches(documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                 item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """``documents`` with ``n_words``, ``hit_spans`` (maximal spans of words inside matches),
    ``hit_items`` (ids of items with matches, as strings) and ``longest_matches`` (of each of these: first
    word in the document and in the item, and words); columns of these names are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = documents.sparkSession
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 16)).first()[0] or 0
    parts = max(1, -(-int(size) // part_bytes))
    out = documents.drop(*_RESULTS).withColumns({
        "n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast(_SPANS), "hit_items": F.array().cast("array<string>"),
        "longest_matches": F.array().cast(_MATCHES)})
    schema = out.schema
    arrow = to_arrow_schema(schema)
    kinds = {f.name: f.type for f in arrow}
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part) if parts > 1 else items
        index = spark.sparkContext.broadcast(build_index([(r[0], r[1]) for r in own.collect()]))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for rows, data, bounds in text_slices(batches, text):
                count, spans, names, longest = _hits(data, bounds, index.value)
                before = [rows.column(rows.schema.get_field_index(n)).to_pylist() for n in _RESULTS[1:]]
                spans = [_union([(s["start"], s["words"]) for s in a], b) for a, b in zip(before[0], spans, strict=True)]
                names = [sorted({*a, *b}) for a, b in zip(before[1], names, strict=True)]
                new = {"n_words": pa.array(count, pa.int64()),
                       "hit_spans": pa.array([[{"start": s, "words": n} for s, n in x] for x in spans], kinds["hit_spans"]),
                       "hit_items": pa.array(names, kinds["hit_items"]),
                       "longest_matches": pa.array([[*a, *b] for a, b in zip(before[2], longest, strict=True)], kinds["longest_matches"])}
                yield pa.RecordBatch.from_arrays([new.get(n, rows.column(i)) for i, n in enumerate(rows.schema.names)], names=rows.schema.names)

        out = out.mapInArrow(run, schema)
        if part + 1 < parts:  # one part's index at a time
            out = written(out, "decontam")
    return out


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """The documents without any match."""
    return find_matches(documents, benchmark, **columns).where(F.size("hit_spans") == 0).drop(*_RESULTS)
