"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing turns each symbol into a small label that depends on
a few symbols before it only; the labels' local maxima cut the sequence into
phrases of two to a few symbols, runs of one symbol being cut by a rule of their
own.  Each phrase gets a name (a hash of its content), and the sequence of names
is parsed again.  Phrases inside equal substrings have equal names wherever the
substrings stand, except near their ends.

A fingerprint is a fixed number of slots, each the least of a slot's hashes of
the text's phrase names at two levels (short phrases and long ones); likeness is
the share of equal slots.

Defined results: null and empty texts have no phrases and the empty fingerprint
(alike only to another empty one); texts of any length are parsed whole; ties
and repeated rows get equal fingerprints; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm.common import SpanHash, mix, parallelism, row_slices, seeds, utf8, written

#: Slots for the names of the second and of the third level.
SHORT_SLOTS, LONG_SLOTS = 16, 48
_SLICE = 1 << 20


def _coin_table(size: int) -> np.ndarray:
    """label[previous, own] = 2 * lowest differing bit + own's bit there (equal symbols: 0)."""
    own, previous = np.meshgrid(np.arange(size), np.arange(size))
    different = own ^ previous
    bit = np.zeros_like(different)
    for i in range(15, -1, -1):
        bit[(different >> i) & 1 == 1] = i
    return np.where(different == 0, 0, 2 * bit + ((own >> bit) & 1)).astype(np.uint8)


_BYTES = _coin_table(256)


def _first_labels(symbols: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Coin labels of the symbols against the one before (at a head: against 0)."""
    previous = np.empty_like(symbols)
    previous[1:] = symbols[:-1]
    previous[head] = 0
    if symbols.dtype == np.uint8:
        return _BYTES[previous, symbols]
    different = symbols ^ previous
    lowest = different & (~different + np.uint64(1))
    bit = np.zeros(len(symbols), np.uint8)
    some = lowest != 0
    bit[some] = np.log2(lowest[some].astype(np.float64)).astype(np.uint8)
    return np.where(some, 2 * bit + ((symbols >> bit) & np.uint64(1)).astype(np.uint8), 0).astype(np.uint8)


def cut_points(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions where a phrase starts, the starts of non-empty rows among them."""
    n = len(symbols)
    rows = bounds[:-1][bounds[1:] > bounds[:-1]]
    head = np.zeros(n, bool)
    head[rows] = True
    label = _first_labels(symbols, head)
    for _ in range(2):
        previous = np.empty_like(label)
        previous[1:] = label[:-1]
        previous[head] = 0
        label = _BYTES[previous, label]
    # a phrase starts where labels peak, or at the first symbol of a run
    last = np.zeros(n, bool)
    last[:-1] = head[1:]
    last[-1] = True
    left = np.empty_like(label)
    left[1:] = label[:-1]
    right = np.empty_like(label)
    right[:-1] = label[1:]
    same = np.zeros(n, bool)
    same[1:] = (symbols[1:] == symbols[:-1]) & ~head[1:]
    peak = (label > left) & (label >= right) & ~head & ~last & ~same
    run_start = np.zeros(n, bool)
    run_start[:-1] = same[1:] & ~same[:-1]
    run_end = np.zeros(n, bool)
    run_end[1:] = ~same[1:] & same[:-1]
    cut = head | peak | run_start | run_end
    # neighbours never both start a phrase, but at heads and runs: the later peak yields
    near = np.zeros(n, bool)
    near[1:] = cut[:-1]
    return np.flatnonzero(cut & ~(peak & near & ~run_start & ~run_end))


def _names(symbols: np.ndarray, cuts: np.ndarray, level: int) -> np.ndarray:
    """Hashes of the phrases."""
    ends = np.append(cuts[1:], len(symbols))
    if symbols.dtype == np.uint8:
        return SpanHash(symbols, 100).of(cuts, ends)
    # the place in the phrase enters by a multiplier
    place = (np.arange(len(symbols)) - np.repeat(cuts, ends - cuts)).astype(np.uint64)
    mixed = mix(symbols * (mix(place + np.uint64(level * 1000 + 1)) | np.uint64(1)))
    return mix(np.add.reduceat(mixed, cuts) + (ends - cuts).astype(np.uint64))


def parse(data: np.ndarray, bounds: np.ndarray, levels: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """(names, row boundaries) of the phrases of each level."""
    out, symbols = [], data
    for level in range(levels):
        if not len(symbols):
            out.append((np.zeros(0, np.uint64), bounds))
            continue
        cuts = cut_points(symbols, bounds)
        symbols, bounds = _names(symbols, cuts, level), np.searchsorted(cuts, bounds)
        out.append((symbols, bounds))
    return out


_SEEDS = seeds(SHORT_SLOTS + LONG_SLOTS, 5)


def fingerprints(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Slots (one byte pair each) of every text; zero for a text without phrases."""
    rows = len(bounds) - 1
    out = np.zeros((rows, SHORT_SLOTS + LONG_SLOTS), np.uint16)
    levels = parse(data, bounds)
    for (names, at), first, last in ((levels[1], 0, SHORT_SLOTS), (levels[2], SHORT_SLOTS, SHORT_SLOTS + LONG_SLOTS)):
        full = np.flatnonzero(at[1:] > at[:-1])
        if not len(full):
            continue
        for slot in range(first, last):
            least = np.minimum.reduceat(mix_lightly(names, _SEEDS[slot]), at[full])
            out[full, slot] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def mix_lightly(names: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A different order of the (already mixed) names for each seed."""
    x = (names ^ seed) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def likeness(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    """Share of equal slots."""
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), (a == b).mean(axis=1))


def _hex(slots: np.ndarray, empty: np.ndarray) -> list[str]:
    raw = slots.astype(">u2").tobytes()
    width = 2 * slots.shape[1]
    return ["" if e else raw[i * width:(i + 1) * width].hex() for i, e in enumerate(empty)]


def _of_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = utf8(pa.array(texts, pa.large_string()))
    parts = [fingerprints(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]) for i, j in row_slices(bounds, _SLICE)]
    slots = np.concatenate(parts) if parts else np.zeros((0, SHORT_SLOTS + LONG_SLOTS), np.uint16)
    return slots, bounds[1:] == bounds[:-1]


def fingerprint_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                slots, empty = _of_texts([x or "" for x in rows.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(_hex(slots, empty), pa.string())], names=["key", "fingerprint"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, fingerprint string")


def edited(own: str, following: str) -> str:
    """The last quarter of a text's code points replaced by the first as many of another's."""
    quarter = len(own) // 4
    return own[:len(own) - quarter] + following[:quarter]


_COMPARED = ("key long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def _compare(keys: list, texts: list[str], following: list[str], digest: bool) -> pa.RecordBatch:
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    slots, empty = _of_texts([*texts, *following[-1:]])
    new, new_empty = _of_texts(changed)
    own, own_empty = slots[:-1], empty[:-1]
    if digest:
        changed = [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(changed, pa.string()),
         pa.array(_hex(own, own_empty), pa.string()), pa.array(_hex(new, new_empty), pa.string()),
         pa.array(likeness(own, new, own_empty, new_empty)), pa.array(likeness(own, slots[1:], own_empty, empty[1:]))],
        names=[x.split()[0] for x in _COMPARED.split(", ")])


def compare_neighbours(df: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Each text with its edited text (see :func:`edited`) and the next document's, by ascending key
    (equal keys: by a hash of the text, then by the text; after the last row comes the first), and the fingerprints' likeness.

    One range partitioning; a partition's last row meets the next partition's
    first row in a table of two rows for each partition.  With ``digest`` the column
    ``edited`` holds the SHA-256 of the edited text instead of the text itself.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # cut and sorted by the same columns, so the order is the same for any number of partitions
    rows = (rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(parallelism(df.sparkSession), "key", "hash")
            .sortWithinPartitions("key", "hash", "text").drop("hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compares all but the partition's last row; passes the ends on in columns of their own."""
        held: tuple | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                if held is None:
                    yield _with_ends(None, [(keys[0], texts[0], True)])
                else:
                    keys, texts = [held[0], *keys], [held[1], *texts]
                if len(keys) > 1:
                    yield _with_ends(_compare(keys[:-1], texts[:-1], texts[1:], digest), [])
                held = keys[-1], texts[-1]
        if held is not None:
            yield _with_ends(None, [(*held, False)])

    both = f"{_COMPARED}, end_text string, first boolean"
    done = written(rows.mapInArrow(run, both).withColumn("part", F.spark_partition_id()), "fingerprints")
    ends = done.where("first is not null").select("part", "key", F.col("end_text").alias("text"), "first")
    # each partition's last row with the first row of the next partition that has one
    parts = ends.where("first").select("part")  # one row for each partition that has rows
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    links = parts.select("part", following.alias("next_part"))
    firsts = ends.where("first").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    pairs = ends.where("not first").join(links, "part").join(firsts, "next_part").select("key", "text", "next_text")

    def last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _compare([k], [a], [b], digest)

    return done.where("first is null").drop("end_text", "first", "part").union(pairs.mapInArrow(last_rows, _COMPARED))


def _with_ends(compared: pa.RecordBatch | None, ends: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _COMPARED.split(", ")]
    if compared is not None:
        n = compared.num_rows
        return pa.RecordBatch.from_arrays([*compared.columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_())],
                                          names=[*names, "end_text", "first"])
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = [pa.nulls(len(ends), k) for k in kinds]
    columns[0] = pa.array([e[0] for e in ends], pa.int64())
    return pa.RecordBatch.from_arrays([*columns, pa.array([e[1] for e in ends], pa.string()), pa.array([e[2] for e in ends], pa.bool_())],
                                      names=[*names, "end_text", "first"])
