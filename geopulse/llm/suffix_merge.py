"""Exact substring deduplication by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Sorting every suffix would move the text many times over, so suffixes are
taken at anchors: the least of the hashed 16-byte strings in each of a window's
first ``window`` positions.  Equal strings have equal anchors at equal places,
so a repeated string is found where its anchor's suffixes meet:

1. Anchors are counted by a hash of the bytes that every string with this anchor
   shares; anchors that occur once are done.
2. Anchors with equal surroundings (all strings that can hold them) become one entry
   with a count.  A class of one such entry needs no order: all its strings are repeated.
3. The suffixes of the other classes' entries are sorted in runs by
   the tasks that read the texts, front-coded (length shared with the suffix
   before, and the rest), exchanged by class, and merged by a loser tree that
   keeps, for each loser, the length it shares with the winner, and never looks
   at those bytes again.  The merge yields the sorted suffixes and the length
   each shares with its neighbour.
4. A string at a given distance before the anchor is repeated if entries of two
   anchors or more share what it has after the anchor (a run of the merged order) and
   what it has before (a run of the order of the reversed prefixes).

A class too large for one task is divided by its strings, down to single ones, and
these are counted by an aggregation: the same result, from the same class.

Rows are told apart by a 128-bit digest of their key and text, so rows without keys or
with equal ones are.

Shorter repeats can be asked for in the same run (``passage``): a string's anchor is one
of its first bytes' too, so the anchors of the shorter length serve both.  Their spans are
told, with their words, and take nothing away.

Matches never cross rows.  Defined results: null texts are empty; texts shorter
than ``length`` keep all; repeated rows are copies of each other; an empty table
gives an empty one; other columns pass through whatever their names, columns named
like results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import SpanHash, discard, distinct, quoted, release_memory, releasing, text_slices, written

LENGTH, WINDOW = 400, 200
_GRAM = 16
#: Bytes of surroundings that one merging task gets, about; larger classes are counted by strings.
MERGE_BYTES = 8 << 20
_PLACE_BITS = 28
#: Bytes of text worked on at once: its arrays take some fifty times as much.
_SLICE = 1 << 18


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and row of every anchor."""
    size = np.diff(bounds)
    starts = [np.arange(a, b - length + 1) for a, b in zip(bounds[:-1][size >= length], bounds[1:][size >= length], strict=True)]
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(len(data) - _GRAM + 1)
    gram = SpanHash(data, 41).of(place, place + _GRAM)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least, width = (gram & ~low) | place.astype(np.uint64), 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[:len(least) - (window - width)], least[window - width:])
    at = distinct((least[np.concatenate(starts)] & low).astype(np.int64))[0]
    return at, np.searchsorted(bounds, at, "right") - 1


_ANCHOR = "id binary, at int, before int, after int, shared long, whole long"


def _row_id(key: Column, text: Column) -> Column:
    """128 bits of a row's key (null or not) and text."""
    return F.unhex(F.md5(F.concat_ws(":", key.isNull().cast("string"), F.octet_length(key).cast("string"), key, text).cast("binary")))


def _identified(df: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return df.select(_row_id(F.col(key).cast("string"), body).alias("id"), body.alias("text"))


def _shared(data: np.ndarray, at: np.ndarray, length: int, window: int) -> np.ndarray:
    """A hash of the bytes that all strings with an anchor share."""
    return SpanHash(data, 43).of(at, at + length - window + 1).view(np.int64)


def frequent_anchors(rows: DataFrame, length: int, window: int) -> DataFrame:
    """The ``shared`` hashes of :func:`find_anchors` that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in text_slices(batches, "text", _SLICE):
            at, _ = anchors(data, bounds, length, window)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(_shared(data, at, length, window))], names=["shared"])

    found = rows.select("text").mapInArrow(run, "shared long")
    return found.groupBy("shared").agg(F.count("*").alias("n")).where("n > 1").select("shared")


def find_anchors(rows: DataFrame, length: int, window: int, reach: int) -> DataFrame:
    """Anchors of (id, text) with the bytes of their surroundings before and after them (``reach`` at
    most), a hash of the bytes shared by all strings with the anchor, and one of the surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_slices(batches, "text", _SLICE):
            at, row = anchors(data, bounds, length, window)
            if not len(at):
                continue
            before = np.minimum(at - bounds[row], window - 1)
            after = np.minimum(bounds[row + 1] - at, reach)
            shared = _shared(data, at, length, window)
            whole = SpanHash(data, 47).of(at - before, at + after) + before.astype(np.uint64)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), pa.array((at - bounds[row]).astype(np.int32)),
                 pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)), pa.array(shared), pa.array(whole.view(np.int64))],
                names=[x.split()[0] for x in _ANCHOR.split(", ")])

    return rows.mapInArrow(run, _ANCHOR)


def common_length(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    low, high = start, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared lengths with the suffix before, and the rests, of sorted suffixes."""
    shared, rests, last = [], [], b""
    for s in suffixes:
        n = common_length(last, s, 0)
        shared.append(n)
        rests.append(s[n:])
        last = s
    return shared, rests


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, place in it, suffix, length shared with the suffix before) in sorted order.

    A loser tree; ``known[r]`` is what run r's suffix shares with the last winner on
    its path.  The one that shares more comes first; only on equal lengths are bytes
    compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    place, current, known = [0] * k, [None] * k, [0] * k
    for r, (_, rests) in enumerate(runs):
        current[r] = rests[0] if rests else None
    tree = [0] * (2 * k)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        x, y = current[a], current[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = common_length(x, y, known[a])
        first, second = (a, b) if (x[n:n + 1], a) <= (y[n:n + 1], b) else (b, a)
        known[second] = n
        return first, second

    winners = [0] * (2 * k)
    for leaf in range(k):
        winners[k + leaf] = leaf
    for node in range(k - 1, 0, -1):
        winners[node], tree[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if k > 1 else 0
    while current[best] is not None:
        r = best
        yield r, place[r], current[r], known[r]
        place[r] += 1
        shared, rests = runs[r]
        if place[r] < len(rests):
            known[r] = shared[place[r]]
            current[r] = current[r][:known[r]] + rests[place[r]]
        else:
            current[r] = None
        node = (r + k) // 2
        while node:
            best, tree[node] = play(best, tree[node])
            node //= 2


def repeated_distances(suffixes: list[tuple[bytes, int]], prefixes: list[bytes], lengths: list[int], window: int,
                       counts: list[int] | None = None) -> list[list[tuple[int, int, int]]]:
    """For merged (suffix, shared length), the prefixes before them and the number of anchors each
    stands for: the spans around the anchors, relative to them, that are covered by strings found
    twice, with the strings' length; spans of a shorter length are left out within those of a longer one."""
    n = len(suffixes)
    after = np.array([len(s) for s, _ in suffixes])
    shared = np.array([x for _, x in suffixes])
    shared[0] = 0
    turned = [p[::-1] for p in prefixes]
    order = sorted(range(n), key=turned.__getitem__)
    before = np.array([len(p) for p in prefixes])
    shared_back = np.array([0] + [common_length(turned[a], turned[b], 0) for a, b in zip(order, order[1:])])
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    weight = np.ones(n, np.int64) if counts is None else np.array(counts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    for length in sorted(lengths, reverse=True):
        found = _found_twice(after, before, shared, shared_back, rank, weight, length, window)
        for known, spans in zip(out, found, strict=True):
            known.extend((a, b, length) for a, b in spans if not any(x <= a and b <= y for x, y, _ in known))
    return out


def _found_twice(after: np.ndarray, before: np.ndarray, shared: np.ndarray, shared_back: np.ndarray, rank: np.ndarray,
                 weight: np.ndarray, length: int, window: int) -> list[list[tuple[int, int]]]:
    n = len(after)
    repeated = np.zeros((n, window), bool)
    # who shares too little with both neighbours is alone, and repeated only if it stands for several anchors
    ahead = np.maximum(shared, np.append(shared[1:], 0))
    behind = np.maximum(shared_back, np.append(shared_back[1:], 0))[rank]
    ahead, behind = np.where(weight > 1, after, ahead), np.where(weight > 1, before, behind)
    for distance in range(window):
        able = np.flatnonzero((ahead >= length - distance) & (behind >= distance))
        if not len(able):
            continue
        forward = np.cumsum(shared < length - distance)
        back = np.cumsum(shared_back < distance)[rank]
        pair = forward[able] * np.int64(n + 1) + back[able]
        by_pair = np.argsort(pair)
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair[by_pair]) > 0]))
        count = np.add.reduceat(weight[able[by_pair]], first)
        repeated[able[by_pair], distance] = np.repeat(count, np.diff(np.append(first, len(able)))) > 1
    return [_spans(r, length) for r in repeated]


def _spans(repeated: np.ndarray, length: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8)))
    return [(-(int(b) - 1), length - int(a)) for a, b in zip(edges[::2], edges[1::2], strict=True)][::-1]


_FOUND = "shared long, whole long, spans array<struct<lo:int,hi:int,length:int>>"


#: Anchors of a text whose surroundings are cut out at once.
_CUT = 1000


def _of_surroundings(rows: DataFrame, wanted: DataFrame, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                     schema: str) -> DataFrame:
    """What ``then`` makes of the (shared, whole, bucket, before, n, bytes) of the wanted anchors, read from their
    texts; in the same Python worker, as a second one for each task would hold its memory until the session ends."""
    anchors_of = wanted.groupBy("id").agg(F.collect_set(F.struct("shared", "whole", "bucket", "at", "before", "after", "n")).alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, found in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
                raw = text.as_py()
                every = pa.RecordBatch.from_struct_array(found.values)
                for at in range(0, every.num_rows, _CUT):
                    part = every.slice(at, _CUT)
                    pieces = [raw[a - b:a + c] for a, b, c in zip(*(part.column(i).to_pylist() for i in (3, 4, 5)), strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), part.column(4), part.column(6), pa.array(pieces, pa.binary())],
                                                     names=["shared", "whole", "bucket", "before", "n", "bytes"])

    # rows with equal ids are equal: any one of them has the bytes
    return rows.join(anchors_of, "id").dropDuplicates(["id"]).select("text", "anchors").mapInArrow(
        releasing(lambda batches: then(run(batches))), schema)


def _runs(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Front-coded sorted runs of the surroundings, one for each bucket and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, bytes, int, int, int]]] = {}
        size = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for bucket, own in held.items():
                own.sort()
                shared, rests = front_coded([s for s, *_ in own])
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int32()), "lengths": pa.array([shared], pa.list_(pa.int32())),
                    "rests": pa.array([rests], pa.list_(pa.binary())), "prefixes": pa.array([[p for _, p, *_ in own]], pa.list_(pa.binary())),
                    **{name: pa.array([[x[i] for x in own]], pa.list_(pa.int64())) for i, name in ((2, "shared"), (3, "whole"), (4, "n"))}})
            held.clear()

        for batch in batches:
            for a, b, bucket, before, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(bucket, []).append((raw[before:], raw[:before], a, b, n))
                size += len(raw)
            if size >= MERGE_BYTES:
                yield from passed_on()
                size = 0
        yield from passed_on()

    return _of_surroundings(rows, wanted, run, "bucket int, lengths array<int>, rests array<binary>, prefixes array<binary>, "
                                               "shared array<long>, whole array<long>, n array<long>")


def _merged(runs: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """Spans around the anchors of each bucket's merged runs."""

    def run(group: pa.Table) -> pa.Table:
        release_memory()
        rows = group.to_pylist()
        merged = [(r, i, s, n) for r, i, s, n in merge_runs([(x["lengths"], x["rests"]) for x in rows])]
        spans = repeated_distances([(s, n) for _, _, s, n in merged], [rows[r]["prefixes"][i] for r, i, _, _ in merged], lengths, window,
                                   [rows[r]["n"][i] for r, i, _, _ in merged])
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("length", pa.int32())]))
        found = [([{"lo": a, "hi": b, "length": c} for a, b, c in x], rows[r]["shared"][i], rows[r]["whole"][i])
                 for x, (r, i, _, _) in zip(spans, merged, strict=True) if x]
        return pa.table({"shared": pa.array([f[1] for f in found], pa.int64()), "whole": pa.array([f[2] for f in found], pa.int64()),
                         "spans": pa.array([f[0] for f in found], kind)})

    return runs.groupBy("bucket").applyInArrow(run, _FOUND)


def _counted(rows: DataFrame, wanted: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """As :func:`_merged`, from counts of every string's hashes: for classes of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in text_slices((b.set_column(5, "bytes", b.column(5).cast(pa.large_binary()).view(pa.large_string())) for b in batches), "bytes", 1 << 18):
            before = part.column(3).to_numpy()
            for length in lengths:
                strings = np.maximum(np.diff(bounds) - length + 1, 0)
                row = np.repeat(np.arange(len(strings)), strings)
                start = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings) + bounds[row]
                distance = (before[row] - (start - bounds[row])).astype(np.int32)
                ok = (distance >= 0) & (distance < window)
                start, row, distance = start[ok], row[ok], distance[ok]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), part.column(4).take(take), pa.array(distance), pa.array(np.full(len(row), length, np.int32)),
                     pa.array(SpanHash(data, 53).of(start, start + length).view(np.int64)), pa.array(SpanHash(data, 59).of(start, start + length).view(np.int64))],
                    names=["shared", "whole", "n", "distance", "length", "one", "two"])

    strings = _of_surroundings(rows, wanted, run, "shared long, whole long, n long, distance int, length int, one long, two long")
    keys = ["shared", "distance", "length", "one", "two"]
    # the strings of one class, distance and length: of each that more than one anchor has, all are covered
    twice = written(strings.groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 1").drop("n"), "repeats-twice")
    covered = F.collect_set(F.struct((-F.col("distance")).alias("lo"), (F.col("length") - F.col("distance")).alias("hi"), "length"))
    return strings.join(twice, keys, "left_semi").groupBy("shared", "whole").agg(covered.alias("spans"))


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, window: int = WINDOW,
                   merge_bytes: int = MERGE_BYTES, passage: int | None = None) -> DataFrame:
    """(id, spans): covered byte spans of the rows that have some, not yet united, and the length of the strings that
    cover them (``length``, or else ``passage`` if given, the shorter); ``id`` as in :func:`_row_id`."""
    least = length if passage is None else passage
    if passage is not None and not window + _GRAM - 1 <= passage <= length:
        raise ValueError(f"passage must be from {window + _GRAM - 1} (window and anchor) to {length} (length): {passage}")
    lengths = sorted({least, length})
    rows = _identified(df, key, text)
    found = find_anchors(rows, least, window, length)
    # tables are written before a join on a hash that can be frequent: so both sides are shuffled for it,
    # and Spark can split the rows of one hash
    often = written(frequent_anchors(rows, least, window), "repeats-often")
    repeated = written(found.join(often, "shared"), "repeats-anchors")
    place = F.struct("id", "at", "before", "after")
    entries = written(repeated.groupBy("shared", "whole").agg(F.count("*").alias("n"), F.min(place).alias("place")), "repeats-entries")
    classes = written(entries.groupBy("shared").agg(F.count("*").alias("kinds")), "repeats-classes")
    mixed = entries.join(classes.where("kinds > 1"), "shared")
    total = mixed.agg(F.count("*")).first()[0]
    buckets = max(1, -(-total * (length + window) // merge_bytes))
    wanted = mixed.select(
        "shared", "whole", F.pmod(F.hash("shared"), F.lit(buckets)).alias("bucket"), "place.*", "n",
        (F.col("kinds") * (length + window) > 4 * merge_bytes).alias("large"))
    spans = _merged(_runs(rows, wanted.where("not large")), lengths, window)
    if not classes.where(F.col("kinds") * (length + window) > 4 * merge_bytes).isEmpty():
        spans = spans.union(_counted(rows, wanted.where("large"), lengths, window))
    longest = F.when(F.col("place.before") + F.col("place.after") >= length, length).otherwise(least)
    whole = entries.join(classes.where("kinds = 1"), "shared").select(
        "shared", "whole", F.array(F.struct((-F.col("place.before")).alias("lo"), F.col("place.after").alias("hi"), longest.alias("length"))).alias("spans"))
    each = written(spans.unionByName(whole), "repeats-spans")
    discard(often, entries, classes)
    shifted = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("at")).alias("lo"), (s["hi"] + F.col("at")).alias("hi"), s["length"].alias("length")))
    return (repeated.join(each, ["shared", "whole"]).select("id", F.explode(shifted).alias("span"))
            .groupBy("id").agg(F.collect_set("span").alias("spans")))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the spans' bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def words_within(raw: bytes, runs: list[tuple[int, int]]) -> list[int]:
    """Number of whole words, parted by white space, in each run of the text's bytes."""
    def within_word(place: int) -> bool:
        """Whether a word goes on from the byte before the place to the one there."""
        return 0 < place < len(raw) and not raw[place - 1:place].isspace() and not raw[place:place + 1].isspace()

    return [max(0, len(raw[a:b].split()) - within_word(a) - within_word(b)) for a, b in runs]


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, window: int = WINDOW,
                   merge_bytes: int = MERGE_BYTES, passage: int | None = None, as_text: bool = False) -> DataFrame:
    """``df`` with ``kept_bytes`` (the remaining bytes) and ``removed_spans`` (start and end of
    the maximal removed runs); the text column goes.  With ``as_text`` the remaining bytes come as ``kept_text`` instead,
    without those of a character that is cut.  With ``passage``, a length of at most ``length``, also
    ``passages``: start, end and whole words of the maximal runs covered by strings of that
    length that start elsewhere too, judged on the input and not removed."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spans = written(repeated_spans(df, key, text, length, window, merge_bytes, passage), "repeats-of-rows")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept_name = "kept_text" if as_text else "kept_bytes"
    result = StructType.fromDDL(f"{kept_name} {'string' if as_text else 'binary'}, removed_spans array<struct<start:int,end:int>>" + (
        "" if passage is None else ", passages array<struct<start:int,end:int,words:int>>"))
    kept = [f for f in df.schema.fields if f.name not in (text, *result.names)]
    # the caller's columns travel as a struct, so that no name can clash with those used here
    rows = df.select(F.struct(*(F.col(quoted(f.name)) for f in kept), F.lit(0).alias(kept_name)).alias("row"),
                     body.alias("text"), _row_id(F.col(key).cast("string"), body).alias("id"))
    joined = rows.join(spans, "id", "left").select("row", "text", "spans")
    schema = StructType([joined.schema["row"], *result.fields])
    kinds = {f.name: f.type for f in to_arrow_schema(result)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                left, removed, passages = [], [], []
                for raw, found in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    runs = united([(s["lo"], s["hi"]) for s in found or [] if s["length"] == length])
                    edges = [0, *(x for r in runs for x in r), len(raw)]
                    rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    left.append(rest.decode(errors="ignore") if as_text else rest)
                    removed.append([{"start": a, "end": b} for a, b in runs])
                    if passage is not None:
                        # a longer repeat is made of shorter ones
                        runs = united([(s["lo"], s["hi"]) for s in found or []])
                        passages.append([{"start": a, "end": b, "words": n} for (a, b), n in zip(runs, words_within(raw, runs) if runs else [], strict=True)])
                columns = dict(zip(result.names, (left, removed, passages)))  # no passages, no such name
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, kinds[name]) for name, x in columns.items())], names=["row", *columns])

    return joined.mapInArrow(releasing(run), schema).select(*(F.col("row").getField(f.name).alias(f.name) for f in kept), *result.names)
