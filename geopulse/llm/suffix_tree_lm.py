"""Language-model scores from a probabilistic suffix tree.

Tokens are words (A-Z lowered, ASCII white space between) and one end for each
text.  The tree's nodes are contexts of up to ``depth`` words of the whole
vocabulary.  A context that occurs at least ``often`` times in the training text is a
candidate; it stores the words that follow it at least ``least`` times.  It stays in the tree if its next-word distribution diverges from
its parent's (the context without its first word): its followers must be more likely
by at least ``divergence`` nats together.  All are absolute, so the tree grows with the
corpus.

A context of n occurrences gives a stored follower (count - ``discount``) / n, and
leaves the rest to its parent, down to the additive unigram distribution.  A
token is scored in the state of the longest context in the tree that ends before it.

The tree is a table, never in one place: of each word and stored sequence (a 64-bit
key) its count, and of each kept context the sum and number of its followers.

1. Spark counts the words, and the sequences of each length in turn, as the distinct
   ones of bounded runs, dealt by ranges of their keys; it keeps the stored ones, and
   tests the contexts by joins with the level above.
2. The texts are dealt to chunks.  A chunk asks for its distinct words and pairs, as
   sorted, delta-coded keys by key range; the tree is dealt by the same ranges, and what
   it has of the asked keys goes back to the chunk.  A longer sequence is counted, and
   asked for, only where both its shorter ends are stored.
3. The texts are scored beside their chunk's answers.

No step holds more than one range's part of the tree or one chunk's answers; texts
stream through.  Rows equal in key and text fall into one chunk.

Defined results: null and empty texts are one end token; null keys are scored,
training rows are those for which the caller's condition is true; without training tokens every token has
the uniform probability of an empty vocabulary; repeated rows are scored (and
counted) each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import LOWER, discard, distinct, release_memory, releasing, row_slices, text_slices, utf8, word_hashes, word_spans, written

DEPTH, OFTEN, LEAST, DIVERGENCE, DISCOUNT = 2, 8, 3, 2.0, 0.75
#: Bytes of text in a chunk and tree entries in a key range, about; keys that a task counts before it passes them on.
CHUNK_BYTES, RANGE_ENTRIES = 24 << 20, 2 << 20
_COUNTED_KEYS = 2_000_000
#: Bytes of text for each key range of the sequences that are counted: some million of them (four at most).
COUNTED_BYTES = 8 << 20
#: Key ranges at least (as a power of two), so that small trees are looked up by several tasks; keys in one message.
_RANGE_BITS, _MESSAGE_KEYS = 6, 1 << 15
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
#: The end token's hash; words have other ones (their lowest bit is set).
END = np.uint64(2)


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token, each row's end last."""
    lower = LOWER[data]
    start, end, row = word_spans(lower, bounds, _WORD)
    rows = len(bounds) - 1
    words = word_hashes(lower, start, end) | np.uint64(1)
    count = np.bincount(row, minlength=rows)
    ends = np.cumsum(count + 1) - 1
    out = np.full(len(words) + rows, END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = words
    return out, np.repeat(np.arange(rows), count + 1)


def _xxhash64(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    h = (seed + np.uint64(0x27D4EB2F165667C5 + 8)) ^ _rotated(value * np.uint64(0xC2B2AE3D27D4EB4F), 31) * np.uint64(0x9E3779B185EBCA87)
    h = _rotated(h, 27) * np.uint64(0x9E3779B185EBCA87) + np.uint64(0x85EBCA77C2B2AE63)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    return h ^ h >> np.uint64(32)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def sequence_key(context: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Key of the sequences with these keys of all words but the last and of all but the
    first: Spark's ``xxhash64(context, parent)``.  A single word's key is its hash."""
    return _xxhash64(parent, _xxhash64(context, np.full(len(context), 42, np.uint64)))


def sequences(words: np.ndarray, row: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, context, parent, able) of the sequence that ends at each token, for each
    length from 2; ``able`` is where it lies in one text."""
    key, able = words, np.ones(len(words), bool)
    for _ in range(longest - 1):
        context, within = np.zeros_like(key), np.zeros(len(key), bool)
        context[1:] = key[:-1]
        within[1:] = able[:-1] & (row[1:] == row[:-1])
        parent, able = key, within
        key = sequence_key(context, parent)
        yield key, context, parent, able


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable ``np.argsort`` of 64-bit keys, and the sorted keys: by a sort of the high bits with the place in the
    low ones (several times as fast as an argsort), and another where keys differ in their low bits alone."""
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    own = keys[order]
    if (own[1:] < own[:-1]).any():
        order = order[np.argsort(own, kind="stable")]
        own = keys[order]
    return order, own


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each distinct number of sorted ones begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _token_counts(texts: DataFrame) -> DataFrame:
    """(word, n): occurrences of every token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (words,) in _runs((tokens(data, bounds)[0],) for _, data, bounds in text_slices(batches, "text")):
            word, count = distinct(words)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count, pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _runs(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The parts' arrays joined to runs of a bounded number of keys."""
    held: list[tuple[np.ndarray, ...]] = []
    for part in parts:
        held.append(part)
        if sum(len(h[0]) for h in held) >= _COUNTED_KEYS:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


_COUNTS = "context long, parent long, n long"
#: Counted sequences of one key range, as a message: a row for each would take several times the CPU time in a shuffle.
_COUNTED = {"range": pa.int32(), "contexts": pa.binary(), "parents": pa.binary(), "counts": pa.binary()}
_COUNTED_SCHEMA = "range int, contexts binary, parents binary, counts binary"


def _counted(key: np.ndarray, context: np.ndarray, parent: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """Context, parent and count of the distinct sequences, by key range and in bounded messages."""
    order, key = _order(key)
    at = _firsts(key)
    first, count = order[at], np.diff(np.append(at, len(key))).astype(np.uint64)
    of = (key[at] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    edges = np.unique(np.concatenate([_firsts(of), np.arange(0, len(of), _MESSAGE_KEYS), [len(of)]])).tolist()
    out, size = [], 0
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out.append((int(of[a]), context[first[a:b]].tobytes(), parent[first[a:b]].tobytes(), _packed(count[a:b])))
        size += b - a
        if size >= 8 * _MESSAGE_KEYS or b == len(of):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _COUNTED.values(), strict=True)], names=list(_COUNTED))
            out, size = [], 0


def _summed(counts: DataFrame, ranges: int, least: int) -> DataFrame:
    """(context, parent, n) of the sequences that occur at least ``least`` times, from the messages of :func:`_counted`."""

    def added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        context, parent, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, key = _order(sequence_key(context, parent))
        at = _firsts(key)
        return context[order[at]], parent[order[at]], np.add.reduceat(n[order], at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for contexts, parents, n in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                held.append((np.frombuffer(contexts, np.uint64), np.frombuffer(parents, np.uint64), _unpacked(n)))
                size += len(held[-1][0])
            if size >= 2 * _COUNTED_KEYS:  # what comes again is added up before more is read
                held = [added(held)]
                size = len(held[0][0]) // 2
        if held:
            context, parent, n = added(held)
            often = np.flatnonzero(n >= least)
            for i in range(0, len(often), 8 * _MESSAGE_KEYS):
                part = often[i:i + 8 * _MESSAGE_KEYS]
                yield pa.RecordBatch.from_arrays([pa.array(c[part].view(np.int64)) for c in (context, parent, n)], names=["context", "parent", "n"])

    # dealt by the whole sequence: a frequent context is spread
    return counts.repartitionById(ranges, F.col("range")).mapInArrow(releasing(run), _COUNTS)


def _pair_counts(texts: DataFrame, ranges: int) -> DataFrame:
    """Counts of the pairs of adjacent tokens in the runs of each task."""

    def pairs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        (key, context, parent, able), = sequences(*tokens(data, bounds), 2)
        return key[able], context[able], parent[able]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(pairs(data, bounds) for _, data, bounds in text_slices(batches, "text")):
            yield from _counted(*part, ranges)

    return texts.select("text").mapInArrow(run, _COUNTED_SCHEMA)


def _level(counts: DataFrame, above: DataFrame, often: int, divergence: float, discount: float) -> tuple[DataFrame, DataFrame]:
    """From the (context, parent, n) of a length's frequent sequences and the (key, n, q) of those one word shorter:
    the same (key, n, q) of the stored ones, and (context, stored, kinds) of the kept contexts.

    ``q`` is the last word's probability in the state of the longest kept context.
    """
    rows = written(counts, "lm-stored")
    back = 1 - (F.col("stored") - F.lit(float(discount)) * F.col("kinds")) / F.col("total")
    contexts = written(rows.groupBy("context").agg(F.sum("n").alias("stored"), F.count("*").alias("kinds"))
                       .join(above.where(F.col("n") >= often).select(F.col("key").alias("context"), F.col("n").alias("total")), "context")
                       .withColumn("back", back), "lm-contexts")
    # the shorter ends of a stored sequence of a candidate occur as often, so the joins find them
    p = (F.col("n") - F.lit(float(discount))) / F.col("total") + F.col("back") * F.col("below")
    level = written(rows.join(contexts.select("context", "total", "back"), "context")
                    .join(above.select(F.col("key").alias("parent"), F.col("q").alias("below")), "parent")
                    .select(F.xxhash64("context", "parent").alias("key"), "context", "n", p.alias("p"), "below"), "lm-level")
    discard(rows)
    gains = level.groupBy("context").agg(F.sum(F.col("n") * F.log(F.col("p") / F.col("below"))).alias("gain"))
    rest = (F.col("total") - F.col("stored")) * F.log("back")  # of followers that are not stored
    kept = written(contexts.join(gains, "context").where(F.col("gain") + rest >= divergence).select("context", "stored", "kinds"), "lm-kept")
    chosen = F.when(F.col("stored").isNotNull(), F.col("p")).otherwise(F.col("below"))
    stored = written(level.join(kept, "context", "left").select("key", "n", chosen.alias("q")), "lm-sequences")
    discard(contexts, level)
    return stored, kept


def _entries(sequences_: DataFrame, contexts: DataFrame) -> DataFrame:
    """(key, n, stored, kinds): what the tree answers; a key can have an entry of each kind."""
    zero = F.lit(0).cast("long")
    return sequences_.select("key", "n", zero.alias("stored"), zero.alias("kinds")).unionAll(contexts.select("context", zero, "stored", "kinds"))


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, without the high bytes that none of them needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    width = raw[0]
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1).T
    return out.view(np.uint64).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: the first, and the differences."""
    return keys[:1].tobytes() + _packed(np.diff(keys))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(raw[:8], np.uint64), _unpacked(raw[8:])]), dtype=np.uint64)


_MESSAGE = {"range": pa.int32(), "chunk": pa.int32(), "keys": pa.binary(), "values": pa.list_(pa.binary())}


def _messages(keys: np.ndarray, values: list[np.ndarray], chunk: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys with their values, by key range and in bounded messages."""
    of = (keys >> np.uint64(64 - bits)).astype(np.int32)
    edges = np.unique(np.concatenate([np.flatnonzero(np.diff(of, prepend=-1)), np.arange(0, len(keys), _MESSAGE_KEYS), [len(keys)]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield pa.RecordBatch.from_arrays(
            [pa.array([of[a]], pa.int32()), pa.array([chunk], pa.int32()), pa.array([_packed_keys(keys[a:b])], pa.binary()),
             pa.array([[_packed(v[a:b].view(np.uint64)) for v in values]], pa.list_(pa.binary()))], names=list(_MESSAGE))


_MESSAGE_SCHEMA = "range int, chunk int, keys binary, values array<binary>"


def _tree_messages(tree: DataFrame, bits: int) -> DataFrame:
    """The tree's entries by key range; their chunk is -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = ([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches)
        for key, *values in _runs(tuple(e) for e in entries):
            order, key = _order(key.view(np.uint64))
            yield from _messages(key, [v[order] for v in values], -1, bits)

    return tree.select("key", "n", "stored", "kinds").mapInArrow(run, _MESSAGE_SCHEMA)


def _streamed(df: DataFrame, parts: int, by: str, then: str) -> DataFrame:
    """Rows dealt by a part number, a partition for each part, in the order of ``then``."""
    return df.repartitionById(parts, F.col(by)).sortWithinPartitions(by, then)


def _beside(chunked: DataFrame, answers: list[DataFrame], chunks: int, *columns: str) -> DataFrame:
    """Each chunk's answers, then its texts, with the chosen columns of theirs at the end."""
    kinds = {f.name: f.dataType for f in chunked.schema.fields}
    none = lambda k: F.lit(None).cast(k)
    rows = chunked.select("chunk", F.lit(1).alias("turn"), none("binary").alias("keys"), none("array<binary>").alias("values"), "text", *columns)
    for own in answers:
        rows = rows.unionAll(own.select("chunk", F.lit(0), "keys", "values", none("string"), *(none(kinds[c]) for c in columns)))
    return _streamed(rows, chunks, "chunk", "turn") if answers else rows.repartitionById(chunks, F.col("chunk"))


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Known, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(chunk, its answers, rows, bytes, boundaries) for each slice of the texts of :func:`_beside`."""
    now, held, known = None, [], None
    for batch in batches:
        chunk, turn = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(chunk) | np.diff(turn)) + 1, [len(chunk)]]).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            if chunk[a] != now:
                now, held, known = int(chunk[a]), [], None
                release_memory()
            part = batch.slice(a, b - a)
            if turn[a] == 0:
                held += zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                continue
            if known is None:
                known, held = _Known(held), []
            data, bounds = utf8(part.column(4))
            for i, j in row_slices(bounds):
                yield now, known, part.slice(i, j - i), data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
    release_memory()


def _asked(texts: DataFrame, bits: int) -> DataFrame:
    """Each chunk's distinct words and pairs by key range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for chunk, _, _, data, bounds in _by_chunk(batches):
            if chunk != now or sum(map(len, held)) >= 4 * _COUNTED_KEYS:
                if held:
                    yield from _messages(distinct(np.concatenate(held))[0], [], now, bits)
                now, held = chunk, []
            words, row = tokens(data, bounds)
            (key, _, _, able), = sequences(words, row, 2)
            held.append(distinct(np.concatenate([words, key[able]]))[0])
        if held:
            yield from _messages(distinct(np.concatenate(held))[0], [], now, bits)

    return texts.mapInArrow(run, _MESSAGE_SCHEMA)


def _candidates(texts: DataFrame, length: int, often: int, schema: str, found) -> DataFrame:
    """``found`` of each slice of texts beside their answers: it gets (chunk, keys, contexts, parents, where a token's
    context is a candidate, where also its parent is stored); None is the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take = found()
        next(take)
        for chunk, known, _, data, bounds in _by_chunk(batches):
            words, row = tokens(data, bounds)
            *_, (key, context, parent, able) = sequences(words, row, length)
            n, = known.of(parent, 1)
            before = able & np.concatenate([[False], n[:-1] >= often])  # the context is the shorter sequence one token before
            yield from take.send((chunk, key, context, parent, before, before & (n > 0)))
        yield from take.send(None)

    return texts.mapInArrow(run, schema)


def _longer_counts(texts: DataFrame, length: int, often: int, ranges: int) -> DataFrame:
    """Counts of the longer sequences in runs of texts."""

    def found():
        counted, out = [], []
        while (given := (yield out)) is not None:
            _, key, context, parent, _, both = given
            counted.append((key[both], context[both], parent[both]))
            out = []
            if sum(len(c[0]) for c in counted) >= _COUNTED_KEYS:
                out, counted = messages(counted), []
        yield messages(counted) if counted else []

    def messages(counted):
        return _counted(*(np.concatenate(x) for x in zip(*counted, strict=True)), ranges)

    return _candidates(texts, length, often, _COUNTED_SCHEMA, found)


def _longer_asked(texts: DataFrame, length: int, often: int, bits: int) -> DataFrame:
    """Each chunk's longer sequences and their contexts by key range."""

    def found():
        now, held, out = None, [], []
        while (given := (yield out)) is not None:
            chunk, key, context, _, before, both = given
            out = []
            if held and (chunk != now or sum(map(len, held)) >= 4 * _COUNTED_KEYS):
                out, held = list(_messages(distinct(np.concatenate(held))[0], [], now, bits)), []
            now = chunk
            held.append(distinct(np.concatenate([context[before], key[both]]))[0])
        yield list(_messages(distinct(np.concatenate(held))[0], [], now, bits)) if held else []

    return _candidates(texts, length, often, _MESSAGE_SCHEMA, found)


def _answers(entries: DataFrame, asked: DataFrame, bits: int) -> DataFrame:
    """What the tree's entries say of each chunk's keys: a range's entries come first, then the chunks' questions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, held = None, None, []
        for batch in batches:
            out = []
            for i in range(batch.num_rows):  # one message at a time
                place, chunk, raw, values = (batch.column(c)[i].as_py() for c in range(4))
                if place != now:
                    now, known, held = place, None, []
                if chunk < 0:
                    held.append((raw, values))
                    continue
                if known is None:
                    known, held = _Known(held), []
                at = known.places(_unpacked_keys(raw))
                if len(at):
                    out.append((place, chunk, _packed_keys(known.keys[at]), [_packed(v[at].view(np.uint64)) for v in known.values]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _MESSAGE.values(), strict=True)], names=list(_MESSAGE))

    return _streamed(_tree_messages(entries, bits).unionAll(asked), 1 << bits, "range", "chunk").mapInArrow(run, _MESSAGE_SCHEMA)


class _Known:
    """Entries by key: count, and followers' sum and number (0: unknown)."""

    def __init__(self, messages: list[tuple[bytes, list[bytes]]]):
        self.keys, self.values = np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * 3
        if messages:
            keys, *values = (np.concatenate(x) for x in zip(*((_unpacked_keys(k), *map(_unpacked, v)) for k, v in messages), strict=True))
            order, keys = _order(keys)
            first = _firsts(keys)
            # entries of one key complement each other, or repeat each other if a chunk asked twice
            self.keys, self.values = keys[first], [np.maximum.reduceat(v.view(np.int64)[order], first) for v in values]

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Places of those of the sorted keys that have an entry."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at[self.keys[at] == keys]

    def of(self, keys: np.ndarray, columns: int = 3) -> list[np.ndarray]:
        """The first of the three numbers of each key."""
        out = [np.zeros(len(keys)) for _ in range(columns)]
        if len(self.keys) and len(keys):
            order, own = _order(keys)  # in order, and each once, they are found much faster
            first = _firsts(own)
            times, own = np.diff(np.append(first, len(own))), own[first]
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            there = self.keys[at] == own
            for result, values in zip(out, self.values):
                result[order] = np.repeat(np.where(there, values[at], 0), times)
        return out


def _scored(known: _Known, data: np.ndarray, bounds: np.ndarray, total: int, vocabulary: int, depth: int, discount: float) -> list[np.ndarray]:
    """n_tokens, n_known, base score and score of each row."""
    words, row = tokens(data, bounds)
    n, stored, kinds = known.of(words)
    base = (n + 0.5) / (total + 0.5 * (vocabulary + 1))
    found, p = n, base
    shorter = [n, stored, kinds]  # of the sequence one word shorter that ends at each token
    for length, (key, _, _, able) in enumerate(sequences(words, row, depth + 1), 2):
        # the context is the shorter sequence that ends one token before
        whole, used, of = ([np.concatenate([[0.0], x[:-1]]) for x in shorter])
        at = np.flatnonzero(able & (of > 0))
        if length > depth:  # the longest are no contexts: only where one is kept they are looked up
            n, = known.of(key[at], 1)
        else:
            shorter = known.of(key)
            n = shorter[0][at]
        own = np.where(n > 0, (n - discount) / whole[at], 0)
        p = p.copy()
        p[at] = own + (1 - (used[at] - discount * of[at]) / whole[at]) * p[at]
    add = lambda x: np.bincount(row, weights=x, minlength=len(bounds) - 1)
    return [add(np.ones(len(words))).astype(np.int64), add(found > 0).astype(np.int64), add(np.log10(base)), add(np.log10(p))]


def score_texts(documents: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
                often: int = OFTEN, least: int = LEAST, divergence: float = DIVERGENCE, discount: float = DISCOUNT) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every whole text, learned from the rows with ``learn``.

    ``base_score`` is the log10 probability under the additive unigram distribution,
    ``score`` under the tree.
    """
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                            F.coalesce(learn.cast("boolean"), F.lit(False)).alias("learn"))
    learned = rows.where("learn")
    counts = written(_token_counts(learned), "lm-counts")
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    above = counts.select(F.col("word").alias("key"), "n", ((F.col("n") + 0.5) / F.lit(total + 0.5 * (vocabulary + 1))).alias("q"))
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks, ranges = (max(1, -(-int(size) // x)) for x in (CHUNK_BYTES, COUNTED_BYTES))
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(chunks)).cast("int"))

    answers: list[DataFrame] = []
    read = [counts]
    for length in range(2, depth + 2):
        beside = _beside(chunked, answers, chunks)
        if length == 2:
            found = _pair_counts(learned, ranges)
        else:
            found = _longer_counts(_beside(chunked.where("learn"), answers, chunks), length, often, ranges)
        stored, kept = _level(_summed(found, ranges, least), above, often, divergence, discount)
        entries = _entries(stored, kept)
        if length == 2:
            entries = entries.unionAll(_entries(counts.withColumnRenamed("word", "key"), kept.limit(0)))
        bits = _bits(entries)
        asked = _asked(beside, bits) if length == 2 else _longer_asked(beside, length, often, bits)
        answers.append(written(_answers(entries, asked, bits), "lm-answers"))
        discard(*read, kept)
        read, above = [stored], stored.select("key", "n", "q")
    discard(*read)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, known, slice_, data, bounds in _by_chunk(batches):
            n, there, base, score = _scored(known, data, bounds, total, vocabulary, depth, discount)
            yield pa.RecordBatch.from_arrays(
                [slice_.column(5), pa.array(n), pa.array(there), pa.array(np.full(len(n), total, np.int64)), pa.array(base), pa.array(score)],
                names=["key", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return written(_beside(chunked, answers, chunks, "key").mapInArrow(
        run, f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "lm-scores")


def _bits(entries: DataFrame) -> int:
    """Key ranges, as a power of two."""
    return max(_RANGE_BITS, (entries.count() // RANGE_ENTRIES).bit_length())
