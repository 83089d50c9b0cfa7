"""Near-duplicate documents by DartMinHash and banded joining.

Each element (a hashed run of five words) owns the region [0, weight) x [0, rank
limit) of a plane on which a Poisson process of unit density throws darts: the
plane's unit cells hash to the number of their darts, a dart hashes to a place
in its cell and to one of ``COORDINATES``.  The earliest dart (least rank) of
each coordinate is the signature.  The rank limit is chosen so that a text has
about k ln k + 2k darts whatever its size, and is doubled for texts with an
empty coordinate; equal cells hold equal darts in all texts, so two signatures
agree in a coordinate with the probability of the texts' weighted Jaccard
similarity.

Texts that agree in all coordinates of a band meet in a bucket.  Equal texts are
one node from the start.  Similarity is the weighted Jaccard one, a run weighing as
often as it occurs, in the signatures as in the exact comparison (of 32-bit
element hashes).  Buckets are resolved in two ways:

1. Each open bucket's members are compared with one pivot, the member that shares
   the largest buckets.  Linked texts are one component and never compared again, so
   a group of copies costs one comparison a member.  This is repeated, with
   another pivot, as long as a round links a good part of what it compares.
2. The members that are still apart are joined on their rarest runs: of two sets of
   similarity s each holds one of the other's among its (1 - s) size + 1 rarest, and at
   position k of this order a text of n runs can only meet texts of up to
   (n - k + 1) (1 + s) / s - n runs.  Runs that no other text has come first, and
   what a large group shares comes last, so near copies below the threshold meet
   only where they share rare runs; no bucket is paired out.

Words: text between ASCII white space, A-Z lowered.  A text of fewer than five
words, but not none, is one run.

Defined results: null and empty texts, and texts without words, are alike only
to equal texts; null keys and repeated rows get their text's classes; an empty
table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import LOWER, SpanHash, discard, distinct, mix, seeds, text_slices, word_spans, written

RUN_WORDS, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8^5)^25 > 0.9999.
BANDS, BAND_ROWS = 25, 5
COORDINATES = BANDS * BAND_ROWS
_DARTS = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
_POISSON = np.cumsum([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800, 39916800)])
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_PLACES = seeds(RUN_WORDS, 31) | np.uint64(1)
#: Bytes of text worked on at once: the arrays of its darts take some hundred times as much.
_SLICE = 1 << 18


def runs(data: np.ndarray, bounds: np.ndarray, weighted: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed word runs: (row, hash, weight), by row and hash; the weight is 1 or the count."""
    lower = LOWER[data]
    start, end, row = word_spans(lower, bounds, _WORD)
    words = SpanHash(lower, 29).of(start, end)
    rows = len(bounds) - 1
    count = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    offset = np.arange(len(words)) - first[row]
    at = np.flatnonzero((offset + RUN_WORDS <= count[row]) | ((offset == 0) & (count[row] < RUN_WORDS)))
    total = np.zeros(len(at), np.uint64)
    for k in range(RUN_WORDS):
        inside = offset[at] + k < count[row[at]]
        total[inside] += words[at[inside] + k] * _PLACES[k]
    hashes, row = mix(total), row[at]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    places = np.flatnonzero(new)
    weight = np.diff(np.append(places, len(row))) if weighted else np.ones(len(places), np.int64)
    return row[places], hashes[places], weight.astype(float)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def darts(row: np.ndarray, element: np.ndarray, weight: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts in the elements' regions with ranks in [low, high) of their row: (row, hash, rank)."""
    columns = np.ceil(weight).astype(np.int64)
    strips = (high - low)[row]
    cells = columns * strips
    of = np.repeat(np.arange(len(element)), cells)
    number = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
    column, strip = number % columns[of], number // columns[of] + low[row[of]]
    cell = mix(mix(element[of] + column.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + strip.astype(np.uint64))
    thrown = np.searchsorted(_POISSON, _uniform(cell), "right")
    which = np.repeat(np.arange(len(of)), thrown)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(thrown) - thrown, thrown)
    dart = mix(cell[which] + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    hit = column[which] + _uniform(mix(dart ^ np.uint64(0x5851F42D4C957F2D))) < weight[of[which]]
    which, dart = which[hit], dart[hit]
    rank = strip[which] + _uniform(mix(dart ^ np.uint64(0x14057B7EF767814F)))
    return row[of[which]], dart, rank


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Earliest dart of each coordinate for each row (rows without elements: zeros)."""
    out = np.zeros((rows, COORDINATES), np.uint64)
    total = np.bincount(row, weights=weight, minlength=rows)
    low = np.zeros(rows, np.int64)
    high = np.ceil(_DARTS / np.maximum(total, 1e-9)).astype(np.int64)
    open_rows = total > 0
    while open_rows.any():
        use = open_rows[row]
        r, dart, rank = darts(row[use], element[use], weight[use], low, high)
        slot = r * COORDINATES + (mix(dart + np.uint64(77)) % np.uint64(COORDINATES)).astype(np.int64)
        order = np.lexsort((dart, rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        flat = out.reshape(-1)
        slot, dart = slot[first], dart[first]
        empty = flat[slot] == 0
        flat[slot[empty]] = dart[empty] | np.uint64(1)
        open_rows = open_rows & (out == 0).any(axis=1)
        low, high = high, high * 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key for each band of each row."""
    out = np.zeros((len(signature), BANDS), np.uint64)
    for k in range(BAND_ROWS):
        out = mix(out + signature[:, k::BAND_ROWS][:, :BANDS])
    return mix(out + np.arange(BANDS, dtype=np.uint64))


def sketches(texts: DataFrame, weighted: bool = False) -> DataFrame:
    """(key, node, bands) of (key, node, text); no bands for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_slices(batches, "text", _SLICE):
            row, element, weight = runs(data, bounds, weighted)
            keys = band_keys(signatures(row, element, weight, rows.num_rows)).view(np.int64)
            some = np.bincount(row, minlength=rows.num_rows) > 0
            bands = [k.tolist() if s else [] for k, s in zip(keys, some, strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(bands, pa.list_(pa.int64()))],
                                              names=["key", "node", "bands"])

    kind = texts.schema["key"].dataType.simpleString()
    return texts.select("key", "node", "text").mapInArrow(run, f"key {kind}, node binary, bands array<long>")


def _elements(data: np.ndarray, bounds: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every unit of weight: the j-th occurrence of a run is an element of its own."""
    row, element, weight = runs(data, bounds, weighted)
    times = weight.astype(np.int64)
    turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(row, times), np.where(turn == 0, np.repeat(element, times), mix(np.repeat(element, times) + turn.astype(np.uint64)))


def run_sets(texts: DataFrame, weighted: bool = False) -> DataFrame:
    """(node, runs): the sorted 32-bit hashes of a text's elements, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_slices(batches, "text", _SLICE):
            row, element = _elements(data, bounds, weighted)
            at = np.searchsorted(row, np.arange(rows.num_rows + 1))
            short = (element >> np.uint64(32)).astype(np.uint32)
            sets = [distinct(short[i:j])[0].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.binary())], names=["node", "runs"])

    return texts.select("node", "text").mapInArrow(run, "node binary, runs binary")


def element_rows(texts: DataFrame, weighted: bool = False) -> DataFrame:
    """(node, size, run): each element of a text, as a 64-bit hash, with the number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_slices(batches, "text", _SLICE):
            row, element = _elements(data, bounds, weighted)
            size = np.bincount(row, minlength=rows.num_rows)[row]
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row)), pa.array(size, pa.int64()), pa.array(element.view(np.int64))],
                                             names=["node", "size", "run"])

    return texts.select("node", "text").mapInArrow(run, "node binary, size long, run long")


def _similar(a: bytes, b: bytes, least: float) -> bool:
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if len(small) < least * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return common >= least * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` with a similarity of at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = pa.array([_similar(p, q, least) for p, q in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("runs").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("runs").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) with one label, the least, for the nodes of each component.

    ``labels`` name the components known so far; edges join nodes.  Each round takes
    the least neighbouring label and then the label's own label.
    """
    links = (edges.join(labels.withColumnsRenamed({"node": "a", "label": "u"}), "a")
             .join(labels.withColumnsRenamed({"node": "b", "label": "v"}), "b").where("u != v").select("u", "v"))
    links = written(links.union(links.select("v", "u")).distinct(), "near-links")
    if links.isEmpty():
        discard(links)
        return labels
    held = now = written(links.select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node")), "near-roots")
    while True:
        least = (links.join(now.withColumnsRenamed({"node": "v", "label": "near"}), "v").groupBy("u").agg(F.min("near").alias("near")))
        step = now.join(least.withColumnRenamed("u", "node"), "node", "left").select(
            "node", "label", F.least("label", "near").alias("next"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("further"))
        step = written(step.join(jump, "next", "left").select("node", "label", F.least("next", "further").alias("next")), "near-step")
        discard(held)
        held, now = step, step.select("node", F.col("next").alias("label"))
        if step.where("next != label").isEmpty():
            break
    roots = now.select(F.col("label").alias("root"), F.col("node").alias("label"))
    renamed = written(labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "near-labels")
    discard(links, held, labels)
    return renamed


def _bin(size) -> F.Column:
    return F.floor(F.log(F.greatest(size, F.lit(1.0))) / np.log(1.05))


def rare_pairs(elements: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """(a, b): texts of which at least one is open, with other labels, that can have a similarity of ``least``.

    ``elements`` are (node, size, run), ``nodes`` (node, label, open).
    """
    often = elements.groupBy("run").agg(F.count("*").alias("times")).where("times > 1")
    # a text's own runs, the rarest first; those of no other text only count as places
    shared = written(elements.join(often, "run").groupBy("node", "size").agg(
        F.array_sort(F.collect_list(F.struct("times", "run"))).alias("runs")), "near-rare")
    longest = F.col("size") - F.ceil(F.col("size") * least - 1e-6) + 1
    alone = F.col("size") - F.size("runs")
    entries = (shared.withColumn("alone", alone).where(F.col("alone") < longest)
               .select("node", "size", "alone", F.posexplode(F.slice("runs", 1, (longest - F.col("alone")).cast("int"))).alias("at", "of"))
               .withColumn("most", F.floor((F.col("size") - F.col("alone") - F.col("at")) * (1 + 1 / least) - F.col("size") + 1e-6))
               .where(F.col("most") >= F.col("size") * least - 1e-6).join(nodes, "node")
               .select("node", "size", "most", "label", "open", F.col("of.run").alias("run"), _bin(F.col("size")).alias("own"),
                       F.explode(F.sequence(_bin(F.col("size") * least - 1e-6), _bin(F.least(F.col("most"), F.col("size") / least)))).alias("other")))
    entries = written(entries, "near-entries")
    names = {"node": "p", "size": "p_size", "most": "p_most", "label": "p_label", "own": "other", "other": "own"}
    partners = entries.drop("open").select("run", *(F.col(k).alias(v) for k, v in names.items()))
    pairs = entries.where("open").join(partners, ["run", "own", "other"]).where(
        "label != p_label and size <= p_most and p_size <= most")
    pairs = written(pairs.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct(), "near-pairs")
    discard(shared, entries)
    return pairs


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of the buckets that hold more than one label, with the bucket's best pivot."""
    labelled = members.join(labels, "node")
    buckets = (labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                              F.max(F.struct("mass", "node", "label")).alias("top")).where("low != high"))
    buckets = written(buckets.select("bucket", "top"), "near-open")
    alive = written(labelled.join(buckets, "bucket"), "near-alive")
    discard(buckets)
    return alive


#: Pivot rounds go on while they link this share of the pairs they compare.
_WORTH = 0.05


def linked_texts(members: DataFrame, texts: DataFrame, least: float, weighted: bool) -> DataFrame:
    """(node, label) of the nodes in ``members`` (bucket, node, mass), linked by exact similarity.

    ``texts`` are the (node, text) of the members.  A pivot leaves its bucket once it was
    compared with all of it.
    """
    sets = written(run_sets(texts, weighted).dropDuplicates(["node"]), "near-sets")
    labels = written(members.select("node").distinct().withColumn("label", F.col("node")), "near-labels")
    left, held = members, []
    while True:
        alive = _open_members(left, labels)
        discard(*held)
        held = [alive]
        met = (alive.where("node != top.node and label != top.label")
               .select(F.least("node", "top.node").alias("a"), F.greatest("node", "top.node").alias("b")).distinct())
        pairs = written(met, "near-pairs")
        compared = pairs.count()
        left = alive.where("node != top.node").select("bucket", "node", "mass")
        if not compared:
            break
        edges = written(_verified(pairs, sets, least), "near-edges")
        linked = edges.count()
        labels = components(labels, edges)
        discard(pairs, edges)
        if linked < _WORTH * compared:
            break
    # buckets that still hold more than one label beside their pivots
    alive = _open_members(left, labels)
    discard(*held)
    nodes = written(alive.groupBy("node", "label").agg(F.max(F.col("label") != F.col("top.label")).alias("open")), "near-nodes")
    elements = element_rows(texts.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), weighted)
    discard(alive)
    pairs = rare_pairs(elements, nodes, least)
    edges = written(_verified(pairs, sets, least), "near-edges")
    discard(pairs, nodes, sets)
    labels = components(labels, edges)
    discard(edges)
    return labels


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY, weighted: bool = True) -> DataFrame:
    """(key, text_class, near_class) of every row: the least keys of the rows with an equal
    text and of the rows linked to them by texts of a similarity of at least ``least``."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(F.col(key).alias("key"), F.unhex(F.md5(F.encode(body, "UTF-8"))).alias("node"), body.alias("text"))
    sketched = written(sketches(rows, weighted), "near-sketches")
    classes = written(sketched.groupBy("node").agg(F.min("key").alias("text_class"), F.first("bands").alias("bands")), "near-classes")
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(buckets.join(sizes, "bucket"), "near-buckets")
    mass = shared.groupBy("node").agg(F.sum("size").alias("mass"))
    members = written(shared.select("bucket", "node").join(mass, "node"), "near-members")
    discard(shared)
    wanted = members.select("node").distinct().join(classes.select("node", "text_class"), "node")
    texts = rows.join(wanted, (rows["node"] == wanted["node"]) & rows["key"].eqNullSafe(wanted["text_class"])).select(rows["node"], "text")
    labels = linked_texts(members, texts, least, weighted)
    linked = classes.select("node", "text_class").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = linked.groupBy("label").agg(F.min("text_class").alias("near_class"))
    linked = linked.join(named, "label").select("node", "text_class", "near_class")
    return sketched.select("key", "node").join(linked, "node").select("key", "text_class", "near_class")
