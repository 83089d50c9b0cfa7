"""Trie of the conversations' common openings, by ROLLUP over positional turn columns.

A node is a distinct sequence of first turns (role, text).  A conversation is laid
out in blocks of ``BLOCK`` columns, one 128-bit turn id for each position; one

    GROUP BY block, key, ROLLUP(t0, ..., t7)

counts the conversations below every prefix of a block at once, and grouping_id
tells the prefix's length.  A longer conversation has further blocks, keyed by the
node at which the block before ends: a node's key is the exclusive or of the
hashes of (position, turn id) on its path (128 bits), so all keys are known
beforehand and all blocks are aggregated together.  A second ROLLUP sums what the
nodes add to their ancestors: each node's share is put on its smallest member, from
where it reaches all prefixes of that conversation.

No conversation is gathered in one place: turns are sorted by ranges, numbered in
each range, and a conversation that spans several ranges is continued by one row
for each of them, as are its keys.  The ids of the conversations that end at a
node are hashed as a stream of sorted pieces.

Defined results: turns are ordered by ``turn`` (null first), equal ones by the MD5 of
their role and text; null roles and texts are empty; repeated rows are turns of
their own; rows without a conversation id belong to no conversation and are left
out; an empty table has no node, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.llm.common import written

#: Turns in a block of columns.
BLOCK = 8
#: Blocks of a conversation whose sums are added up in one window; the windows are then added up in turn.
_SPAN = 1024
_NODE = ["depth", "a1", "a2"]
_ROW = (1 << 33) - 1


def _step(depth: Column, turn_id: Column) -> tuple[Column, Column]:
    """What a turn adds to the two halves of a node's key."""
    return F.xxhash64(depth.cast("long"), turn_id), F.xxhash64(F.lit(7), depth.cast("long"), turn_id)


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, seg, pos, len, id, words): each turn's place, from 1, among the ``len`` turns of its
    conversation, in segments of bounded size that follow each other, its 128-bit id and its words."""
    r, x = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, x).cast("binary"))).alias("id"),
        F.regexp_count(x, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("id")]
    # written once: the numbers of a range and its rows stay together
    sorted_rows = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv", "id", "words", F.spark_partition_id().alias("seg"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("at")),
        "trie-turns")
    own = Window.partitionBy("conv")
    segments = (sorted_rows.groupBy("conv", "seg").agg(F.min("at").alias("first"), F.count("*").alias("n"))
                .withColumns({"before": F.coalesce(F.sum("n").over(own.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                              "len": F.sum("n").over(own)}))
    return sorted_rows.join(segments, ["conv", "seg"]).select(
        "conv", "seg", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "len", "id", "words")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv, len) of every conversation that has a turn."""
    return turns.groupBy("conv").agg(F.max("len").alias("len"))


def with_shared_openings(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on another one's opening: (turns, lengths).

    Conversation c starts with the first h turns of conversation c - c % ``every``, h being
    crc32(c) % ``most``, and goes on with its own turns after its first h.
    """
    known = lengths(turns).withColumns({
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most, "base": F.col("conv") - F.col("conv") % every})
    bases = known.select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    taken = F.least("h", F.coalesce("base_len", F.lit(0)))
    convs = written(known.join(bases, "base", "left").withColumn("taken", taken).select(
        "conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("new_len")), "trie-convs")
    # by segment, so that a long conversation's turns are not joined by its id alone
    segments = turns.select("conv", "seg").distinct().join(convs.select("conv", "h", "taken", "new_len"), "conv")
    own = (turns.join(segments, ["conv", "seg"]).where("pos > h")
           .select("conv", "seg", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), F.col("new_len").alias("len"), "id", "words"))
    openings = turns.where(F.col("conv") % every == 0).where(F.col("pos") < most).select(F.col("conv").alias("base"), "pos", "id", "words")
    heads = (openings.join(convs.select("conv", "base", "taken", "new_len"), "base").where("pos <= taken")
             .select("conv", F.lit(-1).alias("seg"), "pos", F.col("new_len").alias("len"), "id", "words"))
    return own.unionByName(heads), convs.select("conv", F.col("new_len").alias("len"))


def _keyed(turns: DataFrame) -> DataFrame:
    """The turns with the key of the node before them (b1, b2) and of their own (a1, a2)."""
    s1, s2 = _step(F.col("pos"), F.col("id"))
    rows = turns.withColumns({"s1": s1, "s2": s2})
    carried = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = (rows.groupBy("conv", "seg").agg(F.bit_xor("s1").alias("s1"), F.bit_xor("s2").alias("s2"))
             .select("conv", "seg", *(F.coalesce(F.bit_xor(f"s{i}").over(carried), F.lit(0)).alias(f"c{i}") for i in (1, 2))))
    running = Window.partitionBy("conv", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keyed = rows.join(carry, ["conv", "seg"]).withColumns({f"a{i}": F.bit_xor(f"s{i}").over(running).bitwiseXOR(F.col(f"c{i}")) for i in (1, 2)})
    return keyed.withColumns({f"b{i}": F.col(f"a{i}").bitwiseXOR(F.col(f"s{i}")) for i in (1, 2)})


def _blocks(keyed: DataFrame) -> DataFrame:
    """(conv, block, k1, k2, t0.., w0..): a row for each block of a conversation."""
    at = (F.col("pos") - 1) % BLOCK
    cells = [F.max(F.when(at == i, F.col(c))).alias(f"{n}{i}") for i in range(BLOCK) for c, n in (("id", "t"), ("words", "w"))]
    start = [F.max(F.when(at == 0, F.col(f"b{i}"))).alias(f"k{i}") for i in (1, 2)]
    return keyed.groupBy("conv", F.floor((F.col("pos") - 1) / BLOCK).cast("long").alias("block")).agg(*start, *cells)


def _rolled_up(blocks: DataFrame, sums: str, names: list[str]) -> DataFrame:
    """One row for each prefix of a block, with its place in the trie and the aggregates ``sums``."""
    columns = [f"t{i}" for i in range(BLOCK)]
    rolled = blocks.sparkSession.sql(
        f"select block, k1, k2, {', '.join(columns)}, {BLOCK} - bit_count(grouping_id()) as size, {sums} "
        f"from {{blocks}} group by block, k1, k2, rollup({', '.join(columns)})", blocks=blocks)
    last = F.coalesce(*(F.when(F.col("size") == i + 1, F.col(f"t{i}")) for i in range(BLOCK)))
    # size 0 is the end of the block before; a null id is a conversation that ended earlier
    nodes = rolled.withColumns({"last": last, "depth": F.col("block") * BLOCK + F.col("size")}).where("size > 0 and last is not null")
    key = []
    for i in (0, 1):
        steps = [F.when(F.col("size") > p, _step(F.col("block") * BLOCK + p + 1, F.col(f"t{p}"))[i]).otherwise(F.lit(0)) for p in range(BLOCK)]
        key.append(reduce(lambda a, b: a.bitwiseXOR(b), steps, F.col(f"k{i + 1}")))
    return nodes.select("depth", "size", "last", key[0].alias("a1"), key[1].alias("a2"), *names)


def _at_size(name: str) -> Column:
    """The column of the prefix's last position."""
    return F.coalesce(*(F.when(F.col("size") == i + 1, F.col(f"{name}{i}")) for i in range(BLOCK)))


def _nodes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, a1, a2, p1, p2, conv_id, n_convs, words) of every node; p1, p2 is the parent's key."""
    words = [f"w{i}" for i in range(BLOCK)]
    rolled = _rolled_up(blocks, "min(conv) as conv_id, count(*) as n_convs, " + ", ".join(f"max({w}) as {w}" for w in words), ["conv_id", "n_convs", *words])
    s1, s2 = _step(F.col("depth"), F.col("last"))
    nodes = rolled.select("depth", "a1", "a2", F.col("a1").bitwiseXOR(s1).alias("p1"), F.col("a2").bitwiseXOR(s2).alias("p2"),
                          "conv_id", "n_convs", _at_size("w").alias("words"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("a1"), zero.alias("a2"), none.alias("p1"), none.alias("p2"), "conv_id", "n_convs", zero.alias("words"))
    return nodes.unionByName(root)


def _subtree_sums(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, a1, a2, n_leaves, saved_tokens) of every node but the root, from nodes with ``saved`` and ``leaf``."""
    at = (F.col("depth") - 1) % BLOCK
    shares = nodes.where("depth > 0 and (saved <> 0 or leaf <> 0)").groupBy(
        F.col("conv_id").alias("conv"), F.floor((F.col("depth") - 1) / BLOCK).cast("long").alias("block")).agg(
        *(F.sum(F.when(at >= i, F.col(c))).alias(f"{n}{i}") for i in range(BLOCK) for c, n in (("saved", "s"), ("leaf", "l"))))
    names = [f"{n}{i}" for n in "sl" for i in range(BLOCK)]
    own = (blocks.drop(*(f"w{i}" for i in range(BLOCK))).join(shares, ["conv", "block"], "left").fillna(0, names)
           .withColumn("span", F.floor(F.col("block") / _SPAN)))
    # what a conversation adds in its later blocks: first those of the same span, then the later spans
    later = lambda *keys: Window.partitionBy(*keys).rowsBetween(1, Window.unboundedFollowing)
    spans = own.groupBy("conv", "span").agg(F.sum("s0").alias("ss"), F.sum("l0").alias("ll"))
    spans = spans.select("conv", "span", *(F.coalesce(F.sum(c).over(later("conv").orderBy("span")), F.lit(0)).alias(c) for c in ("ss", "ll")))
    own = own.join(spans, ["conv", "span"])
    rest = {n: F.coalesce(F.sum(f"{n[0]}0").over(later("conv", "span").orderBy("block")), F.lit(0)) + F.col(n) for n in ("ss", "ll")}
    own = own.withColumns({"s_rest": rest["ss"], "l_rest": rest["ll"]})
    added = own.withColumns({n: F.col(n) + F.col(f"{n[0]}_rest") for n in names}).where("s0 <> 0 or l0 <> 0")
    rolled = _rolled_up(added.drop("s_rest", "l_rest", "ss", "ll", "span", "conv"), ", ".join(f"sum({n}) as {n}" for n in names), names)
    return rolled.select(*_NODE, _at_size("l").alias("n_leaves"), _at_size("s").alias("saved_tokens"))


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(depth, a1, a2, ends_sha256): SHA-256 of the ascending ids that end at a node, joined by commas.

    Sorted pieces are joined in the tasks of a range sort; one task then reads a node's
    pieces in order and holds one at a time.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            convs = batch.column(3).to_pylist()
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)] if len(keys) else []
            spans = list(zip(edges[:-1], edges[1:], strict=True))
            first = [a for a, _ in spans]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(keys[first, i], pa.int64()) for i in range(3)), pa.array([convs[a] for a in first], pa.int64()),
                 pa.array([",".join(map(str, convs[a:b])) for a, b in spans], pa.string())], names=[*_NODE, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def done(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k, _ in found], pa.int64()) for i in range(3)),
                                               pa.array([h for _, h in found], pa.string())], names=[*_NODE, "ends_sha256"])

        for batch in batches:
            found = []
            for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own == key:
                    state.update(b",")
                else:
                    if key is not None:
                        found.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                state.update(ids.encode())
            yield done(found)
        if key is not None:
            yield done([(key, state.hexdigest())])

    order = [*_NODE, "conv"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pieces, "depth long, a1 long, a2 long, first long, ids string")
    return joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(
        digests, "depth long, a1 long, a2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``turns`` are as :func:`numbered_turns` gives them, ``convs`` (conv, len) all conversations, also
    those without turns.  A node is the first ``depth`` turns of its smallest member ``conv_id``.
    """
    keyed = written(_keyed(turns), "trie-keyed")
    blocks = written(_blocks(keyed), "trie-blocks")
    nodes = written(_nodes(blocks, convs), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("a1"), F.col("p2").alias("a2")).agg(
        F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, _NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("words"),
        "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")}), "trie-nodes")
    zero = F.lit(0).cast("long")
    whole = nodes.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")).where("n_leaves > 0").select(
        zero.alias("depth"), zero.alias("a1"), zero.alias("a2"), "n_leaves", "saved_tokens")
    sums = _subtree_sums(blocks, nodes).unionByName(whole)
    ends = keyed.where("pos = len").select(F.col("pos").alias("depth"), "a1", "a2", "conv").unionByName(
        convs.where("len = 0").select(zero.alias("depth"), zero.alias("a1"), zero.alias("a2"), "conv"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a1").alias("p1"), F.col("a2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(sums, _NODE).join(hashed_ends(ends), _NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """:func:`prefix_trie` of the conversations as they are."""
    turns = numbered_turns(df, conv, turn, role, text)
    return prefix_trie(turns, lengths(turns))
