"""WARC archives: written as text part-files by Spark, read back by boundary-chain verification.

Writing.  Each row becomes one record; rows whose payloads are equal and not
short are ``revisit`` records of the row with the largest key, without payload.
Spark's text writer, with the last line feed of a record as its separator,
produces the exact bytes on any Hadoop file system, under its commit protocol.

Reading.  Spark's text reader splits the files at the magic line and reads the
splits in parallel.  Every piece is only a *candidate* record: a payload may
hold the magic too.  A task emits for each candidate its own offset and its
successor's (from the header's length) and follows the successors inside its
split, so each candidate also knows where its chain leaves the split.  Pointer
jumping from the start of each file over those exits (rounds logarithmic in a
file's splits) finds the chains that are entered; candidates off them are
payload bytes.  Records cut by magic in their payload are put together from
their pieces.

Defined results: null payload: empty; null key: no key header, read back as
null; null URL: no target header; repeated rows: a record each, responses where
their key is the group's largest; an empty table: no records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geopulse.llm.common import written

MAGIC = "WARC/1.0\r\n"
#: Payloads shorter than this are always stored in full.
REVISIT_BYTES = 1000
#: Up to so many revisits (about 100 bytes each) go to every task; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def write_archives(df: DataFrame, path: str, key: str, url: str, payload: str,
                   min_revisit: int = REVISIT_BYTES) -> None:
    """Write one WARC record per row of ``df`` below ``path``."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    small = df.select(F.col(key).cast("long").alias("k"), F.sha1(F.encode(body, "UTF-8")).alias("digest"),
                      F.octet_length(body).cast("long").alias("size")).where(F.col("size") >= min_revisit)
    groups = small.groupBy("digest", "size").agg(F.max("k").alias("target"), F.count("*").alias("n")).where("n > 1")
    # only the rows of repeated payloads take part; the payloads stay out of this join
    revisits = (small.join(groups, ["digest", "size"]).where(~F.col("k").eqNullSafe(F.col("target")) & F.col("target").isNotNull())
                .select(F.col("k").alias("rk"), F.col("digest").alias("rdigest"), "target").distinct())
    revisits = written(revisits, "warc-revisits")
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha1(F.encode("body", "UTF-8")))
    rows = rows.join(revisits, F.col("k").eqNullSafe(F.col("rk")) & (F.col("digest") == F.col("rdigest")), "left")
    size = F.octet_length("body").cast("string")
    revisit = F.col("target").isNotNull()
    safe_url = F.regexp_replace(F.regexp_replace(F.regexp_replace("u", "%", "%25"), "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(line("X-Row-Key", F.col("k").cast("string")), F.lit("")),
        F.coalesce(line("WARC-Target-URI", safe_url), F.lit("")),
        line("WARC-Date", F.lit(_DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", size),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("X-Refers-To-Key", F.col("target").cast("string")))).otherwise(F.lit("")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size)),
        F.lit("\r\n"))
    record = F.concat(header, F.when(revisit, F.lit("")).otherwise(F.col("body")), F.lit("\r\n\r"))
    rows.select(record.alias("value")).write.option("lineSep", "\n").text(path)


_HEADER = re.compile(rb"((?:[A-Za-z-]+: [^\r\n]*\r\n)+)\r\n")
_PIECES = "file string, block long, rel long, size long, head long, length long, kind string, k long, url string, digest string, payload_size long, target long, sha string"
_FIELDS = {"kind": "warc-type", "url": "warc-target-uri", "digest": "warc-payload-digest"}
_NUMBERS = {"k": "x-row-key", "payload_size": "x-payload-length", "target": "x-refers-to-key", "length": "content-length"}


def _number(value: str | None) -> int | None:
    """A 64-bit integer; None for anything else."""
    number = int(value) if value and re.fullmatch(r"-?[0-9]{1,19}", value) else None
    return number if number is not None and -1 << 63 <= number < 1 << 63 else None


def _parse(piece: bytes) -> dict:
    """Header of a candidate (the bytes after the magic); without a usable one ``head`` is None."""
    row = dict.fromkeys(("head", "sha", *_FIELDS, *_NUMBERS))
    if m := _HEADER.match(piece):
        head = dict(x.split(": ", 1) for x in m[1].decode("utf-8", "replace").split("\r\n")[:-1])
        head = {name.lower(): value for name, value in head.items()}
        row |= {name: head.get(field) for name, field in _FIELDS.items()}
        row |= {name: _number(head.get(field)) for name, field in _NUMBERS.items()}
        if row["length"] is not None and 0 <= row["length"] < 1 << 62:  # offsets beyond stay 64-bit integers
            row["head"] = m.end()
            body = piece[m.end():m.end() + row["length"]]
            if len(body) == row["length"]:
                row["sha"] = hashlib.sha1(body).hexdigest()
    return row


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, offset from the block's first piece, bytes) in reading order."""
    at: tuple | None = None
    rel = 0
    for batch in batches:
        for value, file, block in zip(batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            piece = value.as_py()
            if (file, block) != at:
                at, rel = (file, block), 0
            yield file, block, rel, piece
            rel += len(piece) + len(MAGIC)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.int64() if kind == "long" else pa.string())
                        for name, kind in (x.split() for x in _PIECES.split(", "))])
    rows: list[dict] = []
    for file, block, rel, piece in _placed(batches):
        rows.append({"file": file, "block": block, "rel": rel, "size": len(piece)} | _parse(piece))
        if len(rows) == 2000:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where each candidate's chain of successors leaves its split."""
    pdf = pdf.sort_values("off").reset_index(drop=True)
    exit_of: dict[int, int] = {}
    for off, succ in zip(pdf["off"].to_numpy()[::-1], pdf["succ"].to_numpy()[::-1], strict=True):
        exit_of[off] = exit_of.get(succ, succ)
    return pd.DataFrame({"file": pd.Series(pdf["file"].tolist(), dtype=object), "block": pdf["block"].to_numpy(),
                         "off": pdf["off"].to_numpy(), "exit": np.array([exit_of[x] for x in pdf["off"]], np.int64)})


def _entered(key: tuple, nodes: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """Candidates of a split on a chain that begins at one of its entered offsets."""
    succ = dict(zip(nodes["off"], nodes["succ"], strict=True))
    found: list[int] = []
    seen: set[int] = set()
    for off in entries["off"]:
        while off in succ and off not in seen:
            seen.add(off)
            found.append(off)
            off = succ[off]
    return pd.DataFrame({"file": pd.Series([key[0]] * len(found), dtype=object), "block": np.full(len(found), key[1], np.int64), "off": np.array(found, np.int64)})


def _reach(nodes: DataFrame, starts: DataFrame, label: str) -> DataFrame:
    """Entry offsets (file, off) reachable from the starts, by pointer jumping over exits."""
    exits = nodes.groupBy("file", "block").applyInPandas(_exits, "file string, block long, off long, exit long")
    exits = written(exits, f"{label}-exits")
    targets = exits.select("file", F.col("exit").alias("off")).union(starts.select("file", "off")).distinct()
    jump = written(exits.join(targets, ["file", "off"], "left_semi").select("file", "off", "exit"), f"{label}-jump")
    reached, known = written(starts.select("file", "off"), f"{label}-reached"), -1
    while (now := reached.count()) != known:
        known = now
        ahead = reached.join(jump, ["file", "off"]).select("file", F.col("exit").alias("off"))
        reached = written(reached.union(ahead).distinct(), f"{label}-reached")
        second = jump.select("file", F.col("off").alias("exit"), F.col("exit").alias("further"))
        jump = written(jump.join(second, ["file", "exit"], "left")
                       .select("file", "off", F.coalesce("further", "exit").alias("exit")), f"{label}-jump")
    return reached


def _bytes_with_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, block, rel, piece in _placed(batches):
        yield pa.RecordBatch.from_pydict({"file": [file], "block": pa.array([block], pa.int64()),
                                          "rel": pa.array([rel], pa.int64()), "size": pa.array([len(piece)], pa.int64()),
                                          "piece": pa.array([piece], pa.binary())})


def _join_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
    """SHA-1 of one record's payload, put together from its pieces."""
    pdf = pdf.sort_values("off")
    head, length = int(pdf["head"].iloc[0]), int(pdf["length"].iloc[0])
    body = MAGIC.encode().join(bytes(x) for x in pdf["piece"])[head:head + length]
    digest = hashlib.sha1(body).hexdigest() if len(body) == length else None
    return pd.DataFrame({"file": pd.Series([pdf["file"].iloc[0]], dtype=object), "owner": [int(pdf["owner"].iloc[0])],
                         "joined": pd.Series([digest], dtype=object)})


def _with_offsets(pieces: DataFrame) -> DataFrame:
    """Pieces of one scan with the offset in the file of the magic before each; without a file's first piece, which has none."""
    totals = pieces.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return (pieces.join(bases, ["file", "block"]).withColumn("off", F.col("base") + F.col("rel") - len(MAGIC))
            .where("off >= 0").drop("base", "size"))


def _joined(spark: SparkSession, path: str, placed: DataFrame, records: DataFrame) -> DataFrame:
    """(file, owner, joined): digests of the kept records whose payload holds the magic."""
    kept = records.select("file", "off", F.col("off").alias("kept"), F.col("head").alias("h"), F.col("length").alias("n"),
                          F.col("sha").isNull().alias("cut"))
    upto = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kept").isNotNull(), F.struct("kept", "h", "n", "cut")), ignorenulls=True).over(upto)
    wanted = (placed.select("file", "off").join(kept, ["file", "off"], "left").withColumn("o", owner)
              .where("o.cut").select("file", "off", F.col("o.kept").alias("owner"),
                                     F.col("o.h").alias("head"), F.col("o.n").alias("length")))
    wanted = written(wanted, "warc-wanted")
    # another scan may split the files elsewhere, so it is written once and gets offsets of its own
    files = wanted.select("file").distinct()
    lines = _lines(spark, path).join(F.broadcast(files), "file", "left_semi").select("value", "file", "block")
    lines = written(lines.mapInArrow(_bytes_with_place, "file string, block long, rel long, size long, piece binary"), "warc-bytes")
    lines = _with_offsets(lines).select("file", "off", "piece")
    return (lines.join(wanted, ["file", "off"]).groupBy("file", "owner")
            .applyInPandas(_join_pieces, "file string, owner long, joined string"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: key, url, record_type, payload_bytes,
    payload_digest (computed anew for stored payloads), refers_to, and place (file, offset)."""
    pieces = written(_lines(spark, path).mapInArrow(_candidates, _PIECES), "warc-pieces")
    placed = _with_offsets(pieces).withColumn("succ", F.col("off") + len(MAGIC) + F.col("head") + F.col("length") + 4)
    placed = written(placed, "warc-placed")
    nodes = placed.where("head is not null").select("file", "block", "off", "succ")
    reached = _reach(nodes, nodes.where("off = 0"), "warc").join(nodes, ["file", "off"])
    reached = written(reached.select("file", "block", "off"), "warc-entered")
    kept = (nodes.groupBy("file", "block").cogroup(reached.groupBy("file", "block"))
            .applyInPandas(_entered, "file string, block long, off long"))
    records = written(placed.join(kept, ["file", "block", "off"], "left_semi"), "warc-records")
    if not records.where("sha is null").isEmpty():
        joined = _joined(spark, path, placed, records).withColumnRenamed("owner", "off")
        records = records.join(joined, ["file", "off"], "left").withColumn("sha", F.coalesce("sha", "joined"))
    stored = F.col("kind") == "response"
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%0A", "\n"), "%0D", "\r"), "%25", "%")
    return records.select(
        F.col("k").alias("key"), url.alias("url"), F.col("kind").alias("record_type"),
        F.when(stored, F.col("length")).otherwise(F.col("payload_size")).alias("payload_bytes"),
        F.when(stored, F.col("sha")).otherwise(F.regexp_replace("digest", "^sha1:", "")).alias("payload_digest"),
        F.col("target").alias("refers_to"), "file", F.col("off").alias("offset"))
