"""Lines that many documents share, dropped everywhere but in one document.

Texts are split at ``\\n``; a line's key is the line without ASCII white space at
both ends, A-Z lowered.  A key of at least ``least_chars`` code points found in at
least ``least_documents`` documents loses all its lines but those in the largest
document id that holds it.  All of it is DataFrame functions:

1. Each text is exploded to its lines, of which two 64-bit hashes (128 bits)
   of the key, the position and a 128-bit digest of the text stay.  They are
   written once; the text itself is not shuffled for the counts.
2. Documents are counted by (hash, document), then by hash: a line in a third of
   all documents arrives as one row from each task.
3. The common hashes are joined to the lines; Spark splits a common line's rows
   among tasks (skew join), or broadcasts the common hashes while they are few.
4. The positions to drop are gathered by document, and joined to the texts, which
   are put together again from the other positions in order.

Defined results: null and empty texts are one empty line; a text of which nothing
stays becomes empty; documents are told apart by their id, so rows with equal ids
count as one document, each with its own lines; rows without an id count as one
document with the least id; equal lines of one document are dropped or kept
together; an empty table gives an empty one; other columns pass through, columns
named like results are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.llm.common import quoted, written

LEAST_CHARS, LEAST_DOCUMENTS = 20, 3
_SPACE = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lowered."""
    bare = F.btrim(line, F.lit(_SPACE))
    # an ASCII line, the usual case, is lowered whole
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _two_hashes(value: Column) -> list[Column]:
    """128 bits: the second hash takes the seed that a first column leaves."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def _lines(rows: DataFrame, least_chars: int) -> DataFrame:
    """(id, t1, t2, at, h1, h2) of the lines whose keys are long enough."""
    body = F.coalesce(F.col("text"), F.lit(""))
    t1, t2 = _two_hashes(body)
    exploded = rows.select("id", t1.alias("t1"), t2.alias("t2"), F.posexplode(split_lines(F.col("text"))).alias("at", "line"))
    keyed = exploded.withColumn("line", line_key(F.col("line"))).where(F.char_length("line") >= least_chars)
    h1, h2 = _two_hashes(F.col("line"))
    return keyed.select("id", "t1", "t2", "at", h1.alias("h1"), h2.alias("h2"))


def common_lines(lines: DataFrame, least_documents: int) -> DataFrame:
    """(h1, h2, last): the hashes found in enough documents, and the largest id among these."""
    each = lines.select("h1", "h2", "id").distinct()
    return (each.groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.max("id").alias("last"))
            .where(F.col("documents") >= least_documents).select("h1", "h2", "last"))


def drop_common_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                      least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``df`` with the remaining ``text``, and ``n_lines`` (before) and ``n_dropped``."""
    kept = [F.col(f"row.{quoted(c)}").alias(c) for c in df.columns if c not in (text, "n_lines", "n_dropped")]
    # one struct holds the caller's columns, so that no name of this operator can clash with them
    rows = df.select(F.col(quoted(key)).alias("id"), F.col(quoted(text)).cast("string").alias("text"), F.struct("*").alias("row"))
    lines = written(_lines(rows.select("id", "text"), least_chars), "line-hashes")
    # written, so that the join shuffles both sides and Spark can split a common line's rows
    common = written(common_lines(lines, least_documents), "line-common")
    dropped = (lines.join(common, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
               .groupBy("id", "t1", "t2").agg(F.collect_set("at").alias("drop"))
               .withColumnsRenamed({"id": "d_id", "t1": "d1", "t2": "d2"}))
    t1, t2 = _two_hashes(F.coalesce(F.col("text"), F.lit("")))
    joined = (rows.withColumns({"t1": t1, "t2": t2})
              .join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("t1") == F.col("d1")) & (F.col("t2") == F.col("d2")), "left"))
    parts = split_lines(F.col("text"))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("drop")))
    left = F.when(F.col("drop").isNull(), F.coalesce(F.col("text"), F.lit(""))).when(F.size("drop") == F.size("parts"), F.lit("")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at(F.col("parts"), i + 1)), "\n"))
    return joined.withColumn("parts", parts).select(
        *kept, left.alias(text), F.size("parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))
