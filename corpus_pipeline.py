"""Corpus pipeline: documents to a clean, deduplicated, tokenised training set.

Every stage takes and returns whole tables.  A document is a row; rows with null
or repeated ids are documents of their own.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.llm import dart_minhash, piece_bpe, quality_qda, suffix_decontam, suffix_merge
from geopulse.llm.common import crc_mod, quoted, settings, table, written
from geopulse.llm.queries import PIECE_MODEL


#: Python gets few rows at a time, as texts can be long.  A setting of the pipeline's session: a stage's result is
#: computed when its caller writes it.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


def _small_batches(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for k, v in SMALL_BATCHES.items():
            spark.conf.set(k, v)
        return stage(spark, docs, sf_dir)

    return run_stage


@_small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled rows, does not reject."""
    model = quality_qda.fit_on(docs, table(spark, sf_dir, "labels").where(crc_mod("doc_id", 3) != 1))
    return quality_qda.with_score(docs, model).where("quality_score >= 0.5").drop("quality_score")


@_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least id, of each group of near copies."""
    # written once: every scan would number the rows anew, by the splits it happens to get
    numbered = written(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "pipeline-numbered")
    keyed = numbered.select(F.struct(F.col("doc.doc_id").alias("doc_id"), "row").alias("key"), F.col("doc.text").alias("text"))
    classes = dart_minhash.near_duplicates(keyed, "key", "text")
    first = written(classes.where("key.row = near_class.row").select("key.row"), "pipeline-first")
    return numbered.join(first, "row", "left_semi").select("doc.*")


#: Passages of more than 50 words are longer than this in any of the languages; op3's own query takes 400 bytes.
PASSAGE_BYTES = 280


@_small_batches
def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that repeat elsewhere; a character that is cut goes."""
    text = suffix_merge.remove_repeats(docs, length=PASSAGE_BYTES, window=PASSAGE_BYTES // 2, as_text=True).withColumnRenamed("kept_text", "text")
    if "n_chars" in docs.columns:
        text = text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return text.select(*map(quoted, docs.columns))


@_small_batches
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return suffix_decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_small_batches
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids and the text decoded from them."""
    return piece_bpe.encode_texts(docs, PIECE_MODEL)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("repeat_dedup", repeat_dedup),
          ("decontaminate", decontaminate), ("tokenize", tokenize)]
#: No stage but the fourth can be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    with settings(spark.conf, SMALL_BATCHES):  # put back at the end
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
