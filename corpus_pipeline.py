"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.decontaminate import contamination
from lexisift.llm.language import known_language
from lexisift.llm.line_dedup import dedup_lines
from lexisift.llm.near_dedup import near_duplicates
from lexisift.llm.packing import pack
from lexisift.llm.tables import table
from lexisift.session import shared_folder


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select(F.col("doc_id").alias("gone")).distinct(), F.col("doc_id") == F.col("gone"), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognizable language go."""
    return known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are cut from later documents; those left without words go.

    ``n_chars``, where there is one, follows the text.
    """
    cut = dedup_lines(docs)
    kept = cut.where("n_deleted = 0 or length(trim(text)) > 0")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text"))
                               .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest ``doc_id`` of each group of near-duplicates stays."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return _without(docs, contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("minhash_near_dedup", minhash_near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
