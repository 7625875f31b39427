"""Stop words, term lists and stored vocabularies."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.functions.stop_words import ENGLISH
from lexisift.functions.terms import strip as stripped

# A term with its score, as category lines list them.
_SCORED_ENTRY = r" \S+:-?[0-9][0-9.E-]*( |$)"


def read_words(spark: SparkSession, path: str, strip: bool = True) -> DataFrame:
    """One word per line -> distinct ``term`` rows."""
    word = stripped(F.col("value")) if strip else F.col("value")
    return (spark.read.text(path).select(word.alias("term"))
            .filter(F.col("term") != "").distinct())


def read_words_if_present(spark: SparkSession, path: str, strip: bool = True) -> DataFrame:
    """As ``read_words``, but a missing file is an empty list."""
    try:
        return read_words(spark, path, strip)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "term string")


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Terms of a stored vocabulary, whether one per line or blank-separated."""
    return (spark.read.text(path)
            .select(F.explode(F.split(F.trim("value"), r"\s+")).alias("term"))
            .filter(F.col("term") != "").distinct())


def read_report_vocabulary(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """Terms of the vocabulary line of a report.

    With the ``mark`` that the report was written with, the line is the one that starts
    with it, whatever its terms look like. Reports without a mark tell it by content: it
    has no ``term:score`` entry, so none of its terms may look like one.
    """
    lines = spark.read.text(path)
    if mark:
        lines = lines.filter(F.col("value").startswith(mark)).select(
            F.substring("value", len(mark) + 1, 2**31 - 1).alias("value"))
    else:
        lines = lines.filter(~F.col("value").rlike(_SCORED_ENTRY))
    return (lines.select(F.explode(F.split(F.trim("value"), r"\s+")).alias("term"))
            .filter(F.col("term") != "").distinct())


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    return list(ENGLISH)
