"""Ranked and merged vocabularies, and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators.ranking import top_terms


def merged_vocabulary(scored: DataFrame, scope: str = "top", k: int = K.TOP_K) -> DataFrame:
    """Distinct terms of the per-category top K, or of all scored terms."""
    if scope not in ("top", "all"):
        raise ValueError(f"scope must be 'top' or 'all', got {scope!r}")
    rows = top_terms(scored, k) if scope == "top" else scored
    return rows.select("term").distinct()


def common_terms(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("term").intersect(right.select("term"))


def terms_only_in_first(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("term").subtract(right.select("term"))


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of common and exclusive terms; the percentage is of the second list."""
    marked = (left.select("term", F.lit(1).alias("in_left"), F.lit(0).alias("in_right"))
              .unionByName(right.select("term", F.lit(0).alias("in_left"), F.lit(1).alias("in_right")))
              .groupBy("term").agg(F.max("in_left").alias("l"), F.max("in_right").alias("r")))
    counts = marked.agg(
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("common"),
        F.coalesce(F.sum(F.col("l") * (1 - F.col("r"))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum((1 - F.col("l")) * F.col("r")), F.lit(0)).alias("only_right"))
    right_size = F.col("common") + F.col("only_right")
    return counts.withColumn("overlap_pct", F.when(
        right_size > 0, F.round(F.col("common").cast("double") / right_size * 100, 2)))


def document_frequencies(frequencies: DataFrame, min_df: float = 1) -> DataFrame:
    """``(term, df, cf)`` from ``(document, term, n)`` rows: documents and occurrences."""
    return (frequencies.groupBy("term")
            .agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("cf"))
            .filter(F.col("df") >= min_df))


def vocabulary_table(frequencies: DataFrame, size: int = K.VOCABULARY_SIZE,
                     min_df: float = K.MIN_DOCUMENT_FREQUENCY) -> DataFrame:
    """The ``size`` most frequent terms, ties by term; rows come in no order."""
    return most_frequent(document_frequencies(frequencies, min_df), size)


def most_frequent(counted: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows ``(term, df, cf)`` with the highest ``cf``, ties by term.

    A histogram gives the frequency at which the running number of terms reaches
    ``size``, a second one, of the terms with just that frequency, the first letters.
    Everything before that point is in, and only the terms at it are ranked. The windows
    see one row per distinct frequency, of which N occurrences allow sqrt(2 N), and
    one per beginning of a word.
    """
    terms = counted.withColumn("start", F.substring("term", 1, 4))
    at = _reached(terms.groupBy("cf").agg(F.count(F.lit(1)).alias("terms")),
                  "cf", F.col("cf").desc(), F.lit(size))
    tied = F.col("cf") == at["cf"]
    within = _reached(terms.filter(tied).groupBy("start").agg(F.count(F.lit(1)).alias("terms")),
                      "start", F.col("start").asc(), at["left"])
    before = F.coalesce((F.col("cf") > at["cf"]) | (tied & (F.col("start") < within["start"])), F.lit(True))
    last = (terms.filter(tied & (F.col("start") == within["start"])).orderBy("term").limit(size)
            .withColumn("place", F.row_number().over(Window.orderBy("term")))
            .filter(F.col("place") <= within["left"]).drop("place"))
    return terms.filter(before).unionByName(last).drop("start")


def _reached(levels: DataFrame, level: str, order: Column, wanted: Column) -> Column:
    """The level at which ``terms``, summed in ``order``, reach ``wanted``, and how many of
    its own terms that takes (``left``); null if they never do."""
    running = levels.withColumn("running", F.sum("terms").over(Window.orderBy(order)))
    left = (wanted - F.col("running") + F.col("terms")).alias("left")
    return (running.filter(F.col("running") >= wanted)
            .agg(F.min_by(F.struct(level, left), "running").alias("reached")).scalar())
