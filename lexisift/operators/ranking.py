"""Top-K terms per category and global orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexisift.functions import constants as K


def top_terms(scored: DataFrame, k: int = K.TOP_K) -> DataFrame:
    """``(category, rank, term, chi2)``, score descending, ties by term.

    The rank filter lets each task keep only its own best K per category before the
    shuffle, so a category that owns most rows sends no more than the others.
    """
    order = Window.partitionBy("category").orderBy(F.col("chi2").desc(), F.col("term").asc())
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("category", "rank", "term", "chi2"))


def order_by_category(scored: DataFrame) -> DataFrame:
    """Global order: category, then score descending, then term."""
    return scored.orderBy(F.col("category").asc(), F.col("chi2").desc(), F.col("term").asc())


def ranked_lists(top: DataFrame) -> DataFrame:
    """The ranking as one array per category; its length is bounded by the K of the ranking."""
    entry = F.struct("rank", "term", "chi2")
    return (top.groupBy("category").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
            .select("category", F.transform("entries", lambda e: F.struct(
                e["term"].alias("term"), e["chi2"].alias("chi2"))).alias("terms")))
