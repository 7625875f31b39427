"""Text lines of the ranked terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.functions.formats import FORMATS


def category_lines(top: DataFrame, number: str = "fixed", brackets: bool = False) -> DataFrame:
    """``category t1:v1 ... tK:vK`` per category.

    A category's list is bounded by the K of the ranking, and the ranking has already
    placed each category's rows in one partition, so this adds no shuffle.
    """
    name = F.concat(F.lit("<"), "category", F.lit(">")) if brackets else F.col("category")
    entry = F.struct("rank", F.concat("term", F.lit(":"), FORMATS[number](F.col("chi2"))).alias("text"))
    return (top.groupBy("category").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
            .select("category", F.concat_ws(
                " ", name, F.array_join(F.col("entries.text"), " ")).alias("line")))


def vocabulary_line(terms: DataFrame, mark: str = "") -> DataFrame:
    """The sorted distinct terms as one line, after ``mark`` if one is wanted.

    One line is one row, so this is for lists that K and the categories bound, such as a
    merged top-K; ``write_terms`` writes a vocabulary of any size in sorted parts.
    """
    return terms.select("term").distinct().agg(F.sort_array(F.collect_list("term")).alias("terms")).select(
        F.concat(F.lit(mark), F.array_join("terms", " ")).alias("line"))


def report_lines(top: DataFrame, number: str = "fixed", brackets: bool = False, mark: str = "") -> DataFrame:
    """Category lines in alphabetical order, then the merged vocabulary line."""
    lines = category_lines(top, number, brackets).select(
        F.lit(0).alias("section"), "category", "line")
    merged = vocabulary_line(top, mark).select(F.lit(1).alias("section"), F.lit("").alias("category"), "line")
    return lines.unionByName(merged).orderBy("section", "category").select("line")


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows of an ordered frame, for display."""
    return df.limit(rows)
