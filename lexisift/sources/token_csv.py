"""Tokenized documents stored as CSV with a list literal per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.functions.terms import clean_tokens, parse_list_literal

CORRUPT = "_corrupt_record"
PREVIEW_CHARACTERS = 100


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line."""
    return spark.read.option("header", True).csv(path).columns


def read_token_csv(spark: SparkSession, path: str, tokens: str = "reviewText_tokens",
                   category: str = "category", columns: Sequence[str] = (),
                   header: bool = True) -> DataFrame:
    """Every row with its parsed ``tokens`` and a ``reject`` reason (null when valid).

    Pass ``columns`` to skip header discovery, and ``header=False`` with it for files
    without a header line. A row with another number of fields
    than the header, an empty field or an unreadable list is marked, not lost.
    """
    if not header and not columns:
        raise ValueError("files without a header need the column names")
    names = list(columns) or csv_columns(spark, path)
    for name in (tokens, category):
        if name not in names:
            raise ValueError(f"column {name!r} is not in the header {names}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    rows = (spark.read.schema(schema).option("header", header).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("quote", '"').option("escape", '"').option("multiLine", False).csv(path))
    # Exploding a one-element array keeps the parse from being repeated in later filters.
    parsed = rows.select("*", F.explode(
        F.array(parse_list_literal(F.col(tokens)))).alias("parsed_tokens"))
    reason = (F.when(F.col(CORRUPT).isNotNull(), "column count")
              .when(F.col(category).isNull() | (F.col(category) == "")
                    | F.col(tokens).isNull() | (F.col(tokens) == ""), "empty field")
              .when(F.col("parsed_tokens").isNull(), "token list"))
    others = [n for n in names if n not in (tokens, category)]
    return parsed.select(
        *others, F.col(category).alias("category"),
        clean_tokens(F.col("parsed_tokens")).alias("tokens"), reason.alias("reject"),
        F.when(reason.isNotNull(), F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*names)))).alias("line"))


def valid_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject").isNull()).drop("reject", "line")


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rejects with their reason, the whole line and its first characters.

    A line with the right number of fields is written anew from them.
    """
    return rows.filter(F.col("reject").isNotNull()).select(
        "reject", F.substring("line", 1, PREVIEW_CHARACTERS).alias("preview"), "line")
