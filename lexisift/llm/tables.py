"""Reading tables and other small things that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def blocks_for(rows: int, rows_per_block: int) -> int:
    """How many blocks of about ``rows_per_block`` rows hold ``rows``; at least one."""
    return max(1, -(-rows // rows_per_block))
