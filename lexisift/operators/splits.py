"""Reproducible splits and samples.

The split of a row is a function of its id and a seed, so it stays the same under
any partitioning and after a retried task. ``random_split`` is the plain Spark form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 100


def bucket(key: str, seed: int, buckets: int = BUCKETS) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")


def assign_splits(df: DataFrame, key: str, weights: Sequence[int], names: Sequence[str],
                  seed: int = 42, column: str = "split") -> DataFrame:
    """Add the split name; ``weights`` are whole percentages summing to 100."""
    if sum(weights) != BUCKETS or len(weights) != len(names):
        raise ValueError("weights must sum to 100 and match the names")
    number = bucket(key, seed)
    upper, branch = 0, None
    for weight, name in zip(weights, names):
        upper += weight
        branch = (F.when(number < upper, name) if branch is None else branch.when(number < upper, name))
    return df.withColumn(column, branch)


def assign_nested_splits(df: DataFrame, key: str, seed: int = 42,
                         inner_seed: int = 43) -> DataFrame:
    """80/20 into rest and test, then the rest 75/25 into train and validation."""
    outer = F.when(bucket(key, seed) < 80, "rest").otherwise("test")
    inner = F.when(bucket(key, inner_seed) < 75, "train").otherwise("validation")
    return df.withColumn("split", F.when(outer == "test", "test").otherwise(inner))


def split_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def sample_percent(df: DataFrame, key: str, percent: int, seed: int = 42) -> DataFrame:
    """The sampling operator: the rows of ``percent`` of the id buckets."""
    return df.filter(bucket(key, seed) < percent)


def assign_folds(df: DataFrame, key: str, folds: int, seed: int = 42,
                 column: str = "fold") -> DataFrame:
    return df.withColumn(column, bucket(key, seed, folds))


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)
