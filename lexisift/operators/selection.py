"""Chi-square feature selection for any number of distinct values, as an ML stage.

The statistic of every feature comes from its observed cells (value, category), so
continuous values cost one row each instead of a matrix, and no limit on distinct values is
needed. P-values are compared by their logarithms, which do not underflow.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Places that statistics, values and logarithms of p-values are rounded to, so
# that what is equal by definition is equal in every order of summation.
STATISTIC_PLACES = 6
VALUE_PLACES = 12
LOGARITHM_PLACES = 9
# Fixed value: p-values below it are equal, as they are where they are one minus a double.
LEAST_P = 2.0**-53
# Fixed value: with more categories than these, cells are rows instead of columns.
MOST_COLUMNS = 16


def log_upper_gamma(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """log Q(shape, x), the regularized upper incomplete gamma function, elementwise.

    Below ``shape + 1`` from the power series of its complement, above from the continued
    fraction (Lentz); both run until no element changes, about sqrt(shape) steps.
    """
    shape, x = np.broadcast_arrays(np.asarray(shape, float), np.asarray(x, float))
    out = np.zeros(shape.shape)
    front = shape * np.log(np.maximum(x, 1e-300)) - x - np.vectorize(math.lgamma, otypes=[float])(shape)
    low = (x > 0) & (x < shape + 1)
    if low.any():
        a, y = shape[low], x[low]
        term = total = 1 / a
        n = 0
        while (term > total * 1e-17).any():
            n += 1
            term = term * y / (a + n)
            total = total + term
        out[low] = np.log1p(-np.minimum(np.exp(front[low]) * total, 1 - 2.0**-53))
    high = x >= shape + 1
    if high.any():
        a, y = shape[high], x[high]
        b = y + 1 - a
        c, d = np.full(a.shape, 1e300), 1 / b
        h, n, step = d, 0, np.zeros(a.shape)
        while (abs(step - 1) > 1e-15).any():
            n += 1
            factor, b = -n * (n - a), b + 2
            d = 1 / (factor * d + b)
            c = b + factor / c
            step = c * d
            h = h * step
        out[high] = front[high] + np.log(h)
    return out


@F.pandas_udf(DoubleType())
def _log_p(degrees: pd.Series, statistic: pd.Series) -> pd.Series:
    return pd.Series(log_upper_gamma(degrees.to_numpy(float) / 2, statistic.to_numpy(float) / 2))


def with_log_p(statistics: DataFrame, least_p: float = LEAST_P) -> DataFrame:
    """Add ``log_p`` to rows with ``statistic`` and ``degrees``, one per feature.

    Zero degrees of freedom give 0, a p-value of one. P-values below ``least_p`` are equal;
    0 tells all apart.
    """
    statistic = F.greatest(F.round("statistic", STATISTIC_PLACES), F.lit(0.0))
    log_p = F.when(F.col("degrees") > 0, _log_p(F.greatest("degrees", F.lit(1)), statistic)).otherwise(0.0)
    least = F.lit(math.log(least_p) if least_p > 0 else -math.inf)
    return statistics.withColumn("log_p", F.round(F.greatest(log_p, least), LOGARITHM_PLACES))


def contingency_statistics(entries: DataFrame, rows: DataFrame, feature: str, value: str,
                           category: str = "category") -> DataFrame:
    """``(feature, df, statistic, degrees)``: each feature against the category.

    ``entries`` are the values that are not zero, ``(feature, value, category)`` per row of
    ``rows``, which has the categories. The contingency table of a feature has one line per
    distinct value, zero included, and one column per category. With O the cells, R the line
    and C the column totals the statistic is ``N * (sum O^2 / (R C) - 1)``, to which empty
    cells add nothing; the line of zeros follows from the totals. So only observed cells
    are ever built. Rows without a category are left out.
    """
    per_category = (rows.where(F.col(category).isNotNull()).groupBy(F.col(category).alias("category"))
                    .agg(F.count(F.lit(1)).alias("c")))
    few = [(row.category, row.c) for row in per_category.limit(MOST_COLUMNS + 1).collect()]
    if 0 < len(few) <= MOST_COLUMNS:
        n, labels = F.lit(float(sum(c for _, c in few))), F.lit(len(few))
        lines = _by_columns(entries, few, feature, value, category)
    else:
        totals = per_category.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("labels"))
        n, labels = totals.select("n").scalar().cast("double"), totals.select("labels").scalar()
        lines = _by_cells(entries, per_category, feature, value, category)
    df = F.col("df")
    absent = F.when(n > df, (n - 2.0 * df + F.col("z")) / (n - df)).otherwise(0.0)
    count = F.col("lines") + F.when(n > df, 1).otherwise(0)
    return lines.select(
        F.col("feature").alias(feature), df.cast("bigint").alias("df"),
        (n * (F.col("present") + absent - 1.0)).alias("statistic"),
        ((count - 1) * (labels - 1)).cast("bigint").alias("degrees"))


def _by_columns(entries: DataFrame, categories: list[tuple], feature: str, value: str, category: str) -> DataFrame:
    """``(feature, present, lines, df, z)``, each line of a table one row with a column per category.

    So the entries are shuffled once, by feature and value, after lines that occur often are combined.
    """
    names = [f"o{k}" for k in range(len(categories))]
    observed = [F.count(F.when(F.col(category) == F.lit(label), 1)).cast("double").alias(name)
                for name, (label, _) in zip(names, categories)]
    table = (entries.where(F.col(feature).isNotNull()).groupBy(F.col(feature).alias("feature"), F.col(value).alias("value"))
             .agg(*observed))
    total = sum((F.col(name) for name in names), F.lit(0.0))
    weighted = sum((F.col(name) * F.col(name) / F.lit(float(c)) for name, (_, c) in zip(names, categories)), F.lit(0.0))
    return (table.where(total > 0).groupBy("feature")
            .agg(F.sum(weighted / total).alias("present"), F.count(F.lit(1)).alias("lines"),
                 *[F.sum(name).alias(name) for name in names])
            .select("feature", "present", "lines", total.alias("df"), weighted.alias("z")))


def _by_cells(entries: DataFrame, per_category: DataFrame, feature: str, value: str, category: str) -> DataFrame:
    """The same for any number of categories, each observed cell one row."""
    cells = (entries.groupBy(F.col(feature).alias("feature"), F.col(value).alias("value"), F.col(category).alias("category"))
             .agg(F.count(F.lit(1)).alias("o")).join(per_category, "category"))
    o, c = F.col("o").cast("double"), F.col("c").cast("double")
    by_value = (cells.groupBy("feature", "value")
                .agg((F.sum(o * o / c) / F.sum(o)).alias("part"))
                .groupBy("feature").agg(F.sum("part").alias("present"), F.count(F.lit(1)).alias("lines")))
    by_category = (cells.groupBy("feature", "category").agg(F.sum(o).alias("p"), F.max(c).alias("c"))
                   .groupBy("feature").agg(F.sum("p").alias("df"),
                                           F.sum(F.col("p") * F.col("p") / F.col("c")).alias("z")))
    return by_value.join(by_category, "feature")


def vector_entries(rows: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """``(keep..., feature_index, value)`` of the entries that are not zero, of sparse or dense vectors."""
    unpacked = rows.select(*keep, F.unwrap_udt(vector).alias("v"))
    indices = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
    present = F.when(F.size("v.values") > 0, F.arrays_zip(indices.alias("i"), F.col("v.values").alias("x")))
    return (unpacked.select(*keep, F.explode(present).alias("e"))
            .select(*keep, F.col("e.i").alias("feature_index"), F.col("e.x").alias("value")).where("value <> 0"))


def vector_size(rows: DataFrame, vector: str) -> int:
    """The length of the vectors, 0 without rows."""
    first = rows.where(F.col(vector).isNotNull()).select(F.unwrap_udt(vector).alias("v")).select(
        F.coalesce("v.size", F.size("v.values"))).first()
    return 0 if first is None else first[0]


class _SelectorParams(HasFeaturesCol, HasOutputCol, HasLabelCol):
    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "features to select", TypeConverters.toInt)
    places = Param(Params._dummy(), "places", "decimal places at which values count as equal", TypeConverters.toInt)
    leastP = Param(Params._dummy(), "leastP", "p-values below it are equal", TypeConverters.toFloat)

    def getNumTopFeatures(self) -> int:
        return self.getOrDefault(self.numTopFeatures)


class ContingencySelector(Estimator, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Selects the features with the smallest chi-square p-values, ties by feature index.

    Features are categorical, as for ``ChiSqSelector``, but may have any number of
    distinct values. The driver sees the selected indices only.
    """

    @keyword_only
    def __init__(self, *, numTopFeatures: int = 50, featuresCol: str = "features", outputCol: str = "selected",
                 labelCol: str = "label", places: int = VALUE_PLACES, leastP: float = LEAST_P):
        super().__init__()
        self._setDefault(numTopFeatures=50, featuresCol="features", outputCol="selected", labelCol="label",
                         places=VALUE_PLACES, leastP=LEAST_P)
        self._set(**self._input_kwargs)

    def ranked(self, dataset: DataFrame) -> DataFrame:
        """``(feature_index, df, statistic, degrees, log_p)`` of the features with values that are not zero."""
        label, vector = self.getLabelCol(), self.getFeaturesCol()
        rounded: Column = F.round("value", self.getOrDefault(self.places))
        entries = vector_entries(dataset.where(F.col(label).isNotNull()), vector, [label]).withColumn("value", rounded)
        statistics = contingency_statistics(entries, dataset, "feature_index", "value", label)
        return with_log_p(statistics, self.getOrDefault(self.leastP))

    def _fit(self, dataset: DataFrame) -> ContingencySelectorModel:
        size = vector_size(dataset, self.getFeaturesCol())
        wanted = min(self.getNumTopFeatures(), size)
        best = self.ranked(dataset).where("log_p < 0").orderBy("log_p", "feature_index").limit(wanted)
        chosen = [row.feature_index for row in best.select("feature_index").collect()]
        # The others have a p-value of one, and so go by their index.
        taken = set(chosen)
        rest = (i for i in range(size) if i not in taken)
        chosen += [next(rest) for _ in range(wanted - len(chosen))]
        return self._copyValues(ContingencySelectorModel(sorted(chosen)))


class ContingencySelectorModel(Model, _SelectorParams):
    """Keeps the selected features, in the order of their indices."""

    def __init__(self, selectedFeatures: list[int] | None = None):
        super().__init__()
        self.selectedFeatures = list(selectedFeatures or [])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(),
                            indices=self.selectedFeatures).transform(dataset)
