"""Applying fitted one-vs-rest linear models without Python on the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INTERCEPT = -1    # the feature index of a class's intercept in a table of weights


def _arg_max(margins: Column) -> Column:
    """The first class with the largest margin, as a double."""
    return (F.array_position(margins, F.array_max(margins)) - 1).cast("double")


def predicted(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` with ``prediction``: the class with the largest margin, of equals the first.

    ``OneVsRestModel`` combines its classes in a Python function per row; here each class's
    own model and the comparison run in the JVM. Stages in front of the classifier are applied.
    """
    if isinstance(model, PipelineModel):
        *before, model = model.stages
        rows = reduce(lambda df, stage: stage.transform(df), before, rows)
    if not isinstance(model, OneVsRestModel):
        return model.transform(rows)
    kept, margins = rows.columns, []
    for k, binary in enumerate(model.models):
        raw, ignored = f"raw_of_class_{k}", f"prediction_of_class_{k}"
        binary = binary.copy({binary.featuresCol: model.getFeaturesCol(), binary.rawPredictionCol: raw, binary.predictionCol: ignored})
        rows = binary.transform(rows)
        margins.append(F.get(vector_to_array(raw), F.lit(1)))
    return rows.withColumn("prediction", _arg_max(F.array(*margins))).select(*kept, "prediction")


def weight_table(spark: SparkSession, model: OneVsRestModel) -> DataFrame:
    """``(class, feature_index, weight)`` of the weights that are not zero, intercepts under -1.

    Bounded by classes times selected features, which the fitted model holds on the driver.
    """
    classes, indices, weights = [], [], []
    for k, binary in enumerate(model.models):
        coefficients = binary.coefficients.toArray()
        at = coefficients.nonzero()[0]
        classes += [k] * (len(at) + 1)
        indices += [INTERCEPT, *at.tolist()]
        weights += [float(binary.intercept), *coefficients[at].tolist()]
    return spark.createDataFrame(pa.table({
        "class": pa.array(classes, pa.int32()), "feature_index": pa.array(indices, pa.int32()),
        "weight": pa.array(weights, pa.float64())}))


def margins(entries: DataFrame, documents: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., class, margin)`` of every document and class.

    ``entries`` are ``(keys..., feature_index, value)`` of the vectors, ``documents`` has the keys.
    A document without entries has the intercepts as margins. Products are summed per
    document and class before anything is shuffled.
    """
    products = (entries.join(weights, "feature_index")
                .select(*keys, "class", (F.col("value") * F.col("weight")).alias("part")))
    # One pair per class, written out in every document's row.
    intercepts = (weights.where(F.col("feature_index") == INTERCEPT)
                  .agg(F.collect_list(F.struct("class", F.col("weight").alias("part")))).scalar())
    bases = documents.select(*keys, F.explode(intercepts).alias("base")).select(*keys, "base.class", "base.part")
    return (products.unionByName(bases).groupBy(*keys, "class").agg(F.sum("part").alias("margin")))


def best_class(margin_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., prediction)``: the class with the largest margin, of equals the first."""
    best = F.max_by("class", F.struct("margin", (-F.col("class")).alias("earlier")))
    return margin_rows.groupBy(*keys).agg(best.cast("double").alias("prediction"))
