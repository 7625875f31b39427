"""Classification quality."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluator(label: str = "label", prediction: str = "prediction",
              metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName=metric)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``; combined before the shuffle, so hot labels cost nothing."""
    return (df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_scores(matrix: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of every true label.

    One aggregate over the matrix: each cell counts once for its label and once for
    its prediction.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = (matrix.select(F.col("label").alias("class"), F.col("n").alias("support"),
                           zero.alias("predicted"), hit.alias("hits"))
             .unionByName(matrix.select(F.col("prediction").alias("class"), zero.alias("support"),
                                        F.col("n").alias("predicted"), zero.alias("hits"))))
    totals = sides.groupBy("class").agg(
        *[F.sum(c).cast("double").alias(c) for c in ("support", "predicted", "hits")])
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    both = F.col("precision") + F.col("recall")
    return (totals.filter(F.col("support") > 0)
            .select("class", "support", precision.alias("precision"), recall.alias("recall"))
            .withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both)
                        .otherwise(0.0)))


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 averaged with the label supports as weights."""
    scores = class_scores(confusion_matrix(df, label, prediction))
    return scores.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))
