"""One-vs-rest linear SVM: building, tuning and reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import IndexToString, Normalizer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators.evaluate import evaluator
from lexisift.operators.features import FeatureSpec, feature_stages
from lexisift.operators.scoring import predicted
from lexisift.operators.search import SearchResult, search, side_by_side

# The other grids, for ``svm_grid(svm, **GRIDS[name])``.
GRIDS = {
    "full": dict(reg_param=K.GRID_REG_PARAM, standardization=K.GRID_STANDARDIZATION,
                 max_iter=K.GRID_MAX_ITER),
    "long": dict(reg_param=K.GRID_REG_PARAM, standardization=K.GRID_STANDARDIZATION,
                 max_iter=K.GRID_MAX_ITER_LONG),
    "draft": dict(reg_param=K.GRID_REG_PARAM_DRAFT, standardization=K.GRID_STANDARDIZATION,
                  max_iter=K.GRID_MAX_ITER_DRAFT),
    "iterations": dict(reg_param=(0.01,), standardization=(True,), max_iter=K.GRID_MAX_ITER_LONG),
}


def linear_svm(features: str = "features", label: str = "label",
               max_iter: int = K.SVM_MAX_ITER, reg_param: float = K.SVM_REG_PARAM,
               standardization: bool = True) -> LinearSVC:
    return LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter,
                     regParam=reg_param, standardization=standardization)


def one_vs_rest(svm: LinearSVC, parallelism: int = 1) -> OneVsRest:
    """``parallelism`` is for a single fit; a search runs its own fits side by side."""
    return OneVsRest(classifier=svm, featuresCol=svm.getFeaturesCol(),
                     labelCol=svm.getLabelCol(), parallelism=parallelism)


def normalized_classifier(svm: LinearSVC, features: str, parallelism: int = 1) -> Pipeline:
    """L2 normalization of ``features`` into the SVM's input, then one-vs-rest."""
    return Pipeline(stages=[Normalizer(inputCol=features, outputCol=svm.getFeaturesCol(), p=2.0),
                            one_vs_rest(svm, parallelism)])


def text_classifier(svm: LinearSVC, spec: FeatureSpec = FeatureSpec()) -> Pipeline:
    """Text to prediction in one pipeline, so tuning fits the features inside each fold."""
    return Pipeline(stages=[*feature_stages(spec), one_vs_rest(svm)])


def svm_grid(svm: LinearSVC, reg_param: Sequence[float] = K.GRID_REG_PARAM,
             standardization: Sequence[bool] = K.GRID_STANDARDIZATION,
             max_iter: Sequence[int] = K.GRID_MAX_ITER,
             selector=None, num_features: Sequence[int] = K.GRID_NUM_FEATURES) -> list:
    """12 points by default; 24 with a selector whose feature count is tuned as well."""
    builder = ParamGridBuilder()
    if selector is not None:
        builder = builder.addGrid(selector.numTopFeatures, list(num_features))
    return (builder.addGrid(svm.regParam, list(reg_param))
            .addGrid(svm.standardization, list(standardization))
            .addGrid(svm.maxIter, list(max_iter)).build())


def cross_validate(estimator: Estimator, grid: list, train: DataFrame, folds: int = 3,
                   label: str = "label", metric: str = "f1", fold_column: str = "fold",
                   parallelism: int | None = None) -> SearchResult:
    """K-fold search over the folds 0 to ``folds - 1`` of ``fold_column``, such as ``assign_folds`` gives.

    What the points have in common is fitted once per fold, see ``search``.
    """
    parts = [F.col(fold_column) == i for i in range(folds)]
    return search(estimator, grid, train, parts, label, metric, parallelism, predicted)


def validate(estimator: Estimator, grid: list, train: DataFrame, held_out: Column,
             label: str = "label", metric: str = "f1", parallelism: int | None = None) -> SearchResult:
    """Search with one held-out part, the rows for which the condition holds.

    A condition on a column, such as a split by hash, gives the same parts under every partitioning.
    """
    return search(estimator, grid, train, [held_out], label, metric, parallelism, predicted)


def grid_metrics(tuned: SearchResult) -> list[float]:
    return tuned.avgMetrics


def grid_report(spark: SparkSession, tuned: SearchResult) -> DataFrame:
    """One row per grid point: its parameters, its metric and whether it won."""
    rows = []
    for i, (point, metric) in enumerate(zip(tuned.points, tuned.avgMetrics)):
        values = {param.name: value for param, value in point.items()}
        rows.append((i, values.get("regParam"), values.get("standardization"),
                     values.get("maxIter"), values.get("numTopFeatures"), float(metric), i == tuned.best))
    return spark.createDataFrame(rows, "point int, reg_param double, standardization boolean, "
                                       "max_iter int, num_features int, metric double, best boolean")


def best_parameters(spark: SparkSession, tuned: SearchResult) -> DataFrame:
    return grid_report(spark, tuned).filter("best").drop("best")


def with_predicted_category(predictions: DataFrame, labels: Sequence[str],
                            prediction: str = "prediction") -> DataFrame:
    return IndexToString(inputCol=prediction, outputCol="predicted_category",
                         labels=list(labels)).transform(predictions)


def compare_models(test: DataFrame, models: dict[str, Model], label: str = "label",
                   metrics: Sequence[str] = ("f1", "accuracy")) -> DataFrame:
    """One ``(model, metric, value)`` row per model and metric on the same test rows."""
    def measured(name: str) -> list[tuple]:
        predictions = predicted(models[name], test).select(label, "prediction").persist()
        rows = [(name, metric, evaluator(label, metric=metric).evaluate(predictions)) for metric in metrics]
        predictions.unpersist()
        return rows

    spark = test.sparkSession
    found = side_by_side(spark, [lambda name=name: measured(name) for name in models])
    return spark.createDataFrame([row for rows in found for row in rows], "model string, metric string, value double")
