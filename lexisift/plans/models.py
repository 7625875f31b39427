"""Classifier queries, over full grids.

Fitting is iterative, so its outcome has no SQL equivalent; what follows from fitted weights
has one, see ``tests/test_scoring.py``. The cross-validation of the full grid, which three
queries report on, is run once for the same rows; everything else is fitted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators import classify as C
from lexisift.operators import features as X
from lexisift.operators import scoring as M
from lexisift.operators import splits as S
from lexisift.operators.search import parallel_fits
from lexisift.operators.selection import vector_entries
from lexisift.plans import corpora
from lexisift.plans.registry import query
from lexisift.plans.splitting import THREE_WAY, TWO_WAY

FOLDS = 3
COLUMNS = ["doc_id", "split", "category", "label"]
SELECTED = X.FeatureSpec(normalize="none")
LIGHT, HEAVY = f"top {K.SELECTED_FEATURES}", f"top {K.SELECTED_FEATURES_HEAVY}"


def _documents(spark: SparkSession, folder: str, parts) -> DataFrame:
    documents = corpora.documents(spark, folder, null_text="drop")
    return S.assign_splits(documents, "doc_id", [w for _, w in parts], [n for n, _ in parts])


def features(spark: SparkSession, folder: str) -> X.Features:
    """Feature stages fitted on the training part only; selected terms not yet normalized."""
    return X.fit_features(_documents(spark, folder, THREE_WAY), SELECTED,
                          keep=["doc_id", "split"], fit_on=F.col("split") == "train")


def _vectors(fitted: X.Features) -> DataFrame:
    return X.training_frame(fitted.frame, COLUMNS + ["features"])


def _part(frame: DataFrame, name: str) -> DataFrame:
    return frame.filter(F.col("split") == name)


def _baseline(rows: DataFrame):
    svm = C.linear_svm(features="scaled")
    return C.normalized_classifier(svm, "features", parallel_fits(rows.sparkSession)).fit(_part(rows, "train"))


def _tuned(rows: DataFrame, column: str = "features"):
    """Cross-validation of the full grid on the training part."""
    train = S.assign_folds(_part(rows, "train"), "doc_id", FOLDS)
    svm = C.linear_svm(features="scaled")
    return C.cross_validate(C.normalized_classifier(svm, column), C.svm_grid(svm), train, folds=FOLDS)


_SEARCHES: dict[tuple, tuple] = {}


def searched(spark: SparkSession, folder: str) -> tuple:
    """``(fitted features, vectors, search)`` of the full grid over the documents of a folder.

    Kept for the session under a digest of the rows, so changed tables are searched anew.
    """
    documents = corpora.documents(spark, folder, null_text="drop")
    digest = documents.agg(F.count(F.lit(1)), F.sum(F.xxhash64("doc_id", "category", "text").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, folder, *digest)
    if key not in _SEARCHES:
        _SEARCHES.clear()
        fitted = features(spark, folder)
        rows = _vectors(fitted)
        _SEARCHES[key] = fitted, rows, _tuned(rows)
    return _SEARCHES[key]


@query("svm_ovr_predict")
def predict(spark, folder):
    """Predicted category of every test document, from a table of weights."""
    fitted = features(spark, folder)
    rows = _vectors(fitted)
    normalizer, classifier = _baseline(rows).stages
    test = normalizer.transform(_part(rows, "test"))
    margins = M.margins(vector_entries(test, classifier.getFeaturesCol(), ["doc_id"]), test,
                        M.weight_table(spark, classifier), ["doc_id"])
    predictions = M.best_class(margins, ["doc_id"]).join(test.select("doc_id", "category"), "doc_id")
    return C.with_predicted_category(predictions, fitted.labels).select(
        "doc_id", "category", "predicted_category")


@query("cv_grid")
def cv_grid(spark, folder):
    return C.grid_report(spark, searched(spark, folder)[2])


@query("best_params")
def best_params(spark, folder):
    return C.best_parameters(spark, searched(spark, folder)[2])


@query("tuned_vs_base")
def tuned_vs_base(spark, folder):
    _, rows, tuned = searched(spark, folder)
    return C.compare_models(_part(rows, "test"), {"baseline": _baseline(rows), "tuned": tuned.bestModel})


@query("tvs_grid")
def tvs_grid(spark, folder):
    rows = _vectors(features(spark, folder)).filter(F.col("split") != "test")
    svm = C.linear_svm(features="scaled")
    return C.grid_report(spark, C.validate(C.normalized_classifier(svm, "features"), C.svm_grid(svm), rows,
                                           F.col("split") == "validation"))


@query("light_vs_heavy")
def light_vs_heavy(spark, folder):
    """2,000 against 500 selected terms, each tuned and tested on its own features."""
    fitted, rows, tuned = searched(spark, folder)
    light = C.compare_models(_part(rows, "test"), {LIGHT: tuned.bestModel})
    heavy = X.training_frame(X.reselect(fitted, K.SELECTED_FEATURES_HEAVY, fit_on=F.col("split") == "train"),
                             COLUMNS + ["heavy_selected"])
    return light.unionByName(C.compare_models(
        _part(heavy, "test"), {HEAVY: _tuned(heavy, "heavy_selected").bestModel}))


@query("draft_search")
def draft_search(spark, folder):
    """The draft grid on two folds of a quarter of the documents (the sampling operator)."""
    rows = _vectors(features(spark, folder))
    svm = C.linear_svm(features="scaled", max_iter=K.GRID_MAX_ITER_DRAFT[0])
    sample = S.assign_folds(S.sample_percent(rows, "doc_id", 25, seed=4242), "doc_id", 2)
    return C.grid_report(spark, C.cross_validate(
        C.normalized_classifier(svm, "features"), C.svm_grid(svm, **C.GRIDS["draft"]), sample, folds=2))


@query("tvs_text_grid")
def tvs_text_grid(spark, folder):
    """Features fitted inside the search, with the number of selected terms in the grid: 24 points."""
    train = _part(_documents(spark, folder, TWO_WAY), "train")
    held_out = S.bucket("doc_id", seed=43) >= 80
    return C.grid_report(spark, C.validate(*_text_search(), train.withColumn("held_out", held_out), F.col("held_out")))


def _text_search() -> tuple:
    svm = C.linear_svm()
    estimator = C.text_classifier(svm, X.FeatureSpec())
    selector = next(s for s in estimator.getStages() if s.hasParam("numTopFeatures"))
    return estimator, C.svm_grid(svm, selector=selector)
