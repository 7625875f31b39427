import pytest
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from lexisift.operators import classify as C
from lexisift.operators import evaluate as E
from lexisift.operators import features as X
from lexisift.operators import splits as S
from lexisift.operators.search import parallel_fits, side_by_side


@pytest.fixture(scope="module")
def frame(spark):
    words = {"a": "red apple pie", "b": "blue pear tart", "c": "green fig cake"}
    rows = [(i, "abc"[i % 3], words["abc"[i % 3]] + " " + "xyz"[i % 2] * 3) for i in range(90)]
    documents = S.assign_folds(spark.createDataFrame(
        rows, "doc_id long, category string, text string"), "doc_id", 2)
    spec = X.FeatureSpec(stop_words=(), selected=6, normalize="none")
    fitted = X.fit_features(documents, spec, keep=["doc_id", "fold"])
    return fitted, X.training_frame(fitted.frame, ["doc_id", "fold", "category", "label", "features"])


def test_grids_have_their_sizes(spark):
    svm = C.linear_svm()
    assert len(C.svm_grid(svm)) == 12
    assert len(C.svm_grid(svm, selector=X.selector_stage(2000))) == 24
    assert {name: len(C.svm_grid(svm, **grid)) for name, grid in C.GRIDS.items()} == {
        "full": 12, "long": 12, "draft": 12, "iterations": 2}


def test_cross_validation_and_reports(spark, frame):
    fitted, rows = frame
    svm = C.linear_svm(features="scaled", max_iter=5)
    grid = C.svm_grid(svm, [0.01, 0.1], [True], [5])
    tuned = C.cross_validate(C.normalized_classifier(svm, "features"), grid, rows, folds=2)
    report = C.grid_report(spark, tuned)
    assert report.count() == 2 and report.filter("best").count() == 1
    best = C.best_parameters(spark, tuned).first()
    assert best.metric == max(C.grid_metrics(tuned))
    compared = C.compare_models(rows, {"tuned": tuned.bestModel}).collect()
    assert {r.metric: r.value for r in compared} == {"f1": 1.0, "accuracy": 1.0}
    named = C.with_predicted_category(tuned.bestModel.transform(rows), fitted.labels)
    assert named.filter("category <> predicted_category").count() == 0


@pytest.fixture(scope="module")
def mixed(spark):
    """Documents whose category shows in some words only, so that points differ."""
    rows = []
    for i in range(150):
        own = " ".join(f"{'abc'[i % 3]}{'xyzuvw'[(i * k) % 6]}" for k in range(1, 3 if i % 4 else 1))
        rows.append((i, "abc"[i % 3 if i % 11 else 0], f"{own} " + " ".join(f"w{'xyzuvw'[(i * k) % 6]}{'pq'[i // k % 2]}" for k in range(1, 9))))
    return S.assign_folds(spark.createDataFrame(rows, "doc_id long, category string, text string"), "doc_id", 2)


def test_search_equals_sparks_cross_validation(spark, mixed):
    """The same folds, points, metrics and winner as Spark's search over the whole pipeline."""
    spec = X.FeatureSpec(stop_words=(), min_df=1)
    svm = C.linear_svm(max_iter=4)
    estimator = C.text_classifier(svm, spec)
    selector = next(s for s in estimator.getStages() if s.hasParam("numTopFeatures"))
    grid = C.svm_grid(svm, [0.01, 1.0], [True], [2, 4], selector, [3, 12])
    own = C.cross_validate(estimator, grid, mixed, folds=2)
    plain = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=E.evaluator(), numFolds=2,
                           foldCol="fold", parallelism=4).fit(mixed)
    assert own.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-9)
    assert len(set(own.avgMetrics)) > 1
    assert own.best == max(range(8), key=plain.avgMetrics.__getitem__)
    a, b = (m.transform(mixed).select("doc_id", "prediction").collect() for m in (own.bestModel, plain.bestModel))
    assert sorted(a) == sorted(b)
    # Two folds: the vectorizer and its weights once each, the selector once per setting.
    assert own.fits == {"RankedVectorizer": 2, "IDF": 2, "ContingencySelector": 4}


def test_a_held_out_part_by_hash_ignores_partitioning(spark, mixed):
    spec = X.FeatureSpec(stop_words=(), min_df=1, selected=12)
    found = []
    for partitions in (1, 4, 50):
        svm = C.linear_svm(max_iter=4)
        rows = mixed.repartition(partitions).withColumn("held_out", S.bucket("doc_id", 43) >= 70)
        tuned = C.validate(C.text_classifier(svm, spec), C.svm_grid(svm, [0.01, 1.0], [True, False], [4]), rows, F.col("held_out"))
        assert C.grid_report(spark, tuned).count() == 4
        found.append([round(m, 9) for m in C.grid_metrics(tuned)])
    assert found[0] == found[1] == found[2]


def test_fits_run_side_by_side_in_pools(spark):
    def pool():
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    assert sorted(set(side_by_side(spark, [pool] * 6, 3))) == ["fits-0", "fits-1", "fits-2"]
    assert side_by_side(spark, []) == [] and pool() is None
    assert parallel_fits(spark) >= 4
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 / 0])


def test_weighted_f1_and_accuracy_equal_the_evaluator(spark):
    rows = [(float(i % 4), float((i * i + i // 7) % 4)) for i in range(500)] + [(4.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    assert E.weighted_f1(df).first().f1 == pytest.approx(E.evaluator().evaluate(df), abs=1e-12)
    assert E.accuracy(df).first().accuracy == pytest.approx(
        E.evaluator(metric="accuracy").evaluate(df), abs=1e-12)


def test_splits_cover_all_rows_and_ignore_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    def assigned(frame):
        return {r.doc_id: r.split for r in S.assign_splits(
            frame, "doc_id", [60, 20, 20], ["train", "validation", "test"]).collect()}
    first = assigned(df)
    assert len(first) == 2000 and first == assigned(df.repartition(7))
    sizes = {r.split: r.rows for r in S.split_sizes(
        S.assign_splits(df, "doc_id", [60, 20, 20], ["train", "validation", "test"])).collect()}
    assert sum(sizes.values()) == 2000 and 1100 < sizes["train"] < 1300
    nested = {r.split for r in S.assign_nested_splits(df, "doc_id").collect()}
    assert nested == {"train", "validation", "test"}
    assert 0 < S.sample_percent(df, "doc_id", 1).count() < 50
    with pytest.raises(ValueError):
        S.assign_splits(df, "doc_id", [60, 20], ["train", "test"])


def test_random_forms(spark):
    df = spark.range(1000)
    parts = S.random_split(df, [0.8, 0.2])
    assert sum(p.count() for p in parts) == 1000
    assert 0 < S.random_sample(df, 0.1).count() < 250


def test_folds(spark):
    folds = S.assign_folds(spark.range(100), "id", 3).agg(F.collect_set("fold").alias("f")).first().f
    assert sorted(folds) == [0, 1, 2]
