"""Predictions from a table of weights, against Spark's own model and against SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lexisift.operators import classify as C
from lexisift.operators import features as X
from lexisift.operators import scoring as M
from lexisift.operators.selection import vector_entries

RECOMPUTED = """
WITH parts AS (
  SELECT doc_id, class, value * weight AS part FROM entries JOIN weights USING (feature_index)
  UNION ALL SELECT doc_id, class, weight FROM documents CROSS JOIN weights WHERE feature_index = -1),
margins AS (SELECT doc_id, class, sum(part) AS margin FROM parts GROUP BY doc_id, class)
SELECT doc_id, arg_max(class, (margin, -class)) AS class FROM margins GROUP BY doc_id ORDER BY doc_id
"""


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, "abcd"[i % 4 if i % 9 else 0], " ".join(f"{'abcd'[(i + i // 7) % 4]}{'xyzu'[i * k % 4]}" for k in range(1, 6)))
            for i in range(200)] + [(1000, "a", "unheard of")]
    documents = spark.createDataFrame(rows, "doc_id long, category string, text string")
    fitted = X.fit_features(documents, X.FeatureSpec(stop_words=(), min_df=2, selected=12), keep=["doc_id"])
    rows = X.training_frame(fitted.frame, ["doc_id", "category", "label", "features"])
    return rows, C.one_vs_rest(C.linear_svm(max_iter=6)).fit(rows)


def test_predictions_equal_the_models_own(scored):
    rows, model = scored
    plain = {r.doc_id: r.prediction for r in model.transform(rows).collect()}
    assert {r.doc_id: r.prediction for r in M.predicted(model, rows).collect()} == plain
    assert set(M.predicted(model, rows).columns) == {*rows.columns, "prediction"}
    assert len(set(plain.values())) > 2


def test_table_of_weights_equals_the_models_own_and_sql(spark, scored):
    rows, model = scored
    entries = vector_entries(rows, "features", ["doc_id"])
    weights = M.weight_table(spark, model)
    found = M.best_class(M.margins(entries, rows, weights, ["doc_id"]), ["doc_id"])
    got = {r.doc_id: r.prediction for r in found.collect()}
    assert got == {r.doc_id: r.prediction for r in model.transform(rows).collect()}
    assert 1000 in got and entries.where("doc_id = 1000").count() == 0
    connection = duckdb.connect()
    for name, frame in (("entries", entries), ("weights", weights), ("documents", rows.select("doc_id"))):
        connection.register(name, frame.toArrow())
    assert dict(connection.execute(RECOMPUTED).fetchall()) == got


def test_equal_margins_go_to_the_first_class(spark):
    weights = spark.createDataFrame([(0, -1, 0.5), (1, -1, 0.5), (2, -1, 0.25), (2, 7, 1.0)], "class int, feature_index int, weight double")
    entries = spark.createDataFrame([(1, 7, 0.25), (2, 7, 0.75), (2, 8, 5.0)], "doc_id long, feature_index int, value double")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    found = M.best_class(M.margins(entries, rows, weights, ["doc_id"]), ["doc_id"])
    assert {r.doc_id: r.prediction for r in found.collect()} == {1: 0.0, 2: 2.0, 3: 0.0}
    assert M.margins(entries, rows, weights, ["doc_id"]).where(F.col("margin").isNull()).count() == 0
