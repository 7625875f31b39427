import pickle

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexisift.operators import classify as C
from lexisift.operators import together as T


@pytest.fixture(scope="module")
def rows(spark):
    """Noisy classes; sparse, dense and empty vectors, a constant feature and a row without label."""
    random = np.random.default_rng(5)
    found = []
    for i in range(400):
        label = i % 3
        x = np.round(random.normal(size=8) + 0.8 * (np.arange(8) % 3 == label), 3) * (random.random(8) < 0.6)
        x[7] = 1.0
        vector = Vectors.dense(x) if i % 5 == 0 else Vectors.sparse(8, x.nonzero()[0].tolist(), x[x.nonzero()].tolist())
        found.append((None if i == 17 else float(label), Vectors.sparse(8, [], []) if i % 50 == 9 else vector))
    return spark.createDataFrame(found, ["label", "features"]).repartition(3).cache()


def test_weights_are_those_of_sparks_fits(rows):
    svm = C.linear_svm()
    stage = C.one_vs_rest(svm)
    points = [*C.svm_grid(svm, [0.01, 1.0], [True, False], [3, 12]), {svm.fitIntercept: False, svm.regParam: 0.0, svm.maxIter: 8}]
    for point, own in zip(points, T.fit_together([stage.copy(p) for p in points], rows), strict=True):
        for a, b in zip(own.models, stage.fit(rows, point).models, strict=True):
            assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), rel=1e-6, abs=1e-9)
            assert a.intercept == pytest.approx(b.intercept, rel=1e-6, abs=1e-9)
            assert {p.name: v for p, v in a.extractParamMap().items()} == {p.name: v for p, v in b.extractParamMap().items()}


def test_a_grid_takes_as_many_passes_as_its_longest_fit(rows, monkeypatch):
    passes = []
    summed = T.hinge_sums
    monkeypatch.setattr(T, "hinge_sums", lambda blocks, weights, *rest: passes.append(weights.shape[1]) or summed(blocks, weights, *rest))
    svm = C.linear_svm()
    stage = C.one_vs_rest(svm)
    alone = []
    for point in (points := C.svm_grid(svm, [0.01, 0.1, 1.0], [True, False], [2, 10])):
        passes.clear()
        T.fit_together([stage.copy(point)], rows)
        alone.append(len(passes))
    passes.clear()
    T.fit_together([stage.copy(p) for p in points], rows)
    # One by one a grid point looks ahead further; iterations are shared, so 18 fits for 36.
    assert len(passes) <= 3 * max(alone) and max(passes) <= T.WIDTH and passes[0] == 18


def test_the_search_leaves_no_fit_to_jobs_of_its_own(rows, monkeypatch):
    monkeypatch.setattr(LinearSVC, "_fit", lambda *_: pytest.fail("a chain of jobs for one fit"))
    svm = C.linear_svm()
    tuned = C.validate(C.one_vs_rest(svm), C.svm_grid(svm, [0.01, 0.1], [True], [2, 4]),
                       rows.where("label is not null").withColumn("held_out", F.size(F.unwrap_udt("features").values) % 2 == 0), F.col("held_out"))
    assert len(tuned.avgMetrics) == 4 and len(tuned.bestModel.models) == 3


def test_blocks_are_bounded_and_whole(monkeypatch):
    batch = pa.record_batch({"label": pa.array(range(6), pa.float64()),
                             "indices": pa.array([[0, 3], [], [1], [2, 4, 7], [0], [5]], pa.list_(pa.int32())),
                             "values": pa.array([[1.0, 2.0], [], [3.0], [4.0, 5.0, 6.0], [7.0], [8.0]], pa.list_(pa.float64()))})
    monkeypatch.setattr(T, "CELLS", 12)
    back = []
    for found in T._packed(iter([batch.slice(1)]), 8):
        labels, present, place, value = pickle.loads(found.column(0)[0].as_py())
        dense = np.zeros((len(labels), 8))
        part = np.zeros(len(labels) * len(present))
        part[place] = value
        dense[:, present] = part.reshape(len(labels), len(present))
        assert dense[:, present].size <= 12
        back += [(label, *line) for label, line in zip(labels, dense)]
    assert [r[0] for r in back] == [1, 2, 3, 4, 5]
    assert back[2][1:] == (0, 0, 4, 0, 5, 0, 0, 6) and back[0][1:] == (0,) * 8


def test_values_that_are_not_finite_are_refused(spark):
    bad = spark.createDataFrame([(0.0, Vectors.dense([1.0])), (1.0, Vectors.dense([float("nan")]))], ["label", "features"])
    with pytest.raises(Exception, match="finite"):
        T.fit_together([C.one_vs_rest(C.linear_svm())], bad)


def test_a_search_is_measured_in_common_passes(rows, monkeypatch):
    """The metrics of all points come from counts of their predictions, which are those of Spark's model."""
    from lexisift.operators import search as S
    labelled = rows.where("label is not null").withColumn("held_out", F.size(F.unwrap_udt("features").values) % 2 == 0)
    stage = C.one_vs_rest(svm := C.linear_svm())
    points = C.svm_grid(svm, [0.01, 1.0], [True, False], [3])
    fitted = T.weights_together([stage.copy(p) for p in points], rows)
    monkeypatch.setattr(T, "COLUMNS", 7)
    counts = T.confusion_counts(labelled, "features", "label", fitted)
    for model, found in zip(T.fit_together([stage.copy(p) for p in points], rows), counts, strict=True):
        expected = model.transform(labelled).groupBy("label", "prediction").count().collect()
        assert sorted(found) == sorted(tuple(map(float, row)) for row in expected)
    by_rows = C.search(stage, points, labelled, [F.col("held_out")], predict=lambda model, part: model.transform(part))
    monkeypatch.setattr(S, "_fitted", lambda last, *_, fit=S._fitted: fit(last, *_) if not made.append(last) else None)
    made = []
    by_counts = C.validate(stage, points, labelled, F.col("held_out"))
    assert by_counts.avgMetrics == pytest.approx(by_rows.avgMetrics, abs=1e-12) and len(made) == 1
    with pytest.raises(Exception, match="labels"):
        T.confusion_counts(rows, "features", "label", fitted)


def test_rows_of_a_label_share_blocks(monkeypatch):
    """Columns that only one label has are not multiplied with the rows of others."""
    n = 64
    batch = pa.record_batch({"label": pa.array([i % 2 for i in range(n)], pa.float64()),
                             "indices": pa.array([[i % 2 * 500 + i // 2] for i in range(n)], pa.list_(pa.int32())),
                             "values": pa.array([[1.0]] * n, pa.list_(pa.float64()))})
    monkeypatch.setattr(T, "CELLS", 16)
    blocks = [pickle.loads(b.column(0)[0].as_py()) for b in T._packed(iter([batch]), 1000)]
    assert sum(len(b[0]) for b in blocks) == n and all(len({*b[0]}) == 1 for b in blocks)


def test_sums_are_the_same_by_driver_and_tree(rows, monkeypatch):
    blocks = T.packed(rows, "features", "label", 8)
    weights, intercepts, classes = np.arange(24.0).reshape(8, 3) / 7 - 1, np.array([0.1, 0.0, -0.3]), np.arange(3.0)
    own = T.hinge_sums(blocks, weights, intercepts, classes)
    monkeypatch.setattr(T, "DRIVER_BYTES", 0)
    for a, b in zip(own, T.hinge_sums(blocks, weights, intercepts, classes), strict=True):
        assert a == pytest.approx(b, rel=1e-12)
    blocks.unpersist()
