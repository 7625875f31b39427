"""Grid search over a pipeline that fits common beginnings of its points once.

The grid is a tree: points that agree in the parameters of the first stages share those
stages. Per part of the rows each stage is fitted once for every distinct setting of it and
the stages before it, the vectors that the last stage needs are written, and the last
stage is then fitted for all points side by side: linear SVMs are fitted and measured in common
passes over the vectors (``together``), others each by its own jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import count

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import StringIndexer
from pyspark.ml.param import Param
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lexisift.operators.arrow_terms import applied
from lexisift.operators.evaluate import evaluator
from lexisift.operators.scoring import predicted
from lexisift.operators.together import confusion_counts, fit_together, shares_passes, weights_together
from lexisift.operators.vectorize import RankedVectorizer
from lexisift.session import durable

HELD_OUT = "held_out_part"
MOST_FITS = 64    # threads of the driver that wait for fits

Point = dict[Param, object]


@dataclass(frozen=True)
class SearchResult:
    """Grid points, the metric of each in every part, and the best point fitted on all rows."""

    points: list[Point]
    metrics: list[list[float]]
    bestModel: Model
    fits: dict[str, int] = field(default_factory=dict)

    @property
    def avgMetrics(self) -> list[float]:
        return [sum(m) / len(m) for m in self.metrics]

    @property
    def best(self) -> int:
        """The best point; of equals the first."""
        averages = self.avgMetrics
        return max(range(len(averages)), key=averages.__getitem__)


def parallel_fits(spark: SparkSession) -> int:
    """Fits that keep the cluster busy: each is a chain of short jobs that mostly waits for
    the scheduler, so there are four to a core, at least four and at most ``MOST_FITS``."""
    return max(4, min(MOST_FITS, 4 * spark.sparkContext.defaultParallelism))


def side_by_side(spark: SparkSession, tasks: Sequence[Callable], parallelism: int | None = None) -> list:
    """Results of the tasks. Under fair scheduling every running one has a pool of its own."""
    pools = count()

    def pooled(task):
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fits-{next(pools) % workers}")
            return task()
        return inheritable_thread_target(spark)(run)

    workers = min(parallelism or parallel_fits(spark), max(len(tasks), 1))
    with ThreadPoolExecutor(workers) as executor:
        return [f.result() for f in [executor.submit(pooled(task)) for task in tasks]]


def _own(stage, point: Point) -> Point:
    """The parameters of a point that belong to a stage, or to the classifier in it."""
    owners = {stage.uid}
    if stage.hasParam("classifier") and stage.isDefined("classifier"):
        owners.add(stage.getOrDefault("classifier").uid)
    return {param: value for param, value in point.items() if param.parent in owners}


def _inputs(stage) -> list[str]:
    names = ("inputCol", "featuresCol", "labelCol")
    return [stage.getOrDefault(n) for n in names if stage.hasParam(n) and stage.isDefined(n)]


def _fitted(stage, rows: DataFrame, own: Point) -> Transformer:
    if shares_passes(stage):
        return fit_together([stage.copy(own)], rows)[0]
    return stage.fit(rows, own) if isinstance(stage, Estimator) else stage.copy(own)


@dataclass(frozen=True)
class _Leaf:
    """What the last stage is fitted on, for the points that share everything before it."""

    part: int
    frame: DataFrame
    points: list[int]


class _Tree:
    def __init__(self, stages: list, grid: list[Point]):
        self.stages, self.grid = stages, grid
        estimators = [i for i, s in enumerate(stages[:-1]) if isinstance(s, Estimator)]
        # Vectors replace text behind the first fitted stage, and are what the last one reads.
        self.written = {*estimators[:1], len(stages) - 2}
        self.fits: dict[str, int] = {}

    def leaves(self, part: int, frame: DataFrame, points: list[int], at: int = 0) -> list[_Leaf]:
        if at == len(self.stages) - 1:
            return [_Leaf(part, frame, points)]
        stage, found = self.stages[at], []
        for own, group in self.groups(stage, points):
            model = _fitted(stage, frame.where(f"not {HELD_OUT}"), own)
            if isinstance(stage, Estimator):
                name = type(stage).__name__
                self.fits[name] = self.fits.get(name, 0) + 1
            after = applied([model], frame)
            if at in self.written:
                rest = {c for s in self.stages[at + 1:] for c in _inputs(s)}
                after = durable(after.select([c for c in after.columns if c in rest | {HELD_OUT}]), "vectors", rebalance=True)
            found += self.leaves(part, after, group, at + 1)
        return found

    def groups(self, stage, points: list[int]) -> list[tuple[Point, list[int]]]:
        found: dict[tuple, tuple[Point, list[int]]] = {}
        for i in points:
            own = _own(stage, self.grid[i])
            key = tuple(sorted((param.name, value) for param, value in own.items()))
            found.setdefault(key, (own, []))[1].append(i)
        return list(found.values())


def search(estimator: Estimator, grid: list[Point], rows: DataFrame, parts: Sequence[Column],
           label: str = "label", metric: str = "f1", parallelism: int | None = None,
           predict: Callable[[Model, DataFrame], DataFrame] | None = None) -> SearchResult:
    """Fit all points on the rows outside each part, and measure them inside it.

    ``parts`` are conditions on the columns of ``rows``, such as a fold number, so the result
    does not depend on partitioning. A condition that is null leaves the row outside.
    Labels are indexed on all rows; every other stage sees the fitting rows only.
    ``predict`` replaces the last stage's own ``transform``.
    """
    spark = rows.sparkSession
    grid = grid or [{}]
    stages = list(estimator.getStages()) if isinstance(estimator, Pipeline) else [estimator]
    indexers = {i: s.fit(rows) for i, s in enumerate(stages) if isinstance(s, StringIndexer)}
    for model in indexers.values():
        rows = model.transform(rows)
    tree = _Tree([s for i, s in enumerate(stages) if i not in indexers], grid)
    common = []
    while len(tree.stages) > 1 and not isinstance(tree.stages[0], Estimator) and not any(
            _own(tree.stages[0], p) for p in grid):
        # What needs no fitting and is no parameter is the same for all parts.
        common, tree = [*common, tree.stages[0]], _Tree(tree.stages[1:], grid)
    words = common[-1].getOutputCol() if common and common[-1].hasParam("outputCol") else None
    readers = [s for s in tree.stages if words in _inputs(s)]
    rows = applied(common, rows, counted=bool(readers) and all(isinstance(s, RankedVectorizer) for s in readers))
    needed = {c for s in tree.stages for c in _inputs(s)}
    marks = [F.coalesce(part, F.lit(False)).alias(f"{HELD_OUT}_{i}") for i, part in enumerate(parts)]
    rows = durable(rows.select(*[c for c in rows.columns if c in needed], *marks), "search_rows", rebalance=True)
    names = [f"{HELD_OUT}_{i}" for i in range(len(parts))]

    def marked(i: int) -> DataFrame:
        return rows.withColumn(HELD_OUT, F.col(names[i])).drop(*names)

    last = tree.stages[-1]
    leaves = [leaf for found in side_by_side(spark, [
        lambda i=i: tree.leaves(i, marked(i), list(range(len(grid)))) for i in range(len(parts))], parallelism) for leaf in found]
    measured = evaluator(label, metric=metric)

    def counted(leaf: _Leaf) -> list[list[tuple]]:
        """The last stage fitted and applied for all points of the leaf, in common passes."""
        fitted = weights_together([last.copy(_own(last, grid[point])) for point in leaf.points], leaf.frame.where(f"not {HELD_OUT}"))
        return confusion_counts(leaf.frame.where(HELD_OUT), last.getFeaturesCol(), label, fitted)

    def of_counts(counts: list[tuple]) -> float:
        pairs = spark.createDataFrame(counts, f"`{label}` double, prediction double, n double").coalesce(1)
        return measured.copy({measured.weightCol: "n"}).evaluate(pairs)

    def of_rows(leaf: _Leaf, point: int) -> float:
        model, held_out = _fitted(last, leaf.frame.where(f"not {HELD_OUT}"), _own(last, grid[point])), leaf.frame.where(HELD_OUT)
        predictions = predict(model, held_out) if predict else model.transform(held_out)
        return measured.evaluate(predictions.select(label, "prediction"))

    at = [(leaf.part, point) for leaf in leaves for point in leaf.points]
    if shares_passes(last) and predict in (None, predicted):
        found = side_by_side(spark, [lambda leaf=leaf: counted(leaf) for leaf in leaves], parallelism)
        values = [lambda counts=counts: of_counts(counts) for of_leaf in found for counts in of_leaf]
    else:
        values = [lambda leaf=leaf, point=point: of_rows(leaf, point) for leaf in leaves for point in leaf.points]
    metrics = [[0.0] * len(parts) for _ in grid]
    for (part, point), value in zip(at, side_by_side(spark, values, parallelism)):
        metrics[point][part] = value
    best = SearchResult(grid, metrics, None, tree.fits).best
    return SearchResult(grid, metrics, _refit(stages, indexers, tree, grid[best], rows.drop(*names)), tree.fits)


def _refit(stages: list, indexers: dict[int, Model], tree: _Tree, point: Point, rows: DataFrame) -> Model:
    """The best point fitted on all rows, as a model of all stages of the pipeline."""
    fitted: dict[str, Transformer] = {}
    for at, stage in enumerate(tree.stages):
        model = fitted[stage.uid] = _fitted(stage, rows, _own(stage, point))
        if at < len(tree.stages) - 1:
            rows = applied([model], rows)
            if at in tree.written:
                rest = {c for s in tree.stages[at + 1:] for c in _inputs(s)}
                rows = durable(rows.select([c for c in rows.columns if c in rest]), "vectors", rebalance=True)
    # Stages in front that need no fitting are themselves.
    models = [indexers.get(i) or fitted.get(s.uid) or s for i, s in enumerate(stages)]
    return models[0] if len(models) == 1 else PipelineModel(models)
