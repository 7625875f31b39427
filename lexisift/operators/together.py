"""One-vs-rest linear SVMs of many settings, fitted side by side in common passes over the rows.

``LinearSVC`` runs a chain of Spark jobs per fit, and a grid has hundreds of fits: settings,
classes and parts. Here the rows are packed into blocks once, and every pass gives the loss and
gradient that each unfinished fit asks for next, so a grid costs as many jobs as its longest
fit. What is minimized and how are those of ``LinearSVC``: the same scaled and centred
features, the same penalty, the same steps and the same tests for the end.
"""

from __future__ import annotations

import pickle
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, OneVsRest, OneVsRestModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.wrapper import JavaParams
from pyspark.rdd import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.session import spread

# Cells of a block, columns of weights in a pass that predicts, bytes of partial sums that the
# driver adds up itself, and what ``LinearSVC`` passes to its optimizer. A short block has fewer columns,
# and stays in the processor's cache.
CELLS = 1 << 18
COLUMNS = 256
DRIVER_BYTES = 1 << 25
MEMORY = 10
VALUES_KEPT = 20
SEARCH_STEPS = 20
GROWTH = 2.1
# Points of a line search that are proposed at once, and of all fits that a pass evaluates.
AHEAD = 15
WIDTH = 32

Evaluations = Generator[list[np.ndarray], list[tuple[float, np.ndarray]], dict[int, np.ndarray]]


class _StepFailed(Exception):
    """No step or no direction can be found."""


def _direction(history: list[tuple[np.ndarray, np.ndarray]], gradient: np.ndarray) -> np.ndarray:
    """The L-BFGS direction, without components along which the gradient does not fall."""
    direction, scale, parts = gradient.copy(), 1.0, []
    if history:
        step, change = history[0]
        along = step @ change
        if along < 0 or np.isnan(along):
            raise _StepFailed
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = along / (change @ change)
    with np.errstate(divide="ignore", invalid="ignore"):
        for step, change in history:
            rho = step @ change
            part = (step @ direction) / rho
            if np.isnan(part):
                raise _StepFailed
            parts.append((part, rho))
            direction -= part * change
        direction *= scale
        for (step, change), (part, rho) in zip(reversed(history), reversed(parts)):
            direction += (part - (change @ direction) / rho) * step
    direction = -direction
    return np.where(direction * gradient < 0, direction, 0.0)


def _moved(x: np.ndarray, gradient: np.ndarray, direction: np.ndarray, size: float) -> np.ndarray:
    """A step that ends where a component would change its sign."""
    to = x + direction * size
    return np.where(np.sign(to) == np.where(x != 0, np.sign(x), np.sign(-gradient)), to, 0.0)


def _searched(x, value, gradient, direction, first: float, shrink: float):
    """Backtracking along the direction: ``(point, value, gradient)`` of the last step size.

    Yields the point it needs and after it those that may be next, nearest decisions first.
    """
    slope = gradient @ direction
    size, here, known = first, value, {}

    def tried(size: float):
        if size not in known:
            sizes = [size]
            for s in sizes:
                if len(sizes) >= AHEAD:
                    break
                sizes += [n for n in (s * shrink, s * GROWTH) if n not in sizes]
            points = [_moved(x, gradient, direction, s) for s in sizes]
            known.update({s: (p, *a) for s, p, a in zip(sizes, points, (yield points))})
        return known[size]

    for _ in range(SEARCH_STEPS):
        # The first size counts with the value at the start, so it is seldom evaluated.
        if here > value + size * slope * 1e-4:
            factor = shrink
        else:
            steepness = (yield from tried(size))[2] @ direction
            factor = GROWTH if steepness < 0.9 * slope else shrink if steepness > -0.9 * slope else 1.0
            if factor == 1.0:
                break
        if size * factor < 1e-10 or size * factor > 1e10:
            raise _StepFailed
        last, size = size, size * factor
        here = (yield from tried(size))[1]
    else:
        size = last
    return (yield from tried(size))


def minimized(start: np.ndarray, iterations: Sequence[int], tolerance: float) -> Evaluations:
    """Minimize a function: yields points, is sent values and gradients of the first or of more of them.

    Returns the point after each of the numbers of iterations, as of a run that ends there.
    """
    wanted, done = sorted(set(iterations)), {}
    x = start
    value, gradient = (yield [x])[0]
    initial, values, history, at, failed = value, [np.inf], [], 0, False
    while True:
        done |= {n: x for n in wanted if n <= at and n not in done}
        ended = (len(done) == len(wanted)
                 or len(values) >= 2 and abs(value - max(values)) <= tolerance * abs(initial)
                 or np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8))
        if ended:
            break
        try:
            direction = _direction(history, gradient)
            first, shrink = (1.0, 0.5) if at else (0.5 / np.linalg.norm(gradient), 0.1)
            point, new_value, new_gradient = yield from _searched(x, value, gradient, direction, first, shrink)
        except _StepFailed:
            if failed:
                break
            history, failed = [], True
            continue
        history = [(point - x, new_gradient - gradient), *history][:MEMORY]
        x, value, gradient, at, failed = point, new_value, new_gradient, at + 1, False
        values = [*values, value][-VALUES_KEPT:]
    return {n: done.get(n, x) for n in wanted}


def _packed(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: labels, the columns that occur, and the places and values of entries in those.

    Rows go by label, as those of one label share more columns, whose entries are all that is multiplied.
    """
    for batch in batches:
        batch = batch.take(pc.sort_indices(batch.column(0)))
        label, indices, values = (batch.column(i) for i in range(3))
        if values.null_count or not np.isfinite(values.flatten().to_numpy(zero_copy_only=False)).all():
            raise ValueError("vectors must not be null, or hold values that are not finite")
        labels = np.array(label.to_numpy(zero_copy_only=False), float)
        at, column, value = (a.to_numpy(zero_copy_only=False) for a in (values.offsets, indices.flatten(), values.flatten()))
        at, begin = at - at[0], 0
        while begin < len(labels):
            rows = np.arange(1, len(labels) - begin + 1)
            cells = rows * np.minimum(features, at[begin + 1:] - at[begin])
            end = begin + max(1, int(np.searchsorted(cells, CELLS, side="right")))
            part = slice(at[begin], at[end])
            present, place = np.unique(column[part], return_inverse=True)
            row = np.repeat(np.arange(end - begin), np.diff(at[begin:end + 1]))
            block = (labels[begin:end], present, (row * len(present) + place).astype(np.int32), value[part].copy())
            yield pa.record_batch({"block": pa.array([pickle.dumps(block, 5)], pa.binary())})
            begin = end


def _entries(rows: DataFrame, features_column: str, label: str) -> DataFrame:
    v = F.unwrap_udt(features_column)
    entries = rows.select(F.col(label).cast("double").alias("label"), v.alias("v")).select(
        "label", F.coalesce("v.indices", F.transform("v.values", lambda _, i: i)).alias("indices"), F.col("v.values").alias("values"))
    return spread(entries, tasks_per_core=1)


def _dense(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, the columns that occur, and the rows in those columns."""
    labels, present, place, value = pickle.loads(block)
    dense = np.zeros(len(labels) * len(present))
    dense[place] = value
    return labels, present, dense.reshape(len(labels), len(present))


def packed(rows: DataFrame, features_column: str, label: str, features: int) -> RDD:
    """The rows as blocks, kept by the executors."""
    blocks = _entries(rows, features_column, label).mapInArrow(lambda batches: _packed(batches, features), "block binary")
    return blocks.rdd.map(lambda row: bytes(row.block)).persist(StorageLevel.MEMORY_AND_DISK)


def hinge_sums(blocks: RDD, weights: np.ndarray, intercepts: np.ndarray, classes: np.ndarray) -> tuple:
    """Per fit, summed over the rows: losses, their slopes by margin, and those by weight.

    A column of ``weights`` is a fit, which tells its class from all others.
    """
    shared = blocks.context.broadcast((weights, intercepts, classes))

    def summed(found: Iterator[bytes]) -> Iterator[list]:
        weights, intercepts, classes = shared.value
        losses, slopes, by_weight = np.zeros(len(classes)), np.zeros(len(classes)), np.zeros(weights.shape)
        for block in found:
            labels, present, dense = _dense(block)
            side = np.where(labels[:, None] == classes, 1.0, -1.0)
            slack = 1.0 - side * (dense @ weights[present] + intercepts)
            slope = np.where(slack > 0, -side, 0.0)
            losses += np.maximum(slack, 0.0).sum(axis=0)
            slopes += slope.sum(axis=0)
            by_weight[present] += dense.T @ slope
        yield [losses, slopes, by_weight]

    def added(a: list, b: list) -> list:
        return [x + y for x, y in zip(a, b)]

    try:
        sums = blocks.mapPartitions(summed)
        # A second stage costs more than the driver's sum of a few parts.
        few = weights.nbytes * blocks.getNumPartitions() <= DRIVER_BYTES
        return tuple(reduce(added, sums.collect()) if few else sums.treeReduce(added))
    finally:
        shared.destroy()


def shares_passes(stage) -> bool:
    """Whether ``fit_together`` can fit this stage."""
    return (isinstance(stage, OneVsRest) and isinstance(stage.getClassifier(), LinearSVC)
            and not any(s.isDefined("weightCol") for s in (stage, stage.getClassifier())))


def _binary_model(stage: OneVsRest, svm: LinearSVC, k: int, weights: np.ndarray, intercept: float) -> LinearSVCModel:
    model = LinearSVCModel(JavaParams._new_java_obj(
        "org.apache.spark.ml.classification.LinearSVCModel", svm.uid, Vectors.dense(weights), float(intercept)))
    own = {svm.labelCol: f"mc2b${k}", svm.featuresCol: stage.getFeaturesCol(), svm.predictionCol: stage.getPredictionCol()}
    return svm.copy(own)._copyValues(model)


@dataclass(frozen=True)
class Weights:
    """A fitted stage: a column of weights and an intercept per class."""

    columns: np.ndarray
    intercepts: np.ndarray


def fit_together(stages: Sequence[OneVsRest], rows: DataFrame) -> list[OneVsRestModel]:
    """Each stage fitted on the same rows; all read the same columns, see ``shares_passes``."""
    return [stage._copyValues(OneVsRestModel(models=[
        _binary_model(stage, stage.getClassifier(), k, found.columns[:, k], found.intercepts[k]) for k in range(len(found.intercepts))]))
        for stage, found in zip(stages, weights_together(stages, rows))]


def weights_together(stages: Sequence[OneVsRest], rows: DataFrame) -> list[Weights]:
    """The weights that ``fit_together`` gives its models.

    Fits that differ in the number of iterations only are one fit, looked at on its way. The
    driver sees weights and gradients, ten pairs of each fit at most.
    """
    label, column = stages[0].getLabelCol(), stages[0].getFeaturesCol()
    found = rows.agg(F.max(label).alias("most"), F.count(F.lit(1)).alias("n"),
                     Summarizer.metrics("mean", "std").summary(F.col(column)).alias("s")).first()
    count, classes = found.n, int(found.most) + 1
    mean, deviation = found.s.mean.toArray(), found.s.std.toArray()
    features = len(mean)
    inverse = np.divide(1.0, deviation, out=np.zeros(features), where=deviation != 0)

    svms = [stage.getClassifier() for stage in stages]
    settings = [(s.getRegParam(), s.getStandardization(), s.getFitIntercept(), s.getTol()) for s in svms]
    fits = [(setting, k) for setting in dict.fromkeys(settings) for k in range(classes)]
    runs, asked, ended = {}, {}, {}
    for setting, k in fits:
        limits = [s.getMaxIter() for s, of in zip(svms, settings) if of == setting]
        runs[setting, k] = minimized(np.zeros(features + setting[2]), limits, setting[3])
        asked[setting, k] = next(runs[setting, k])

    def raw(x: np.ndarray, setting: tuple) -> tuple[np.ndarray, float]:
        """Weights and intercept for the vectors as they are."""
        weights = x[:features] * inverse
        return weights, x[features] - weights @ mean if setting[2] else 0.0

    def penalized(x, setting, loss, slope, by_weight) -> tuple[float, np.ndarray]:
        penalty, standardized, centred, _ = setting
        gradient = inverse * by_weight / count
        if centred:
            gradient = np.append(gradient - inverse * mean * slope / count, slope / count)
        w = x[:features] if standardized else x[:features] * inverse * inverse
        gradient[:features] += penalty * w
        return loss / count + 0.5 * penalty * (x[:features] @ w), gradient

    blocks = packed(rows, column, label, features)
    try:
        while asked:
            # Where few fits are left, a pass has room for points that they may ask for next.
            share = max(1, WIDTH // len(asked))
            now = [(fit, x) for fit, points in asked.items() for x in points[:share]]
            weights, intercepts = zip(*[raw(x, fit[0]) for fit, x in now])
            losses, slopes, by_weight = hinge_sums(
                blocks, np.stack(weights, axis=1), np.array(intercepts), np.array([float(fit[1]) for fit, _ in now]))
            answers = {fit: [] for fit in asked}
            for i, (fit, x) in enumerate(now):
                answers[fit].append(penalized(x, fit[0], losses[i], slopes[i], by_weight[:, i]))
            for fit, answer in answers.items():
                del asked[fit]
                try:
                    asked[fit] = runs[fit].send(answer)
                except StopIteration as end:
                    ended[fit] = end.value
    finally:
        blocks.unpersist()
    found = []
    for svm, setting in zip(svms, settings):
        columns, intercepts = zip(*[raw(ended[setting, k][svm.getMaxIter()], setting) for k in range(classes)])
        found.append(Weights(np.stack(columns, axis=1), np.array(intercepts, float)))
    return found


def confusion_counts(rows: DataFrame, features_column: str, label: str, fitted: Sequence[Weights]) -> list[list[tuple]]:
    """Per fitted stage the numbers of rows, ``(label, prediction, n)``, in common passes over the rows.

    The prediction is the class with the largest margin, of equals the first.
    """
    classes = max(len(found.intercepts) for found in fitted)
    step, counts = max(1, COLUMNS // classes), [[] for _ in fitted]
    for begin in range(0, len(fitted), step):
        part = fitted[begin:begin + step]
        shared = rows.sparkSession.sparkContext.broadcast(
            (np.concatenate([found.columns for found in part], axis=1), np.concatenate([found.intercepts for found in part])))

        def counted(batches: Iterator[pa.RecordBatch], shared=shared, points=len(part)) -> Iterator[pa.RecordBatch]:
            weights, intercepts = shared.value
            for block in _packed(batches, len(weights)):
                labels, present, dense = _dense(block.column(0)[0].as_py())
                if np.isnan(labels).any():
                    raise ValueError("labels must not be null")
                best = (dense @ weights[present] + intercepts).reshape(len(labels), points, -1).argmax(axis=2)
                for point in range(points):
                    pairs, n = np.unique(np.stack([labels, best[:, point]]), axis=1, return_counts=True)
                    yield pa.record_batch({"point": pa.array(np.full(len(n), point), pa.int32()), "label": pa.array(pairs[0]),
                                           "prediction": pa.array(pairs[1]), "n": pa.array(n, pa.int64())})

        try:
            sums = (_entries(rows, features_column, label).mapInArrow(counted, "point int, label double, prediction double, n bigint")
                    .groupBy("point", "label", "prediction").agg(F.sum("n").alias("n")).collect())
        finally:
            shared.destroy()
        for row in sums:
            counts[begin + row.point].append((row.label, row.prediction, float(row.n)))
    return counts
