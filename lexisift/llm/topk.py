"""Exact top-k search by columnar branch and bound.

Vectors of a block lie dimension by dimension. Inner products grow one block of dimensions
at a time; what the rest can still add or take away is bounded by the norms of the rest of both
vectors (Cauchy-Schwarz). Candidates whose upper bound is below the k-th lower bound are
dropped and the survivors are compacted before the next block of dimensions. The first block of
candidates gives every query a k-th score, below which later blocks drop at once.

Arithmetic is exact: in doubles or 64-bit integers while no sum can leave them, otherwise in
Python integers, vector by vector.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.llm.tables import blocks_for
from lexisift.session import durable

SCALE = 1024
CANDIDATES = 16_384    # candidate vectors of one block
QUERIES = 2_048        # query vectors of one block
DIMENSIONS = 16        # dimensions that are added before candidates are dropped
_LONG = 2**63


def _rest_norms(vectors: np.ndarray) -> np.ndarray:
    """Norm of what follows each block of dimensions, rounded up; one row per block."""
    squares = np.add.reduceat(vectors.astype(np.float64) ** 2, np.arange(0, vectors.shape[1], DIMENSIONS), axis=1)
    after = squares[:, ::-1].cumsum(axis=1)[:, ::-1]
    rest = np.concatenate([after[:, 1:], np.zeros((len(vectors), 1))], axis=1)
    return np.ascontiguousarray(np.sqrt(rest * (1 + 1e-9)).T)


def block_top(query_ids, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, floors=None):
    """``(query_id, vec_id, score)`` of each query's ``k`` best vectors of the block.

    Sums of products have to stay within 64 bits. ``floors`` are scores that a query has ``k``
    candidates for already (NaN: none); lower ones may be left out.
    """
    if vectors.shape[1] == 0:
        queries, vectors = np.zeros((len(queries), 1), np.int64), np.zeros((len(vectors), 1), np.int64)
    largest = float(max(np.abs(queries).max(), 1)) * float(max(np.abs(vectors).max(), 1)) * vectors.shape[1]
    kind = np.float64 if largest < 2**52 else np.int64
    columns, wanted = np.ascontiguousarray(vectors.T.astype(kind)), queries.astype(kind)
    rest, query_rest = _rest_norms(vectors), _rest_norms(queries)
    for row, query_id in enumerate(query_ids):
        alive = np.flatnonzero(ids != query_id)
        score = np.zeros(len(alive), kind)
        known = -np.inf if floors is None or np.isnan(floors[row]) else floors[row]
        for block, low in enumerate(range(0, vectors.shape[1], DIMENSIONS)):
            part = columns[low:low + DIMENSIONS]
            score = score + wanted[row, low:low + DIMENSIONS] @ (part if len(alive) == len(ids) else part[:, alive])
            slack = query_rest[block, row] * rest[block, alive] + (largest > 2**50) * 1e-9 * largest
            floor = known
            if len(alive) > k:
                floor = max(known, np.partition(score - slack, len(alive) - k)[len(alive) - k])
            stay = score + slack >= floor
            alive, score = alive[stay], score[stay]
        best = np.lexsort((ids[alive], -score))[:k]
        for at in best:
            yield query_id, ids[alive[at]], int(score[at])


def _whole(vector) -> list[int]:
    """floor(1024 * x) of each component, exactly."""
    return [math.floor(x * SCALE) if abs(x) < 2.0**52 else int(x) * SCALE for x in map(float, vector)]


def _scaled(vectors: list) -> np.ndarray:
    """floor(1024 * x) as doubles, which is exact for small components."""
    with np.errstate(over="ignore"):
        return np.floor(np.stack(vectors).astype(np.float64) * SCALE)


def _ordered(score: int) -> tuple[int, str]:
    """What sorts scores beyond 64 bits, largest last: their sign, and digits behind their number."""
    if -_LONG <= score < _LONG:
        return 0, ""
    digits = str(abs(score))
    spelled = f"{len(digits):06d}{digits}"
    return (1, spelled) if score > 0 else (-1, spelled.translate(str.maketrans("0123456789", "9876543210")))


def _search(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(left) and len(right):
            asked, offered = left["v"].to_list(), right["v"].to_list()
            queries, vectors = _scaled(asked), _scaled(offered)
            query_ids, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            floors = left["floor"].to_numpy(np.float64)
            # Both sides below this cannot leave 64 bits, summed over all dimensions.
            bound = math.sqrt(2.0**62 / max(vectors.shape[1], 1))
            small_q, small_v = ((np.abs(m) <= bound).all(axis=1) for m in (queries, vectors))
            if small_q.any() and small_v.any():
                rows += block_top(query_ids[small_q].tolist(), queries[small_q].astype(np.int64), ids[small_v],
                                  vectors[small_v].astype(np.int64), k, floors[small_q])
            large = {j: _whole(offered[j]) for j in np.flatnonzero(~small_v)}
            for i, query_id in enumerate(query_ids.tolist()):
                if small_q[i] and not large:
                    continue
                query = _whole(asked[i])
                others = large.items() if small_q[i] else ((j, large.get(j) or _whole(v)) for j, v in enumerate(offered))
                scores = [(-sum(a * b for a, b in zip(query, v)), int(ids[j])) for j, v in others if ids[j] != query_id]
                rows += [(query_id, vec_id, -score) for score, vec_id in sorted(scores)[:k]]
        beyond = [_ordered(r[2]) for r in rows]
        return pd.DataFrame({
            "query_id": pd.Series([r[0] for r in rows], dtype="int64"), "vec_id": pd.Series([r[1] for r in rows], dtype="int64"),
            "score": pd.Series([None if s else r[2] for r, (s, _) in zip(rows, beyond)], dtype="Int64"),
            "side": pd.Series([s for s, _ in beyond], dtype="int32"), "digits": pd.Series([d for _, d in beyond], dtype="object")})
    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer inner products.

    Both tables have ``vec_id`` and ``embedding``. Components x become floor(1024 * x),
    whatever their size. Ties go to the smaller ``vec_id``; rows with the query's own
    ``vec_id`` are no candidates. Scores that do not fit a long take part in the ranking by their
    exact value and are returned as null. Rows without ``vec_id``, null vectors and vectors
    with null or non-finite components take no part; vectors meet only those of their own
    length; fewer than ``k`` candidates are all returned. Repeated rows are candidates each;
    of queries that share a ``vec_id`` the smallest vector asks.
    Other columns are ignored.
    """
    def ready(df: DataFrame) -> DataFrame:
        whole = F.transform("embedding", lambda x: x.cast("double"))
        fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).where(
            F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine).withColumn("dim", F.size("v"))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("side"), F.desc("score"), F.desc("digits"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def search(asked: DataFrame, offered: DataFrame, low: int, high: int) -> DataFrame:
        """Blocks of candidates from ``low`` to ``high - 1`` against all queries."""
        left = asked.withColumn("c", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        right = offered.where(f"c >= {low} and c < {high}").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        return left.groupBy("dim", "q", "c").cogroup(right.groupBy("dim", "q", "c")).applyInPandas(
            _search(k), "query_id long, vec_id long, score long, side int, digits string")

    candidates = ready(vectors)
    asked = ready(queries).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    c_blocks, q_blocks = blocks_for(candidates.count(), CANDIDATES), blocks_for(asked.count(), QUERIES)
    asked, candidates = asked.withColumn("q", block(q_blocks)), candidates.withColumn("c", block(c_blocks))
    found = search(asked.withColumn("floor", F.lit(None).cast("double")), candidates, 0, 1)
    if c_blocks > 1:
        found = durable(found, "first_block")
        # The k-th score of the first block, less what rounding to a double may add.
        floors = ranked(found).where(f"rank = {k}").select(
            F.col("query_id").alias("vec_id"),
            F.when(F.col("side") == 0, F.col("score") - F.abs("score") * 1e-9 - 1).alias("floor"))
        found = found.unionByName(search(asked.join(floors, "vec_id", "left"), candidates, 1, c_blocks))
    return ranked(found).select("query_id", "rank", "vec_id", "score")
