"""Splits and samples of the documents."""

from __future__ import annotations

from lexisift.operators import splits as S
from lexisift.plans.registry import query
from lexisift.sources.corpus import read_table


def _bucket(seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || doc_id::VARCHAR), 1, 8))::BIGINT % 100)"


def _cases(parts: list[tuple[str, int]], seed: int = 42) -> str:
    upper, cases = 0, []
    for name, weight in parts:
        upper += weight
        cases.append(f"WHEN {_bucket(seed)} < {upper} THEN '{name}'")
    return f"CASE {' '.join(cases)} END"


def _ids(spark, folder):
    return read_table(spark, folder, "documents", ["doc_id"])


def _register(name: str, parts: list[tuple[str, int]]) -> None:
    @query(name, f"SELECT doc_id, {_cases(parts)} AS split FROM documents")
    def run(spark, folder):
        return S.assign_splits(_ids(spark, folder), "doc_id", [w for _, w in parts],
                               [n for n, _ in parts])


# Split weights.
THREE_WAY = [("train", 60), ("validation", 20), ("test", 20)]
THREE_WAY_LARGE_TRAIN = [("train", 70), ("validation", 15), ("test", 15)]
TWO_WAY = [("train", 80), ("test", 20)]

_register("split_60_20_20", THREE_WAY)
_register("split_70_15_15", THREE_WAY_LARGE_TRAIN)
_register("split_80_20", TWO_WAY)


@query("split_nested", f"""SELECT doc_id, CASE WHEN {_bucket(42)} >= 80 THEN 'test'
  WHEN {_bucket(43)} < 75 THEN 'train' ELSE 'validation' END AS split FROM documents""")
def nested(spark, folder):
    return S.assign_nested_splits(_ids(spark, folder), "doc_id")


@query("split_counts", f"""SELECT split, count(*) AS rows
FROM (SELECT {_cases(THREE_WAY)} AS split FROM documents) GROUP BY split""")
def sizes(spark, folder):
    return S.split_sizes(S.assign_splits(_ids(spark, folder), "doc_id",
                                         [w for _, w in THREE_WAY], [n for n, _ in THREE_WAY]))


@query("sample_1pct", f"SELECT doc_id, lang FROM documents WHERE {_bucket(4242)} < 1")
def sample(spark, folder):
    """The sampling operator, reproducible by id."""
    return S.sample_percent(read_table(spark, folder, "documents", ["doc_id", "lang"]),
                            "doc_id", 1, seed=4242)
