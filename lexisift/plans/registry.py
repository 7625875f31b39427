"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a plan under ``name``; without SQL only its rows can be checked."""
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run
    return register


def load_all() -> dict[str, Query]:
    from lexisift.plans import (counting, evaluation, features, models, ranking,  # noqa: F401
                                scans, scoring, splitting, text, vocabularies)
    return QUERIES
