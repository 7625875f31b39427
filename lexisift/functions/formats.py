"""Score -> text. The first two round the exact binary value, half to even."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_three(score: Column) -> Column:
    """Always three decimals: ``0.060``."""
    return F.call_function("format_number", score, F.lit("0.000"))


def rounded_three(score: Column) -> Column:
    """Up to three decimals, at least one: ``0.06``, ``12.0``."""
    return F.call_function("format_number", score, F.lit("0.0##"))


def unrounded(score: Column) -> Column:
    return score.cast("string")


FORMATS: dict[str, Callable[[Column], Column]] = {
    "fixed": fixed_three, "rounded": rounded_three, "unrounded": unrounded}
