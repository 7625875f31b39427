"""Chi-square statistic of one (term, category) cell, as column arithmetic.

With A = documents of the category holding the term, T = documents holding the
term, Cc = documents of the category, N = all documents and B = T - A:

=========  ==========  ==============
variant    C           D
=========  ==========  ==============
standard   Cc - A      N - Cc - B
legacy     Cc          N - Cc - B - A
mixed      Cc          N - Cc - B
=========  ==========  ==============
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANTS = ("standard", "legacy", "mixed")


@dataclass(frozen=True)
class Cell:
    """Counts of one contingency table as double columns."""

    a: Column
    b: Column
    c: Column
    d: Column
    n: Column

    @property
    def denominator(self) -> Column:
        return (self.a + self.b) * (self.a + self.c) * (self.b + self.d) * (self.c + self.d)

    @property
    def numerator(self) -> Column:
        gap = self.a * self.d - self.b * self.c
        return self.n * (gap * gap)


def contingency(observed: Column, term_total: Column, category_total: Column,
                documents: Column, variant: str = "standard") -> Cell:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
    a, t, cc, n = (c.cast("double") for c in (observed, term_total, category_total, documents))
    b = t - a
    if variant == "standard":
        return Cell(a, b, cc - a, n - cc - b, n)
    if variant == "legacy":
        return Cell(a, b, cc, n - cc - b - a, n)
    return Cell(a, b, cc, n - cc - b, n)


def chi_square(cell: Cell) -> Column:
    """Null where the denominator is 0."""
    return F.when(cell.denominator != 0, cell.numerator / cell.denominator)


def expected_count(observed: Column, term_total: Column, category_total: Column,
                   documents: Column, deviant: bool = False) -> Column:
    """``T * (Cc / N)``; the deviant form takes the category without the term, ``T * (Cc - A) / N``."""
    a, t, cc, n = (c.cast("double") for c in (observed, term_total, category_total, documents))
    value = t * (cc - a) / n if deviant else t * (cc / n)
    return F.when(n != 0, value).otherwise(F.lit(0.0))
