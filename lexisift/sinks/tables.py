"""Distributed writers. Each writes a folder; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(lines: DataFrame, path: str, compression: str = "none",
                mode: str = "errorifexists") -> None:
    """A one-column frame as text."""
    lines.write.mode(mode).option("compression", compression).text(path)


def write_statistics(stats: DataFrame, path: str, compression: str = "none",
                     mode: str = "errorifexists") -> None:
    """Tab-separated statistics with a header per part."""
    (stats.write.mode(mode).option("sep", "\t").option("header", True)
     .option("compression", compression).csv(path))


def list_literal(tokens: Column, single_quotes: bool = False) -> Column:
    """Token array -> list literal; single quotes as in a Python list, if wanted.

    As there, a token with an apostrophe stands in double quotes, so it reads back.
    """
    if not single_quotes:
        return F.coalesce(F.to_json(tokens), F.lit("[]"))

    def quoted(token: Column) -> Column:
        double = F.regexp_extract(F.to_json(F.array(token)), r"(?s)^\[(.*)\]$", 1)
        single = F.regexp_replace(double, r'^"|"$', "'")
        return F.when(F.contains(token, F.lit("'")), double).otherwise(single)
    inside = F.array_join(F.transform(tokens, quoted), ",")
    return F.coalesce(F.concat(F.lit("["), inside, F.lit("]")), F.lit("[]"))


def write_token_csv(df: DataFrame, path: str, tokens: str = "tokens", category: str = "category",
                    keep: Sequence[str] = (), tokens_name: str = "reviewText_tokens",
                    single_quotes: bool = False, compression: str = "none",
                    mode: str = "errorifexists") -> None:
    """Tokens as a list literal next to the category, readable by ``read_token_csv``."""
    (df.select(*keep, list_literal(F.col(tokens), single_quotes).alias(tokens_name),
               F.col(category).alias("category"))
     .write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("compression", compression).csv(path))


def write_terms(terms: DataFrame, path: str, one_per_line: bool = True,
                order: Sequence[str] = ("term",), mode: str = "errorifexists") -> None:
    """Sorted terms, one per line or blank-separated.

    The sort is by range over all tasks; parts read in order give the whole list,
    of any length, so no task ever holds all of it.
    """
    (terms.orderBy(*order).select("term").write.mode(mode)
     .option("lineSep", "\n" if one_per_line else " ").text(path))
