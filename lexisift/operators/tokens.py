"""From documents to term rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.functions.terms import keep_terms, term_counts
from lexisift.functions.tokenizers import TOKENIZERS
from lexisift.sources.corpus import present_columns

StopWords = Iterable[str] | DataFrame | None


def with_tokens(df: DataFrame, text: str = "text", tokens: str = "tokens",
                tokenizer: str = "translate") -> DataFrame:
    return df.withColumn(tokens, TOKENIZERS[tokenizer](F.col(text)))


def with_column_tokens(df: DataFrame, text_columns: Sequence[str],
                       tokenizer: str = "regex") -> tuple[DataFrame, list[str]]:
    """Append ``<column>_tokens`` for the columns that exist; also returns the missing ones."""
    present, missing = present_columns(df, text_columns)
    added = {f"{c}_tokens": TOKENIZERS[tokenizer](F.col(c)) for c in present}
    return (df.withColumns(added) if added else df), missing


def split_stop_words(stop_words: StopWords) -> tuple[list[str], DataFrame | None]:
    """(words of a given list, frame to anti-join). Nulls are no words; nothing is collected."""
    if stop_words is None:
        return [], None
    if isinstance(stop_words, DataFrame):
        return [], stop_words.select("term").filter(F.col("term").isNotNull())
    return sorted({word for word in stop_words if word is not None}), None


def without_words(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Rows whose term is not in the list; the join kind follows the measured list size.

    Written as an outer join with a null test: an anti-join would be pushed below a
    preceding count, onto the far more numerous token rows.
    """
    listed = words.select("term").distinct().withColumn("listed", F.lit(True))
    return rows.join(listed, "term", "left").filter(F.col("listed").isNull()).drop("listed")


def in_words(column: str, words: Iterable[str]) -> Column:
    """Membership in an inlined list, parsed at once instead of built word by word."""
    escaped = (word.replace("\\", "\\\\").replace("'", "\\'") for word in sorted(set(words)))
    return F.expr(f"`{column}` IN ({', '.join(chr(39) + word + chr(39) for word in escaped)})")


def term_filter(rows: DataFrame, words: Iterable[str], min_length: int) -> DataFrame:
    condition = F.col("term").isNotNull() & (F.length("term") >= min_length)
    return rows.filter(condition & ~in_words("term", words) if words else condition)


def document_terms(df: DataFrame, keep: Sequence[str], tokens: str = "tokens",
                   words: Iterable[str] = (), min_length: int = K.MIN_TERM_LENGTH) -> DataFrame:
    """One row per document and distinct term.

    Terms are made distinct inside the document's own row. Length and stop words are
    tested on the exploded rows, where the test is compiled together with the scan.
    """
    rows = df.select(*keep, F.explode(F.array_distinct(tokens)).alias("term"))
    return term_filter(rows, words, min_length)


def term_frequencies(df: DataFrame, keep: Sequence[str], tokens: str = "tokens",
                     stop_words: StopWords = None,
                     min_length: int = K.MIN_TERM_LENGTH) -> DataFrame:
    """``(keep..., term, n)`` with n counted inside each document, without a shuffle."""
    words, frame = split_stop_words(stop_words)
    rows = (df.select(*keep, F.explode(term_counts(F.col(tokens))).alias("entry"))
            .select(*keep, "entry.term", "entry.n"))
    rows = term_filter(rows, words, min_length)
    return rows if frame is None else without_words(rows, frame).select(*keep, "term", "n")


def token_lists(df: DataFrame, keep: Sequence[str], tokens: str = "tokens",
                stop_words: Iterable[str] = (),
                min_length: int = K.MIN_TERM_LENGTH) -> DataFrame:
    """``(keep..., tokens)`` with filtered, ordered, repeated tokens."""
    return df.select(*keep, keep_terms(F.col(tokens), stop_words, min_length).alias("tokens"))
