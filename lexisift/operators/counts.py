"""Document frequencies.

Documents are counted before tokens are exploded, so a document without surviving
terms still counts in its category and in the total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators.tokens import StopWords, document_terms, split_stop_words, without_words


def documents_per_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("documents"))


def total_documents(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("documents"))


def rows_per_label(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def documents_per_category_term(df: DataFrame, tokens: str = "tokens",
                                stop_words: StopWords = None,
                                min_length: int = K.MIN_TERM_LENGTH) -> DataFrame:
    """``(category, term, observed)``.

    Counts are combined before the shuffle, so a term or category found everywhere
    costs one row per task. A stop list too long to inline is anti-joined after the
    count: that gives the same rows and keeps frequent words from piling up.
    """
    words, frame = split_stop_words(stop_words)
    observed = (document_terms(df, ["category"], tokens, words, min_length)
                .groupBy("category", "term").agg(F.count(F.lit(1)).alias("observed")))
    if frame is None:
        return observed
    return without_words(observed, frame).select("category", "term", "observed")


def documents_per_term(observed: DataFrame) -> DataFrame:
    """``(term, total_term)`` from the per-category counts; the text is not read again."""
    return observed.groupBy("term").agg(F.sum("observed").alias("total_term"))


def count_levels(observed: DataFrame) -> DataFrame:
    """Per-category and overall document frequency of each term in one result.

    The grouping sets run over the counted rows, not over the tokens.
    """
    return (observed.groupingSets([["category", "term"], ["term"]], "category", "term")
            .agg(F.sum("observed").alias("documents"),
                 F.grouping("category").cast("int").alias("all_categories")))


def terms_of_documents(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct terms of each document as a sorted list in its own row."""
    return df.withColumn("terms", F.sort_array(F.array_distinct(tokens)))


def sum_counts(rows: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Sum ready-made counts per key."""
    return rows.groupBy(*keys).agg(F.sum(count).alias(count))
