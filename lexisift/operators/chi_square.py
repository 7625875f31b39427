"""Chi-square of every (term, category) pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.functions.scores import chi_square, contingency, expected_count
from lexisift.operators.counts import documents_per_category, documents_per_category_term
from lexisift.operators.tokens import StopWords, with_tokens

STATISTICS = ("term", "category", "observed", "expected", "chi2", "total_term", "total_category")


def contingency_counts(observed: DataFrame, per_category: DataFrame) -> DataFrame:
    """``observed`` with the totals of its term, its category and all documents.

    Term totals are a window over the counted rows, of which a term has one per category
    at most. The join with the category totals, usually tiny, is left to the optimizer:
    adaptive execution measures them before it picks broadcast or sort-merge (with skew
    splitting).
    """
    documents = per_category.agg(F.sum("documents").alias("n")).scalar()
    categories = per_category.select(
        "category", F.col("documents").alias("total_category"), documents.alias("total_documents"))
    totals = F.sum("observed").over(Window.partitionBy("term"))
    return observed.withColumn("total_term", totals).join(categories, "category")


def score_terms(counts: DataFrame, variant: str = "standard", zero: str = "skip",
                deviant_expected: bool = False) -> DataFrame:
    """The full statistics record per (term, category).

    ``zero`` is the policy for a zero denominator: ``skip`` the row or score it ``zero``.
    """
    if zero not in ("skip", "zero"):
        raise ValueError(f"zero must be 'skip' or 'zero', got {zero!r}")
    columns = [F.col(c) for c in ("observed", "total_term", "total_category", "total_documents")]
    value = chi_square(contingency(*columns, variant=variant))
    scored = counts.select(
        "term", "category", "observed",
        expected_count(*columns, deviant=deviant_expected).alias("expected"),
        (value if zero == "skip" else F.coalesce(value, F.lit(0.0))).alias("chi2"),
        "total_term", "total_category")
    return scored.filter(F.col("chi2").isNotNull()) if zero == "skip" else scored


def term_statistics(documents: DataFrame, tokens: str = "tokens", stop_words: StopWords = None,
                    min_length: int = K.MIN_TERM_LENGTH, variant: str = "standard",
                    zero: str = "skip", deviant_expected: bool = False) -> DataFrame:
    """From ``(category, tokens)`` documents to scored terms.

    Rows without a category are left out here, ahead of all branches: otherwise only
    the joined branches would get that filter and nothing could be shared.
    """
    documents = (documents.filter(F.col("category").isNotNull())
                 .withColumn("category", F.coalesce("category", F.lit(""))))
    observed = documents_per_category_term(documents, tokens, stop_words, min_length)
    counts = contingency_counts(observed, documents_per_category(documents))
    return score_terms(counts, variant, zero, deviant_expected)


def text_statistics(documents: DataFrame, tokenizer: str = "translate",
                    stop_words: StopWords = None, **options) -> DataFrame:
    """From ``(category, text)`` documents to scored terms."""
    return term_statistics(with_tokens(documents, tokenizer=tokenizer),
                           stop_words=stop_words, **options)
