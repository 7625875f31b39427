"""Chi-square queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.operators.chi_square import STATISTICS, text_statistics
from lexisift.plans import corpora, sql
from lexisift.plans.registry import query

PAIR = "SELECT category, term, chi2 FROM scored"
RECORD = f"SELECT {', '.join(STATISTICS)} FROM scored"


def _pairs(scored):
    return scored.select("category", "term", "chi2")


def _register(name, variant="standard", zero="skip", tokenizer="translate"):
    @query(name, f"{sql.chi(tokenizer=tokenizer, variant=variant, zero=zero)}\n{PAIR}")
    def run(spark, folder):
        return _pairs(text_statistics(
            corpora.documents(spark, folder), tokenizer, corpora.STOP_WORDS(),
            variant=variant, zero=zero))


_register("chi2_standard")
_register("chi2_legacy", variant="legacy")
_register("chi2_mixed", variant="mixed")
_register("chi2_skip_zero", variant="legacy", zero="skip", tokenizer="translate_no_dollar")
_register("chi2_zero_as_zero", zero="zero", tokenizer="replace_split")
_register("chi2_legacy_zero_as_zero", variant="legacy", zero="zero", tokenizer="replace_split")


@query("chi2_full_stats", f"{sql.chi(tokenizer='regex', variant='mixed')}\n{RECORD}")
def full_statistics(spark, folder):
    return text_statistics(corpora.documents(spark, folder), "regex", corpora.STOP_WORDS(),
                           variant="mixed").select(*STATISTICS)


@query("chi2_expected_deviant",
       f"{sql.chi(tokenizer='regex', zero='zero', deviant=True)}\n{RECORD}")
def deviant_expected(spark, folder):
    return text_statistics(corpora.documents(spark, folder), "regex", corpora.STOP_WORDS(),
                           zero="zero", deviant_expected=True).select(*STATISTICS)


@query("chi2_by_source", f"{sql.chi(source=sql.DOCUMENTS_BY_SOURCE)}\n{PAIR}")
def by_source(spark, folder):
    return _pairs(text_statistics(corpora.documents(spark, folder, "source"),
                                  stop_words=corpora.STOP_WORDS()))


@query("chi2_composed_text", f"{sql.chi(source=sql.TITLED, variant='legacy')}\n{PAIR}")
def composed_text(spark, folder):
    return _pairs(text_statistics(corpora.titled_documents(spark, folder),
                                  stop_words=corpora.STOP_WORDS(), variant="legacy"))


@query("chi2_turns_by_role", f"{sql.chi(source=sql.TURNS)}\n{PAIR}")
def turns_by_role(spark, folder):
    return _pairs(text_statistics(corpora.turns(spark, folder), stop_words=corpora.STOP_WORDS()))


@query("chi2_by_quality", f"{sql.chi(source=sql.RATED)}\n{PAIR}")
def by_quality(spark, folder):
    return _pairs(text_statistics(corpora.rated_documents(spark, folder),
                                  stop_words=corpora.STOP_WORDS()))


# A list of the most widespread terms, used as stop words too numerous to inline.
_FREQUENT = """frequent AS (
  SELECT term FROM obs GROUP BY term
  HAVING sum(observed) * 5 >= (SELECT count(*) FROM src))"""


@query("chi2_data_stop_words",
       "WITH " + ",\n".join([
           sql.tokens(stop=False), sql.COUNTS.replace("obs AS", "obs_all AS", 1).split(",\ntt AS")[0],
           _FREQUENT.replace("FROM obs", "FROM obs_all"),
           "obs AS (SELECT * FROM obs_all WHERE term NOT IN (SELECT term FROM frequent))",
           "tt AS" + sql.COUNTS.split(",\ntt AS")[1], sql.scores()]) + f"\n{PAIR}")
def data_stop_words(spark, folder):
    """Stop words taken from the data: every term found in a fifth of the documents."""
    from lexisift.operators.chi_square import contingency_counts, score_terms
    from lexisift.operators.counts import (documents_per_category, documents_per_category_term,
                                           documents_per_term)
    from lexisift.operators.tokens import with_tokens, without_words
    documents = corpora.documents(spark, folder)
    observed = documents_per_category_term(with_tokens(documents))
    per_category = documents_per_category(documents)
    n = per_category.agg(F.sum("documents")).scalar()
    frequent = documents_per_term(observed).filter(F.col("total_term") * 5 >= n)
    kept = without_words(observed, frequent).select("category", "term", "observed")
    return _pairs(score_terms(contingency_counts(kept, per_category)))
