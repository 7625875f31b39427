import pytest
from pyspark.sql import functions as F

from lexisift.operators.chi_square import term_statistics, text_statistics
from lexisift.operators.counts import (count_levels, documents_per_category,
                                       documents_per_category_term, documents_per_term)
from lexisift.operators.tokens import with_tokens


def scores(df):
    return {(r.term, r.category): r.chi2 for r in df.collect()}


@pytest.mark.parametrize("variant, red, pear", [
    ("standard", 3.0, 0.0), ("legacy", 0.6, 0.375), ("mixed", 1.2, 0.05)])
def test_variants_by_hand(corpus, variant, red, pear):
    found = scores(text_statistics(corpus, variant=variant))
    assert found["red", "x"] == pytest.approx(red, abs=1e-12)
    assert found["pear", "x"] == pytest.approx(pear, abs=1e-12)
    assert found["pear", "y"] == pytest.approx(pear, abs=1e-12)


def test_unknown_options_are_refused(corpus):
    with pytest.raises(ValueError):
        text_statistics(corpus, variant="other")
    with pytest.raises(ValueError):
        text_statistics(corpus, zero="other")


def test_zero_denominator_policies(spark):
    docs = spark.createDataFrame([("x", ["all", "a1"]), ("y", ["all"])],
                                 "category string, tokens array<string>")
    assert ("all", "x") not in scores(term_statistics(docs, zero="skip"))
    assert scores(term_statistics(docs, zero="zero"))["all", "x"] == 0.0


def test_expected_counts(corpus):
    rows = {(r.term, r.category): r for r in text_statistics(corpus).collect()}
    deviant = {(r.term, r.category): r
               for r in text_statistics(corpus, deviant_expected=True).collect()}
    red = rows["red", "x"]
    assert (red.observed, red.total_term, red.total_category) == (2, 2, 3)
    assert red.expected == pytest.approx(2 * (3 / 6))
    assert deviant["red", "x"].expected == pytest.approx(2 * (3 - 2) / 6)


def test_null_document_counts(corpus):
    assert {r.category: r.documents for r in documents_per_category(corpus).collect()} == {"x": 3, "y": 3}


def test_count_identities(corpus):
    observed = documents_per_category_term(with_tokens(corpus))
    totals = {r.term: r.total_term for r in documents_per_term(observed).collect()}
    summed = {}
    for r in observed.collect():
        summed[r.term] = summed.get(r.term, 0) + r.observed
    assert summed == totals
    levels = count_levels(observed).filter(F.col("all_categories") == 1).collect()
    assert {r.term: r.documents for r in levels} == totals


def test_standard_score_is_not_negative_and_mirrors_over_two_categories(spark):
    docs = spark.createDataFrame(
        [("x" if i % 3 else "y", [f"t{j}" for j in range(12) if (i * (j + 3)) % 7 < 3])
         for i in range(60)], "category string, tokens array<string>")
    found = scores(term_statistics(docs))
    assert min(found.values()) >= 0
    for (term, category), value in found.items():
        other = found.get((term, "y" if category == "x" else "x"))
        assert other is None or value == pytest.approx(other)


def test_inlined_and_joined_stop_words_agree(corpus, spark):
    words = spark.createDataFrame([("red",), ("blue",), (None,)], "term string")
    inlined = scores(text_statistics(corpus, stop_words=["red", "blue"]))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (threshold, "-1"):      # a list small enough to broadcast, and one that is not
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert scores(text_statistics(corpus, stop_words=words)) == inlined
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {t for t, _ in inlined} == {"apple", "pear"}


def test_stop_words_with_quotes_and_backslashes(spark):
    docs = spark.createDataFrame([("x", ["it's", "a\\b", "ok"])], "category string, tokens array<string>")
    kept = documents_per_category_term(docs, stop_words=["it's", "a\\b"]).collect()
    assert [r.term for r in kept] == ["ok"]
