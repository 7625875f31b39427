"""What the plans must keep at any size: one tokenization, pruned scans, no hot tasks."""

import re

import pytest
from pyspark.sql import functions as F

from lexisift.operators.chi_square import text_statistics
from lexisift.operators.ranking import top_terms
from lexisift.operators.tokens import document_terms, with_tokens
from lexisift.sources.corpus import labelled_documents


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third and more of the rows in one category, one term in every document."""
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    ids = spark.range(3000)
    (ids.select(F.col("id").alias("doc_id"),
                F.when(F.col("id") % 5 < 3, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("lang"),
                F.concat_ws(" ", F.lit("common"), F.concat(F.lit("w"), F.translate(
                    (F.col("id") % 97).cast("string"), "0123456789", "abcdefghij")),
                    F.concat(F.lit("v"), F.translate((F.col("id") % 11).cast("string"),
                                                     "0123456789", "klmnopqrst"))).alias("text"),
                F.lit("unused").alias("source"))
     .repartition(12).write.parquet(path))
    return path


def statistics(spark, path, **options):
    documents = labelled_documents(spark.read.parquet(path), "text", "lang")
    return text_statistics(documents, stop_words=["the"], zero="zero", **options)


def final_plan(df):
    collected = df.agg(F.sum("chi2"))
    collected.collect()
    return collected._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def brute_force(spark, path):
    """The definition, straight from the rows."""
    docs = [(r.lang, set(r.text.split())) for r in spark.read.parquet(path).collect()]
    n, pairs = len(docs), {}
    terms = {t for _, words in docs for t in words}
    in_category, with_term, both = {}, {}, {}
    for lang, found in docs:
        in_category[lang] = in_category.get(lang, 0) + 1
        for t in found:
            with_term[t] = with_term.get(t, 0) + 1
            both[t, lang] = both.get((t, lang), 0) + 1
    for (t, lang), a in both.items():
        b, c = with_term[t] - a, in_category[lang] - a
        d = n - in_category[lang] - b
        den = (a + b) * (a + c) * (b + d) * (c + d)
        pairs[t, lang] = n * (a * d - b * c) ** 2 / den if den else 0.0
    assert terms == set(with_term)
    return pairs


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_scores_under_skew_with_and_without_broadcast(spark, skewed, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {(r.term, r.category): r.chi2 for r in statistics(spark, skewed).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = brute_force(spark, skewed)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], rel=1e-9, abs=1e-9) for k in got)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_text_is_tokenized_once(spark, skewed, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = final_plan(statistics(spark, skewed))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Generate explode") == 1
    # The counted rows are shuffled for the count, for the term totals, and without broadcast once more.
    assert len(re.findall(r"Exchange hashpartitioning\(term", plan)) == 1


def test_scans_read_only_what_is_used(spark, skewed):
    plan = statistics(spark, skewed)._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: (\S+)", plan))
    assert schemas == {"struct<lang:string,text:string>", "struct<lang:string>"}
    assert "PushedFilters: [IsNotNull(lang)]" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_ranking_prunes_before_its_shuffle(spark, skewed):
    plan = top_terms(statistics(spark, skewed), 5)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_term_rows_compile_with_the_scan(spark, skewed):
    documents = labelled_documents(spark.read.parquet(skewed), "text", "lang")
    rows = document_terms(with_tokens(documents), ["category"], words=["the"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert re.search(r"\*\(1\) Generate", plan)


def test_stop_frames_are_joined_after_counting(spark, skewed):
    words = spark.createDataFrame([("common",), ("the",)], "term string")
    documents = labelled_documents(spark.read.parquet(skewed), "text", "lang")
    scored = text_statistics(documents, stop_words=words, zero="zero")
    plan = final_plan(scored)
    assert plan.count("Generate explode") == 1
    below_the_shuffle = plan[plan.index("partial_count(1)"):plan.index("Generate explode")]
    assert "Join" not in below_the_shuffle
    got = {(r.term, r.category): r.chi2 for r in scored.collect()}
    expected = {k: v for k, v in brute_force(spark, skewed).items() if k[0] != "common"}
    assert got.keys() == expected.keys()


def test_nullable_categories_share_one_tokenization(spark, skewed):
    documents = spark.read.parquet(skewed).select(F.col("lang").alias("category"), "text")
    assert documents.schema["category"].nullable
    plan = final_plan(text_statistics(documents, zero="zero"))
    assert plan.count("Generate explode") == 1
