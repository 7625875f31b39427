import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import ChiSqSelector, CountVectorizer, VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lexisift.operators import features as X
from lexisift.operators import selection
from lexisift.operators.selection import log_upper_gamma
from lexisift.operators.tokens import term_frequencies, with_tokens
from lexisift.operators.vocabulary import (common_terms, merged_vocabulary, overlap,
                                           terms_only_in_first)


@pytest.fixture(scope="module")
def documents(spark):
    """120 documents over 30 terms; counts depend on document, term and category."""
    rows = []
    for i in range(120):
        category = "abc"[i % 3 if i % 7 else 0]
        text = " ".join(f"t{j:02d}".replace("0", "o").replace("1", "l").replace("2", "z")
                        .translate(str.maketrans("3456789", "efghijk")) for j in range(30)
                        for _ in range((i * (j + 1) + ord(category)) % 4 if (i + j) % 5 else 0))
        rows.append((i, category, text))
    return spark.createDataFrame(rows, "doc_id long, category string, text string")


SPEC = X.FeatureSpec(stop_words=(), selected=10, min_df=1)


@pytest.fixture(scope="module")
def fitted(documents):
    return X.fit_features(documents, SPEC, keep=["doc_id"])


@pytest.fixture(scope="module")
def frequencies(documents):
    return term_frequencies(with_tokens(documents, tokenizer="ml_regex"), ["doc_id", "category"],
                            min_length=1).persist()


def test_vectors_equal_relational_tfidf(fitted, frequencies, documents):
    idf = X.idf_table(X.vocabulary_table(frequencies, min_df=1), documents)
    relational = {(r.doc_id, r.term): r.tfidf for r in X.tfidf_table(frequencies, idf).collect()}
    vectors = {(r.doc_id, r.term): r.weight
               for r in X.vector_terms(fitted, "tfidf", ["doc_id"]).collect()}
    assert vectors.keys() == relational.keys()
    assert all(math.isclose(vectors[k], relational[k], rel_tol=1e-12) for k in vectors)


@pytest.mark.parametrize("min_df", [1, 30, 0.5])
def test_ranked_vocabulary_equals_the_vectorizer(documents, min_df):
    spec = X.FeatureSpec(stop_words=("tef",), min_df=min_df, vocabulary_size=1000)
    ranked = Pipeline(stages=[*X.token_stages(spec), X.vectorizer_stage(spec)]).fit(documents)
    estimated = Pipeline(stages=[*X.token_stages(spec), CountVectorizer(
        inputCol="clean_tokens", outputCol="tf", minDF=min_df, vocabSize=1000)]).fit(documents)
    assert sorted(ranked.stages[-1].vocabulary) == sorted(estimated.stages[-1].vocabulary)


def test_statistic_equals_chi_square_test(fitted, frequencies, documents):
    test = ChiSquareTest.test(fitted.frame, "tfidf", "label").first()
    expected = {term: (test.statistics[i], test.degreesOfFreedom[i])
                for i, term in enumerate(fitted.vocabulary)}
    got = X.feature_statistics(frequencies, documents).collect()
    assert len(got) == len(expected)
    for row in got:
        statistic, degrees = expected[row.term]
        assert row.statistic == pytest.approx(statistic, rel=1e-9, abs=1e-9)
        assert row.degrees == degrees


def test_selection_takes_the_smallest_p_values(fitted):
    test = ChiSquareTest.test(fitted.frame, "tfidf", "label").first()
    order = sorted(range(len(fitted.vocabulary)), key=lambda i: (test.pValues[i], i))[:10]
    chosen = {r.feature_index: r.term for r in X.selected_terms(fitted).collect()}
    assert chosen == {i: fitted.vocabulary[i] for i in order}


@pytest.mark.parametrize("selected", [1, 7, 25, 100])
def test_selector_equals_the_one_for_few_values(fitted, selected):
    plain = ChiSqSelector(numTopFeatures=selected, featuresCol="tfidf", labelCol="label", outputCol="s").fit(fitted.frame)
    own = X.selector_stage(selected, output="own").fit(fitted.frame)
    assert own.selectedFeatures == sorted(plain.selectedFeatures)
    compared = own.transform(plain.transform(fitted.frame)).select("s", "own").collect()
    assert all(r.s == r.own for r in compared)


def test_selector_takes_any_number_of_distinct_values(spark):
    """One value per row: more than Spark's own selector allows."""
    rows = (spark.range(13_500).select(
        (F.col("id") % 3).cast("double").alias("label"), F.col("id").cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(0.0).alias("y"), (F.col("id") % 7).cast("double").alias("z")))
    vectors = VectorAssembler(inputCols=["z", "x", "y"], outputCol="features").transform(rows)
    selector = X.ContingencySelector(numTopFeatures=1)
    found = {r.feature_index: r for r in selector.ranked(vectors).collect()}
    assert found[1].df == 13_499 and found[1].degrees == 13_499 * 2
    assert found[1].statistic == pytest.approx(27_000, rel=1e-9)
    assert selector.fit(vectors).selectedFeatures == [2]
    assert selector.copy({selector.numTopFeatures: 2}).fit(vectors).selectedFeatures == [1, 2]
    assert X.ContingencySelector(numTopFeatures=9).fit(vectors).selectedFeatures == [0, 1, 2]


def test_selector_on_odd_rows(spark):
    schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    rows = spark.createDataFrame(
        [(0.0, Vectors.sparse(4, {1: 1.0})), (1.0, Vectors.sparse(4, {})), (None, Vectors.sparse(4, {0: 1.0})),
         (0.0, Vectors.dense([0.0, 1.0, 0.0, 0.0]))], schema)
    assert X.ContingencySelector(numTopFeatures=2).fit(rows).selectedFeatures == [0, 1]
    assert X.ContingencySelector(numTopFeatures=2).fit(rows.limit(0)).selectedFeatures == []


def test_logarithms_of_p_values():
    """Against the closed forms: exp(-x) sum x^i / i! for whole shapes, and erfc for one half."""
    for shape in (1, 2, 5, 40, 300):
        for x in (0.0, 0.01, 0.5, 1.0, shape * 0.7, float(shape), shape + 1.0, shape * 1.3, shape * 4.0, shape * 40.0):
            terms = [i * math.log(x) - math.lgamma(i + 1) for i in range(shape)] if x else [0.0]
            top = max(terms)
            want = -x + top + math.log(math.fsum(math.exp(t - top) for t in terms))
            assert log_upper_gamma(shape, x).item() == pytest.approx(want, rel=1e-10, abs=1e-13)
    for x in (0.01, 0.3, 1.0, 5.0, 30.0):
        assert log_upper_gamma(0.5, x).item() == pytest.approx(math.log(math.erfc(math.sqrt(x))), rel=1e-10)
    assert log_upper_gamma([3.0], [2000.0]).item() < -1900     # far below what a double can hold as a p-value
    assert log_upper_gamma(20_000.0, 20_000.0).item() == pytest.approx(math.log(0.5), abs=0.01)


def test_label_index_equals_stage(fitted, documents):
    table = {r.category: r.label for r in X.label_index_table(documents).collect()}
    stage = {r.category: r.label for r in fitted.frame.select("category", "label").distinct().collect()}
    assert stage == table


def test_features_are_unit_vectors(fitted):
    sums = (fitted.frame.select(F.unwrap_udt("features").alias("v"))
            .select(F.aggregate("v.values", F.lit(0.0), lambda s, x: s + x * x).alias("s")).collect())
    assert all(r.s == 0 or math.isclose(r.s, 1.0) for r in sums)


def test_fitting_on_a_part_ignores_the_rest(documents):
    part = X.fit_features(documents, SPEC, keep=["doc_id"], fit_on=F.col("category") != "c")
    other = X.fit_features(documents.filter(F.col("category") != "c"), SPEC, keep=["doc_id"])
    assert sorted(part.vocabulary) == sorted(other.vocabulary)
    assert sorted(part.labels) == ["a", "b", "c"] and sorted(other.labels) == ["a", "b"]
    assert part.frame.select("category", "label").distinct().count() == 3


def test_heavier_selection(fitted):
    heavy = X.reselect(fitted, 4)
    assert heavy.select(F.unwrap_udt("heavy_selected").alias("v")).first().v["size"] == 4


def test_documents_are_read_once(spark, tmp_path, documents):
    """Vocabulary, counts and weights all come from the terms that one scan wrote."""
    path = str(tmp_path / "documents")
    documents.repartition(3).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)
    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch
    source = spark.read.parquet(path)
    X.fit_features(source.mapInArrow(counting, source.schema), SPEC, keep=["doc_id"]).frame.count()
    assert reads.value == 120


def test_vocabulary_limits_and_ties(spark):
    rows = spark.createDataFrame([(["b", "a", "c", "c"],), (["b", "a"],), (["d"],), ([],)], "tokens array<string>")
    def words(**options):
        return X.RankedVectorizer(**options).fit(rows).vocabulary
    assert words() == ["a", "b", "c", "d"]
    assert words(vocabSize=2) == ["a", "b"]
    assert words(minDF=2) == ["a", "b"] and words(minDF=0.5) == ["a", "b"]
    with pytest.raises(ValueError):
        words(minDF=5)
    copied = X.RankedVectorizer(vocabSize=2).copy({X.RankedVectorizer.minDF: 2})
    assert copied.fit(rows).vocabulary == ["a", "b"]


@pytest.mark.parametrize("normalize", ["before", "after", "none"])
def test_stage_orders(normalize):
    names = [type(s).__name__ for s in X.feature_stages(X.FeatureSpec(normalize=normalize))]
    assert names[:5] == ["RegexTokenizer", "StopWordsRemover", "RankedVectorizer", "IDF", "StringIndexer"]
    assert names[5:] == {"before": ["Normalizer", "ContingencySelector"],
                         "after": ["ContingencySelector", "Normalizer"], "none": ["ContingencySelector"]}[normalize]


def test_vocabulary_comparison(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "term string")
    right = spark.createDataFrame([("b",), ("c",), ("d",)], "term string")
    assert sorted(r.term for r in common_terms(left, right).collect()) == ["b", "c"]
    assert [r.term for r in terms_only_in_first(left, right).collect()] == ["a"]
    assert tuple(overlap(left, right).first()) == (2, 1, 1, 66.67)
    empty = left.limit(0)
    assert tuple(overlap(empty, empty).first()) == (0, 0, 0, None)


def test_merged_vocabulary_scopes(spark):
    scored = spark.createDataFrame([("x", "a", 2.0), ("x", "b", 1.0), ("y", "a", 3.0)],
                                   "category string, term string, chi2 double")
    assert {r.term for r in merged_vocabulary(scored, k=1).collect()} == {"a"}
    assert {r.term for r in merged_vocabulary(scored, "all").collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        merged_vocabulary(scored, "other")


def test_label_missing_from_the_fitting_rows(spark):
    rows = spark.createDataFrame(
        [(k, ("x", "y", "z")[k % 3], f"word{k % 3} common other") for k in range(30)],
        "doc_id long, category string, text string")
    spec = X.FeatureSpec(min_df=1, selected=5)
    fitted = X.fit_features(rows, spec, keep=["doc_id"], fit_on=F.col("category") != "z")
    assert sorted(fitted.labels) == ["x", "y", "z"]
    assert {r.category: r.label for r in fitted.frame.collect()}.keys() == {"x", "y", "z"}


def test_lines_of_few_categories_are_shuffled_once(spark, monkeypatch):
    """Columns per category give what cells as rows give, with one exchange by value and one by feature."""
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "category string")
    entries = spark.createDataFrame(
        [(1, 0.5, "a"), (1, 0.5, "b"), (1, 0.25, "a"), (2, None, "c"), (2, 1.0, None), (3, 1.0, None),
         (None, 1.0, "a"), (4, 1.0, "b"), (4, 1.0, "b"), (5, 2.0, "d")], "term int, n double, category string")
    found, plans = [], []
    for most in (16, 2):
        monkeypatch.setattr(selection, "MOST_COLUMNS", most)
        statistics = selection.contingency_statistics(entries, rows, "term", "n")
        found.append({r.term: (r.df, r.degrees, round(r.statistic, 9)) for r in statistics.collect()})
        plans.append(statistics._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning"))
    assert found[0] == found[1] and set(found[0]) == {1, 2, 4}
    assert plans[0] == 2 < plans[1]
