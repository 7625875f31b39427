import random

import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from lexisift.operators import arrow_terms as A
from lexisift.operators import features as X
from lexisift.operators.tokens import term_frequencies
from lexisift.operators.vectorize import vectorizer_model
from lexisift.operators.vocabulary import document_frequencies

LETTERS = "aAbBéÉßİΣσςÖ€§ \n\t\r\x0b\f0123456789.,-_'`~  漢😀ǅ\x85\x1c" + r"""()[]{}!?;:+="#@&*%$\/""" + "tTheinandIs " * 4


@pytest.fixture(scope="module")
def odd(spark):
    """Empty texts, texts of delimiters or stop words only, other scripts and every delimiter."""
    pick = random.Random(3)
    texts = ["", " ", "the", "The THE Is is", "€", "a€", "§§b", "Σ", "ΑΣ ΑΣ1Σ", "İs I'll", "\n\n", "x" * 400] + [
        "".join(pick.choice(LETTERS) for _ in range(pick.choice([0, 1, 3, 20, 200]))) for _ in range(400)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()


@pytest.mark.parametrize("stop_words", [None, (), ("A", "éb", "T")])
@pytest.mark.parametrize("tokenizer", ["ml_regex", "ml_regex_literal", "whitespace"])
def test_counts_are_those_of_the_stages(odd, monkeypatch, tokenizer, stop_words):
    spec = X.FeatureSpec(tokenizer=tokenizer, stop_words=stop_words, min_df=1)
    stages = X.token_stages(spec)
    plain, counted = PipelineModel(stages).transform(odd), A.applied(stages, odd, counted=True)
    assert set(counted.columns) >= {"doc_id", "text", "clean_tokens"}
    totals = document_frequencies(term_frequencies(plain, [], "clean_tokens", min_length=0))
    model = X.vectorizer_stage(spec).fit(counted)
    vectors = dict(model.transform(plain).select("doc_id", "tf").collect())
    for rows in (plain, counted):
        assert sorted(A.term_totals(rows, "clean_tokens").collect()) == sorted(totals.collect())
        assert dict(A.applied([model], rows).select("doc_id", "tf").collect()) == vectors


def test_terms_are_kept_once_a_text(spark, odd):
    """What is written between tokenizer and vectorizer has each term of a text once, and no list of strings."""
    counted = A.applied(X.token_stages(X.FeatureSpec(stop_words=())), odd, counted=True)
    assert counted.schema["clean_tokens"].dataType.simpleString() == "struct<terms:string,counts:binary>"
    for row in counted.select("clean_tokens").collect():
        terms = row.clean_tokens.terms.split(" ") if row.clean_tokens.terms else []
        assert len(set(terms)) == len(terms) and len(row.clean_tokens.counts) == 4 * len(terms)


def test_pieces_do_not_change_what_is_found(monkeypatch):
    pick = random.Random(4)
    text = pa.array(["".join(pick.choice("ab€ .é1") for _ in range(pick.randrange(30))) for _ in range(200)])
    lists = pa.array([[*"abca"], None, [], ["b", None, "b"], ["d"] * 9])
    stop, known = pa.array(["ab"]), pa.array(["a", "é", "b", "ba"])

    def found():
        counted = A.counted_words(text.slice(3), " .€1", stop)
        frequencies = [*A.partial_frequencies(iter([pa.record_batch({"t": lists}), pa.record_batch({"t": counted.slice(2)})]))]
        totals = pa.Table.from_batches(frequencies).group_by("term").aggregate([("df", "sum"), ("cf", "sum")]).sort_by("term").to_pylist()
        return totals, A.count_vectors(counted, known).to_pylist(), A.count_vectors(lists.drop_null().slice(1), known).to_pylist()

    whole = found()
    for name in ("TEXT_BYTES", "TERM_BYTES", "TOKENS"):
        monkeypatch.setattr(A, name, 7)
    assert found() == whole
    assert {r["term"]: (r["df_sum"], r["cf_sum"]) for r in whole[0]}["d"] == (1, 9)
    assert A.counted_words(pa.array([], pa.string()), " ", stop).to_pylist() == A.count_vectors(pa.array([], pa.list_(pa.string())), known).to_pylist() == []
    with pytest.raises(ValueError):
        A.counted_words(pa.array([None], pa.string()), " ", stop)


def test_a_vocabulary_is_handed_over_whole(spark):
    control = [chr(c) for c in range(32)]
    for terms in (["b", "", "a\nc", "é😀", "\x00"], [""], ["x", *control]):
        own = vectorizer_model(spark, terms, "tokens", "tf")
        plain = CountVectorizerModel.from_vocabulary(terms, "tokens", "tf")
        assert own.vocabulary == plain.vocabulary == terms
        assert {p.name: v for p, v in own.extractParamMap().items()} == {p.name: v for p, v in plain.extractParamMap().items()}


def test_a_model_with_its_own_rules_is_left_alone(odd):
    spec = X.FeatureSpec(stop_words=(), min_df=1)
    rows = PipelineModel(X.token_stages(spec)).transform(odd)
    model = X.vectorizer_stage(spec).fit(rows)
    for setting in ({model.binary: True}, {model.minTF: 2.0}):
        changed = model.copy(setting)
        expected = changed.transform(rows).select("doc_id", "tf")
        assert dict(A.applied([changed], rows).select("doc_id", "tf").collect()) == dict(expected.collect())
    assert A.applied([], odd).where(F.lit(False)).count() == 0
