import json

import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.operators.counts import documents_per_category_term
from lexisift.operators.ranking import top_terms
from lexisift.operators.tokens import term_frequencies
from lexisift.session import Workspace, durable, located, shared_folder, shared_root, spread
from lexisift.sinks import reports, tables
from lexisift.sources import corpus as C
from lexisift.sources import token_csv, words


@pytest.fixture
def review_lines(tmp_path):
    rows = [{"reviewerID": "1", "category": "Book", "reviewText": "Good", "summary": "s",
             "helpful": [1, 2], "overall": 4.0},
            {"reviewerID": "2", "reviewText": "no category"},
            {"reviewerID": "3", "category": None, "reviewText": "null category"},
            {"reviewerID": "4", "category": "Toy", "reviewText": None},
            {"reviewerID": "5", "category": "Toy", "summary": "only title"}]
    path = tmp_path / "reviews.json"
    path.write_text("\n".join([json.dumps(r) for r in rows] + ['{"reviewerID": "6", "cat']))
    return str(path)


def ids(df):
    return sorted(r.reviewerID for r in df.collect() if r.reviewerID)


def test_broken_line_dropped_or_null(spark, review_lines):
    dropped = C.read_reviews(spark, review_lines)
    assert ids(dropped) == ["1", "2", "3", "4", "5"]
    kept = C.read_reviews(spark, review_lines, malformed="null")
    assert kept.count() == 6
    assert ids(C.drop_nulls(kept, ["reviewText", "category"])) == ["1"]
    with pytest.raises(Exception):
        C.read_reviews(spark, review_lines, malformed="fail").collect()
    with pytest.raises(ValueError):
        C.read_reviews(spark, review_lines, malformed="other")


def test_inferred_schema(spark, review_lines):
    df = C.read_reviews_inferred(spark, review_lines)
    assert {"reviewerID", "category", "reviewText", "summary"} <= set(df.columns)


def test_schema_variants():
    assert C.review_schema()["overall"].dataType == T.DoubleType()
    assert C.review_schema(T.FloatType())["overall"].dataType == T.FloatType()


def test_null_policies(spark, review_lines):
    df = C.compose_text(C.read_reviews(spark, review_lines), ["reviewText", "summary"])
    assert {r.reviewerID: r.text for r in df.collect()}["5"] == " only title"
    rows = C.labelled_documents(df, "text", "category").collect()
    assert sorted(r.category for r in rows) == ["Book", "Toy", "Toy"]
    rows = C.labelled_documents(df, "text", "category", null_category="empty").collect()
    assert sorted(r.category for r in rows) == ["", "", "Book", "Toy", "Toy"]
    rows = C.labelled_documents(df, "reviewText", "category", null_text="drop").collect()
    assert [r.category for r in rows] == ["Book"]
    with pytest.raises(ValueError):
        C.labelled_documents(df, "text", "category", null_text="other")


def test_word_files(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("the\n and\t\nthe\n\nof\n")
    assert sorted(r.term for r in words.read_words(spark, str(path)).collect()) == ["and", "of", "the"]
    unstripped = words.read_words(spark, str(path), strip=False).collect()
    assert sorted(r.term for r in unstripped) == [" and\t", "of", "the"]
    missing = words.read_words_if_present(spark, str(tmp_path / "none.txt"))
    assert missing.collect() == [] and missing.columns == ["term"]


def test_stop_words_of_any_length_and_with_nulls(spark):
    rows = spark.createDataFrame([("a", ["the", "cat"]), ("b", ["dog", "x9"])], "category string, tokens array<string>")
    def left(stop_words):
        return sorted(r.term for r in term_frequencies(rows, ["category"], stop_words=stop_words).collect())
    many = [f"w{k}" for k in range(12_000)]
    assert left([*many, None, "the"]) == ["cat", "dog", "x9"]
    frame = spark.createDataFrame([(w,) for w in [*many, None, "the"]], "term string")
    assert left(frame) == ["cat", "dog", "x9"]
    observed = documents_per_category_term(rows, stop_words=frame)
    assert sorted(r.term for r in observed.collect()) == ["cat", "dog", "x9"]


def test_token_csv_rows_and_rejects(spark, tmp_path):
    path = tmp_path / "tokens.csv"
    path.write_text("reviewText_tokens,category\n"
                    "\"['Good ', 'good', 'it', '']\",Book\n"
                    "\"['a'],Toy\n"
                    "\"['a']\",Toy,extra\n"
                    "\"['a']\"\n"
                    "\"['a']\",\n"
                    "oops,Toy\n"
                    "\"{'a': 1}\",Toy\n"
                    "\"[]\",Toy\n")
    rows = token_csv.read_token_csv(spark, str(path))
    valid = {(r.category, tuple(r.tokens)) for r in token_csv.valid_rows(rows).collect()}
    assert valid == {("Book", ("good", "good", "it")), ("Toy", ())}
    reasons = sorted(r.reject for r in token_csv.rejected_rows(rows).collect())
    assert reasons.count("token list") == 2 and reasons.count("empty field") == 1
    assert len(reasons) == 6
    lines = {r.line for r in token_csv.rejected_rows(rows).collect()}
    assert "\"['a']\",Toy,extra" in lines and "oops,Toy" in lines
    with pytest.raises(ValueError):
        token_csv.read_token_csv(spark, str(path), category="label")
    with pytest.raises(ValueError):
        token_csv.read_token_csv(spark, str(path), header=False)


@pytest.mark.parametrize("single_quotes", [False, True])
def test_token_csv_round_trip(spark, tmp_path, single_quotes):
    df = spark.createDataFrame([("Book", ["good", "naïve"]), ("Toy, large", []), ("Car", ["it's", "ok", "a\"b", "c\\d"])],
                               "category string, tokens array<string>")
    path = str(tmp_path / "csv")
    tables.write_token_csv(df, path, single_quotes=single_quotes)
    back = token_csv.valid_rows(token_csv.read_token_csv(spark, path))
    assert {(r.category, tuple(r.tokens)) for r in back.collect()} == {
        ("Book", ("good", "naïve")), ("Toy, large", ()), ("Car", ("it's", "ok", "a\"b", "c\\d"))}


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [("b", "x", 0.0625), ("b", "w", 12.0), ("b", "v", 12.0), ("a", "z", 1.0005), ("a", "y", 0.05)],
        "category string, term string, chi2 double")


def test_ties_rank_by_term(scored):
    rows = [(r.category, r.rank, r.term) for r in top_terms(scored, 2).orderBy("category", "rank").collect()]
    assert rows == [("a", 1, "z"), ("a", 2, "y"), ("b", 1, "v"), ("b", 2, "w")]


def test_lines(scored):
    top = top_terms(scored)
    def lines(**options):
        return {r.category: r.line for r in reports.category_lines(top, **options).collect()}
    assert lines()["b"] == "b v:12.000 w:12.000 x:0.062"
    assert lines()["a"] == "a z:1.000 y:0.050"
    assert lines(number="rounded")["b"] == "b v:12.0 w:12.0 x:0.062"
    assert lines(number="unrounded", brackets=True)["b"] == "<b> v:12.0 w:12.0 x:0.0625"
    assert [r.line for r in reports.report_lines(top).collect()] == [
        "a z:1.000 y:0.050", "b v:12.000 w:12.000 x:0.062", "v w x y z"]


def test_vocabulary_of_a_report(spark, tmp_path):
    path = tmp_path / "output.txt"
    path.write_text("Book good:12.500 a^b:3.000\n<Toy Box> fun:1.0E-4\ngood a^b fun\n")
    terms = words.read_report_vocabulary(spark, str(path)).collect()
    assert sorted(r.term for r in terms) == ["a^b", "fun", "good"]


def test_marked_vocabulary_may_look_like_scores(spark, tmp_path):
    top = spark.createDataFrame([("b", "x:3", 2.0, 1), ("b", "y", 1.0, 2)],
                                "category string, term string, chi2 double, rank int")
    path = str(tmp_path / "report")
    tables.write_lines(reports.report_lines(top, mark="vocabulary: "), path)
    terms = words.read_report_vocabulary(spark, path, "vocabulary: ").collect()
    assert sorted(r.term for r in terms) == ["x:3", "y"]


@pytest.mark.parametrize("one_per_line", [True, False])
def test_terms_are_written_sorted(spark, scored, tmp_path, one_per_line):
    path = tmp_path / "terms"
    tables.write_terms(scored, str(path), one_per_line=one_per_line)
    text = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    assert text.split() == ["v", "w", "x", "y", "z"]
    assert ("\n" in text) == one_per_line
    assert sorted(r.term for r in words.read_vocabulary(spark, str(path)).collect()) == ["v", "w", "x", "y", "z"]


def test_statistics_and_compression(spark, scored, tmp_path):
    tables.write_statistics(scored, str(tmp_path / "tsv"), compression="gzip")
    back = spark.read.schema(scored.schema).option("sep", "\t").option("header", True).csv(str(tmp_path / "tsv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, scored.collect()))
    tables.write_lines(reports.category_lines(top_terms(scored)).select("line"),
                       str(tmp_path / "snappy"), compression="snappy")
    assert list((tmp_path / "snappy").glob("*.snappy"))
    assert spark.read.text(str(tmp_path / "snappy")).count() == 2


def test_shared_folder_is_the_configured_one(spark):
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    df = durable(spark.range(10), "check")
    assert df.count() == 10
    assert all(root in f for f in df.inputFiles())


def test_spread_only_when_splits_are_few(spark):
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == 8
    assert spread(spark.range(10, numPartitions=50)).rdd.getNumPartitions() == 50


def test_preview(scored):
    assert reports.preview(scored.orderBy(F.col("chi2").desc()), 1).count() == 1


def test_json_rejects_keep_line_and_reason(spark, tmp_path):
    good = b'{"reviewerID": "a", "reviewText": "fine", "category": "x"}'
    lines = [good, b'{"reviewerID": "b", "overall": "high", "category": "x"}', b'{"reviewerID": ', b"[1, 2]", b"7", b"", b"  ",
             b'{"reviewerID": "c", "reviewText": "caf\xe9 \xff!", "category": "y"}', b'{"reviewText": "\xc3"']
    (tmp_path / "r.json").write_bytes(b"\n".join(lines) + b"\n")
    rows = C.read_reviews_marked(spark, str(tmp_path / "r.json"))
    valid = {r.reviewerID: (r.reviewText, r.category) for r in C.valid_reviews(rows).collect()}
    assert valid == {"a": ("fine", "x"), "c": ("caf\ufffd \ufffd!", "y")}
    assert C.valid_reviews(rows).columns == C.REVIEW_SCHEMA.names
    rejects = sorted((r.reject, r.line) for r in C.rejected_reviews(rows).collect())
    assert rejects == sorted([("field type", lines[1].decode()), ("not JSON", lines[2].decode()), ("not JSON", "[1, 2]"),
                              ("not JSON", "7"), ("not JSON", '{"reviewText": "\ufffd"')])


def test_csv_bytes_that_are_not_utf8(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b'reviewText_tokens,category\n"[\'caf\xe9\',\'ok\']",x\n"[\'open",caf\xff\n')
    rows = token_csv.read_token_csv(spark, str(tmp_path / "t.csv"))
    assert [(r.tokens, r.category) for r in token_csv.valid_rows(rows).collect()] == [(["caf\ufffd", "ok"], "x")]
    rejected = token_csv.rejected_rows(rows).collect()
    assert [(r.reject, "\ufffd" in r.line) for r in rejected] == [("token list", True)]
    long = "é" * 150
    (tmp_path / "l.csv").write_text(f"reviewText_tokens,category\n{long},x\n", encoding="utf-8")
    preview = token_csv.rejected_rows(token_csv.read_token_csv(spark, str(tmp_path / "l.csv"))).first().preview
    assert preview == long[:token_csv.PREVIEW_CHARACTERS]


def test_workspace_deletes_what_it_owns(spark):
    def there(folder):
        store, path = located(folder)
        return store.get_file_info(path).type == fs.FileType.Directory
    outside = shared_folder(spark, "kept")
    durable(spark.range(3), "kept").count()
    with Workspace(spark) as outer:
        table = durable(spark.range(10), "table")
        with Workspace(spark) as inner:
            assert durable(spark.range(5), "table").count() == 5
        assert len(inner.folders) == 1 and not there(inner.folders[0])
        assert table.count() == table.count() == 10          # read again, as by a retried task
        assert there(outer.folders[0])
    assert not there(outer.folders[0]) and outside not in outer.folders
    with pytest.raises(ZeroDivisionError), Workspace(spark) as failed:
        durable(spark.range(2), "table")
        1 / 0
    assert not there(failed.folders[0])
