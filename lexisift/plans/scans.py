"""Sources and sinks: what is written from the tables reads back whole.

The files go to the folder named in ``spark.checkpoint.dir``, a new one per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.functions.tokenizers import TOKENIZERS
from lexisift.operators.chi_square import STATISTICS, term_statistics
from lexisift.operators.counts import documents_per_category_term, documents_per_term
from lexisift.operators.ranking import order_by_category, top_terms
from lexisift.operators.tokens import with_tokens
from lexisift.operators.vocabulary import merged_vocabulary
from lexisift.plans import corpora, sql
from lexisift.plans.ranking import scored
from lexisift.plans.registry import query
from lexisift.session import shared_folder, spread
from lexisift.sinks.reports import category_lines, report_lines
from lexisift.sinks.tables import (list_literal, write_lines, write_statistics, write_terms,
                                   write_token_csv)
from lexisift.sources import corpus, token_csv, words

REVIEWS = "SELECT doc_id::VARCHAR AS id, text, source AS summary, lang AS category FROM documents"


@query("scan_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_documents(spark, folder):
    return corpus.read_table(spark, folder, "documents",
                             ["doc_id", "text", "lang", "source", "n_chars"])


@query("project_rename", "SELECT text, lang AS label FROM documents")
def project_rename(spark, folder):
    return corpus.rename_columns(corpus.read_table(spark, folder, "documents"),
                                 {"text": "text", "lang": "label"})


@query("text_compose", "SELECT doc_id, text || ' ' || source AS text FROM documents")
def text_compose(spark, folder):
    table = corpus.read_table(spark, folder, "documents", ["doc_id", "text", "source"])
    return corpus.compose_text(table, ["text", "source"]).select("doc_id", "text")


@query("drop_nulls", """SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NOT NULL AND lang IS NOT NULL""")
def drop_nulls(spark, folder):
    """Documents without a label carry nulls, which the filter removes."""
    table = (corpus.read_table(spark, folder, "documents", ["doc_id", "lang"])
             .join(corpus.read_table(spark, folder, "labels", ["doc_id", "quality"]), "doc_id", "left"))
    return corpus.drop_nulls(table, ["quality", "lang"])


def _write_reviews(spark: SparkSession, folder: str, broken: bool) -> str:
    """Documents as review records, one JSON object per line, with a broken line each if wanted."""
    table = spread(corpus.read_table(spark, folder, "documents", ["doc_id", "text", "source", "lang"]))
    good = F.to_json(F.struct(
        F.col("doc_id").cast("string").alias("reviewerID"), F.col("text").alias("reviewText"),
        F.col("source").alias("summary"), F.col("lang").alias("category")))
    bad = F.concat(F.lit('{"reviewerID": "'), F.col("doc_id").cast("string"), F.lit('", "reviewText": '))
    lines = F.explode(F.array(good, bad)) if broken else good
    path = shared_folder(spark, "reviews")
    write_lines(table.select(lines.alias("value")), path)
    return path


def _reviews(df: DataFrame) -> DataFrame:
    return df.select(F.col("reviewerID").alias("id"), F.col("reviewText").alias("text"),
                     "summary", "category")


@query("json_roundtrip", REVIEWS)
def json_roundtrip(spark, folder):
    """Declared schema; every second line is broken and left out."""
    return _reviews(corpus.read_reviews(spark, _write_reviews(spark, folder, broken=True)))


@query("json_permissive_roundtrip", REVIEWS)
def json_permissive(spark, folder):
    """Broken lines become null rows, which the null filter removes."""
    rows = corpus.read_reviews(spark, _write_reviews(spark, folder, broken=True),
                               corpus.review_schema(T.FloatType()), malformed="null")
    return _reviews(corpus.drop_nulls(rows, ["reviewText", "category"]))


REJECTS = """SELECT 'not JSON' AS reject, '{"reviewerID": "' || doc_id::VARCHAR || '", "reviewText": ' AS line FROM documents
UNION ALL
SELECT 'field type', '{"reviewerID":"' || doc_id::VARCHAR || '","overall":"high"}' FROM documents WHERE doc_id % 3 = 0"""


def _write_damaged_reviews(spark: SparkSession, folder: str) -> str:
    """Review lines, a broken one behind each, and for every third one with a value of another type."""
    table = spread(corpus.read_table(spark, folder, "documents", ["doc_id", "text", "source", "lang"]))
    number = F.col("doc_id").cast("string")
    good = F.to_json(F.struct(number.alias("reviewerID"), F.col("text").alias("reviewText"),
                              F.col("source").alias("summary"), F.col("lang").alias("category")))
    broken = F.concat(F.lit('{"reviewerID": "'), number, F.lit('", "reviewText": '))
    typed = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(number.alias("reviewerID"), F.lit("high").alias("overall"))))
    path = shared_folder(spark, "reviews")
    write_lines(table.select(F.explode(F.array_compact(F.array(good, broken, typed))).alias("value")), path)
    return path


@query("json_rejects", REJECTS)
def json_rejects(spark, folder):
    """Lines that are no valid records, whole and with the reason."""
    return corpus.rejected_reviews(corpus.read_reviews_marked(spark, _write_damaged_reviews(spark, folder)))


@query("json_marked_roundtrip", REVIEWS)
def json_marked(spark, folder):
    """The valid records of the same lines."""
    return _reviews(corpus.valid_reviews(corpus.read_reviews_marked(spark, _write_damaged_reviews(spark, folder))))


@query("json_inferred_roundtrip", REVIEWS)
def json_inferred(spark, folder):
    return _reviews(corpus.read_reviews_inferred(spark, _write_reviews(spark, folder, broken=False)))


def _token_csv(spark: SparkSession, folder: str, single_quotes: bool = False) -> DataFrame:
    documents = with_tokens(corpora.documents(spark, folder), tokenizer="regex")
    path = shared_folder(spark, "tokens")
    write_token_csv(documents, path, keep=["doc_id"], single_quotes=single_quotes)
    return token_csv.read_token_csv(spark, path, columns=["doc_id", "reviewText_tokens", "category"])


TOKEN_TEXT = f"""SELECT doc_id, lang AS category,
  array_to_string(list_filter({sql.token_list('regex')}, lambda t: t <> ''), ' ') AS tokens
FROM documents WHERE lang IS NOT NULL"""


@query("csv_tokens_roundtrip", TOKEN_TEXT)
def csv_roundtrip(spark, folder):
    rows = token_csv.valid_rows(_token_csv(spark, folder))
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "category",
                       F.array_join("tokens", " ").alias("tokens"))


@query("csv_chi2", f"{sql.chi(tokenizer='regex', variant='mixed')}\n"
                   f"SELECT {', '.join(STATISTICS)} FROM scored")
def csv_chi2(spark, folder):
    """The two-step job: tokenized CSV first, statistics from it afterwards."""
    rows = token_csv.valid_rows(_token_csv(spark, folder, single_quotes=True))
    return term_statistics(rows, stop_words=corpora.STOP_WORDS(), variant="mixed").select(*STATISTICS)


@query("csv_rejects", """SELECT reject, count(*) AS rows FROM (
  SELECT CASE doc_id % 5 WHEN 0 THEN 'column count' WHEN 1 THEN 'empty field'
              WHEN 2 THEN 'token list' WHEN 3 THEN 'token list' END AS reject FROM documents)
WHERE reject IS NOT NULL GROUP BY reject""")
def csv_rejects(spark, folder):
    """All documents as token lines, four of five damaged in different ways, counted by reason."""
    table = spread(corpus.read_table(spark, folder, "documents", ["doc_id", "text", "lang"]))
    literal = F.concat(F.lit('"'), list_literal(
        TOKENIZERS["regex"](F.col("text")), single_quotes=True), F.lit('"'))
    comma = F.lit(",")
    kind = F.col("doc_id") % 5
    line = (F.when(kind == 0, F.concat(literal, comma, "lang", comma, F.lit("extra")))
            .when(kind == 1, F.concat(literal, comma))
            .when(kind == 2, F.concat(F.lit("\"['open\""), comma, "lang"))
            .when(kind == 3, F.concat(F.lit("\"{'a': 1}\""), comma, "lang"))
            .otherwise(F.concat(literal, comma, "lang")))
    path = shared_folder(spark, "damaged")
    write_lines(table.select(line.alias("value")), path)
    rows = token_csv.read_token_csv(spark, path, columns=["reviewText_tokens", "category"],
                                    header=False)
    return (token_csv.rejected_rows(rows).groupBy("reject")
            .agg(F.count(F.lit(1)).alias("rows")))


# Words found in a fifth of the documents or more, as a stop word file.
FREQUENT = f"""WITH {sql.tokens(stop=False)}
SELECT term FROM (SELECT DISTINCT id, term FROM tok) GROUP BY term
HAVING count(*) * 5 >= (SELECT count(*) FROM src)"""


@query("stopword_scan", FREQUENT)
def stopword_scan(spark, folder):
    """A stop word file with stray blanks and repeated lines, made from the most frequent terms."""
    documents = corpora.documents(spark, folder)
    n = documents.agg(F.count(F.lit(1))).scalar()
    frequent = (documents_per_term(documents_per_category_term(with_tokens(documents)))
                .filter(F.col("total_term") * 5 >= n))
    path = shared_folder(spark, "stopwords")
    write_lines(frequent.select(F.explode(F.array(
        F.col("term"), F.concat(F.lit(" "), "term", F.lit("\t")))).alias("value")), path)
    return words.read_words(spark, path)


@query("termlist_scan", f"{sql.chi_top()}\nSELECT DISTINCT term FROM top")
def termlist_scan(spark, folder):
    """The merged vocabulary written one term per line."""
    path = shared_folder(spark, "terms")
    write_terms(merged_vocabulary(scored(spark, folder)), path)
    return words.read_words(spark, path)


@query("vocabulary_scan", f"{sql.chi(variant='legacy')}\nSELECT DISTINCT term FROM scored")
def vocabulary_scan(spark, folder):
    """All scored terms written blank-separated in sorted parts."""
    path = shared_folder(spark, "vocabulary")
    write_terms(merged_vocabulary(scored(spark, folder, variant="legacy"), scope="all"), path,
                one_per_line=False)
    return words.read_vocabulary(spark, path)


@query("report_scan", f"{sql.chi_top(variant='legacy')}\nSELECT DISTINCT term FROM top")
def report_scan(spark, folder):
    """The vocabulary read back from the marked line of a whole report."""
    path, mark = shared_folder(spark, "report"), "vocabulary: "
    write_lines(report_lines(top_terms(scored(spark, folder, variant="legacy")), mark=mark), path)
    return words.read_report_vocabulary(spark, path, mark)


@query("csv_words_roundtrip", f"""SELECT doc_id, lang AS category,
  array_to_string(list_filter({sql.token_list('words')}, lambda t: t <> ''), ' ') AS tokens
FROM documents WHERE lang IS NOT NULL""")
def csv_words_roundtrip(spark, folder):
    """Word tokens, which may hold apostrophes, in single quotes, the header read from the file."""
    documents = with_tokens(corpora.documents(spark, folder), tokenizer="words")
    path = shared_folder(spark, "tokens")
    write_token_csv(documents, path, keep=["doc_id"], single_quotes=True)
    rows = token_csv.valid_rows(token_csv.read_token_csv(spark, path))
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "category",
                       F.array_join("tokens", " ").alias("tokens"))


@query("statistics_roundtrip", f"{sql.chi(tokenizer='regex', variant='mixed')}\n"
                               f"SELECT {', '.join(STATISTICS)} FROM scored")
def statistics_roundtrip(spark, folder):
    """The full statistics as tab-separated text, in ranked order."""
    stats = scored(spark, folder, "mixed", tokenizer="regex").select(*STATISTICS)
    path = shared_folder(spark, "statistics")
    write_statistics(order_by_category(stats), path)
    return spark.read.schema(stats.schema).option("sep", "\t").option("header", True).csv(path)


@query("lines_roundtrip", f"""{sql.chi_top(variant='legacy')}
SELECT category || ' ' || string_agg(term || ':' || printf('%.3f', chi2), ' ' ORDER BY rank) AS line
FROM top GROUP BY category""")
def lines_roundtrip(spark, folder):
    """Category lines as a Snappy-compressed text folder."""
    path = shared_folder(spark, "lines")
    lines = category_lines(top_terms(scored(spark, folder, variant="legacy")))
    write_lines(lines.orderBy("category").select("line"), path, compression="snappy")
    return spark.read.text(path).withColumnRenamed("value", "line")
