"""Document frequency queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.operators import counts
from lexisift.operators.tokens import term_frequencies, with_tokens
from lexisift.plans import corpora, sql
from lexisift.plans.registry import query
from lexisift.sources.corpus import labelled_documents, read_table

COUNTED = f"WITH {sql.tokens()},\n{sql.COUNTS}"


def _observed(spark, folder):
    return counts.documents_per_category_term(
        with_tokens(corpora.documents(spark, folder)), stop_words=corpora.STOP_WORDS())


@query("doc_count_by_category",
       "SELECT lang AS category, count(*) AS documents FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def doc_count_by_category(spark, folder):
    table = read_table(spark, folder, "documents", ["text", "lang"])
    return counts.documents_per_category(labelled_documents(table, "text", "lang"))


@query("doc_count_empty_category", """SELECT coalesce(quality::VARCHAR, '') AS category,
  count(*) AS documents FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def doc_count_empty_category(spark, folder):
    """A missing category counts under the empty name."""
    table = (read_table(spark, folder, "documents", ["doc_id", "text"])
             .join(read_table(spark, folder, "labels", ["doc_id", "quality"]), "doc_id", "left"))
    return counts.documents_per_category(
        labelled_documents(table, "text", "quality", null_category="empty"))


@query("total_docs", "SELECT count(*) AS documents FROM documents")
def total_docs(spark, folder):
    return counts.total_documents(read_table(spark, folder, "documents", ["lang"]))


@query("df_by_category_term", f"{COUNTED}\nSELECT category, term, observed FROM obs")
def df_by_category_term(spark, folder):
    return _observed(spark, folder)


@query("df_by_term", f"{COUNTED}\nSELECT term, total_term FROM tt")
def df_by_term(spark, folder):
    return counts.documents_per_term(_observed(spark, folder))


@query("df_grouping_sets", f"""{COUNTED}
SELECT category, term, observed AS documents, 0 AS all_categories FROM obs
UNION ALL SELECT NULL, term, total_term, 1 FROM tt""")
def df_grouping_sets(spark, folder):
    return counts.count_levels(_observed(spark, folder))


@query("occurrences_by_category_term", f"""WITH {sql.tokens()}
SELECT category, term, count(*) AS n FROM tok GROUP BY category, term""")
def occurrences(spark, folder):
    """Ready-made counts per document summed per key."""
    per_document = term_frequencies(with_tokens(corpora.documents(spark, folder)), ["category"],
                                    stop_words=corpora.STOP_WORDS())
    return counts.sum_counts(per_document, ["category", "term"])


@query("label_counts", "SELECT quality AS label, count(*) AS rows FROM labels GROUP BY quality")
def label_counts(spark, folder):
    table = read_table(spark, folder, "labels", ["quality"]).withColumnRenamed("quality", "label")
    return counts.rows_per_label(table)


@query("tokens_grouped", f"""WITH {sql.tokens(stop=False, min_length=1)}
SELECT id AS doc_id, string_agg(term, ' ' ORDER BY term) AS terms
FROM (SELECT DISTINCT id, term FROM tok) GROUP BY id""")
def tokens_grouped(spark, folder):
    """The distinct terms of each document."""
    documents = counts.terms_of_documents(with_tokens(corpora.documents(spark, folder)))
    return (documents.filter(F.size("terms") > 0)
            .select("doc_id", F.array_join("terms", " ").alias("terms")))
