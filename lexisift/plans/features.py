"""Feature queries: relational forms and the ML stages, checked by the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators import features as X
from lexisift.operators.tokens import term_frequencies, with_tokens
from lexisift.operators.vocabulary import merged_vocabulary, overlap
from lexisift.plans import corpora, sql
from lexisift.plans.ranking import scored
from lexisift.plans.registry import query
from lexisift.plans.sql import chi_top
from lexisift.session import durable

FREQUENCIES = f"""WITH {sql.tokens('ml_regex', min_length=1)},
tf AS (SELECT id AS doc_id, category, term, count(*) AS n FROM tok GROUP BY ALL),
vocab AS (
  SELECT term, count(*) AS df, sum(n)::BIGINT AS cf FROM tf GROUP BY term
  HAVING count(*) >= {K.MIN_DOCUMENT_FREQUENCY} ORDER BY cf DESC, term LIMIT {K.VOCABULARY_SIZE}),
idf AS (
  SELECT term, df, ln(((SELECT count(*) FROM src)::DOUBLE + 1) / (df::DOUBLE + 1)) AS idf
  FROM vocab),
weighted AS (SELECT doc_id, term, n, n * idf AS tfidf FROM tf JOIN idf USING (term))"""
SCALED = f"""{FREQUENCIES},
norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM weighted GROUP BY doc_id)"""

def contingency(value: str, rows: str = "tf JOIN vocab USING (term)") -> str:
    """CTE ``stat(term, statistic, degrees)``: the table of values, zero included, against
    categories, cell by cell; follows ``FREQUENCIES``."""
    return f"""cat AS (SELECT category, count(*)::DOUBLE AS c FROM src GROUP BY category),
nonzero AS (SELECT term, {value} AS v, category, count(*)::DOUBLE AS o FROM {rows} GROUP BY ALL),
zero AS (
  SELECT v.term, 0 AS v, cat.category, cat.c - coalesce(s.o, 0) AS o
  FROM vocab v CROSS JOIN cat
  LEFT JOIN (SELECT term, category, sum(o) AS o FROM nonzero GROUP BY ALL) s
    ON s.term = v.term AND s.category = cat.category),
grid AS (SELECT * FROM nonzero UNION ALL SELECT * FROM zero),
totals AS (SELECT term, v, sum(o) AS r FROM grid GROUP BY term, v HAVING sum(o) > 0),
full_grid AS (
  SELECT t.term, t.v, t.r, cat.c, coalesce(g.o, 0) AS o,
         t.r * cat.c / (SELECT count(*) FROM src) AS e
  FROM totals t CROSS JOIN cat
  LEFT JOIN grid g ON g.term = t.term AND g.v = t.v AND g.category = cat.category),
stat AS (
  SELECT term, round(sum((o - e) * (o - e) / e), 6) AS statistic,
         ((count(DISTINCT v) - 1) * ((SELECT count(*) FROM cat) - 1))::BIGINT AS degrees
  FROM full_grid GROUP BY term)"""


STATISTIC = f"""{FREQUENCIES},
{contingency('n')}
SELECT term, vocab.df, statistic, degrees FROM stat JOIN vocab USING (term)"""

# log Q(a, x) of the chi-square tail: the power series of its complement below a + 1, the
# continued fraction above, each until nothing changes.
P_VALUES = f"""pairs AS (
  SELECT DISTINCT degrees, statistic, degrees / 2.0::DOUBLE AS a, greatest(statistic, 1e-300) / 2::DOUBLE AS x
  FROM stat WHERE degrees > 0),
series AS (
  SELECT degrees, statistic, a, x, 0 AS i, 1 / a AS term, 1 / a AS total FROM pairs WHERE x < a + 1
  UNION ALL
  SELECT degrees, statistic, a, x, i + 1, term * x / (a + i + 1), total + term * x / (a + i + 1)
  FROM series WHERE term > total * 1e-17),
fraction AS (
  SELECT degrees, statistic, a, x, 0 AS i, x + 1 - a AS b, 1e300::DOUBLE AS c, 1 / (x + 1 - a) AS d,
         1 / (x + 1 - a) AS h, 0.0::DOUBLE AS step
  FROM pairs WHERE x >= a + 1
  UNION ALL
  SELECT degrees, statistic, a, x, i, b, c, d, h * c * d, c * d
  FROM (SELECT degrees, statistic, a, x, i + 1 AS i, b + 2 AS b, b + 2 - (i + 1) * (i + 1 - a) / c AS c,
               1 / (b + 2 - (i + 1) * (i + 1 - a) * d) AS d, h, step
        FROM fraction WHERE abs(step - 1) > 1e-15)),
tails AS (
  SELECT degrees, statistic, ln(1 - least(exp(a * ln(x) - x - lgamma(a)) * max(total), 1 - power(2.0::DOUBLE, -53))) AS tail
  FROM series GROUP BY degrees, statistic, a, x
  UNION ALL
  SELECT degrees, statistic, a * ln(x) - x - lgamma(a) + ln(arg_max(h, i)) FROM fraction GROUP BY degrees, statistic, a, x),
ranked AS (
  SELECT term, round(greatest(coalesce(tail, 0), -53 * ln(2.0::DOUBLE)), 9) AS log_p
  FROM stat LEFT JOIN tails USING (degrees, statistic))"""


def selection(selected: int, statistic: str = f"{FREQUENCIES},\n{contingency('n')}") -> str:
    """CTE ``chosen(term)`` and what it needs."""
    return f"""{statistic.replace("WITH ", "WITH RECURSIVE ", 1)},
{P_VALUES},
chosen AS (
  SELECT term FROM ranked JOIN vocab USING (term) ORDER BY log_p, cf DESC, term LIMIT {selected})"""


def frequencies(spark: SparkSession, folder: str) -> DataFrame:
    documents = with_tokens(corpora.documents(spark, folder), tokenizer="ml_regex")
    return term_frequencies(documents, ["doc_id", "category"], min_length=1,
                            stop_words=corpora.STOP_WORDS())


def shared_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    """Term rows that several branches of a plan read, so that the text is tokenized once."""
    return durable(frequencies(spark, folder), "frequencies")


def _idf(spark, folder, rows):
    return X.idf_table(X.vocabulary_table(rows), corpora.documents(spark, folder))


@query("tf_rel", f"{FREQUENCIES}\nSELECT doc_id, term, n FROM tf")
def tf_rel(spark, folder):
    return frequencies(spark, folder).select("doc_id", "term", "n")


@query("vocabulary_rel", f"{FREQUENCIES}\nSELECT term, df, cf FROM vocab")
def vocabulary_rel(spark, folder):
    return X.vocabulary_table(frequencies(spark, folder))


@query("idf_rel", f"{FREQUENCIES}\nSELECT term, df, round(idf, 9) AS idf FROM idf")
def idf_rel(spark, folder):
    return (_idf(spark, folder, frequencies(spark, folder))
            .withColumn("idf", F.round("idf", 9)))


@query("tfidf_rel", f"{FREQUENCIES}\nSELECT doc_id, term, n, round(tfidf, 6) AS tfidf FROM weighted")
def tfidf_rel(spark, folder):
    rows = shared_frequencies(spark, folder)
    return (X.tfidf_table(rows, _idf(spark, folder, rows))
            .select("doc_id", "term", "n", F.round("tfidf", 6).alias("tfidf")))


@query("label_index_rel", """SELECT lang AS category, count(*) AS documents,
  (row_number() OVER (ORDER BY count(*) DESC, lang) - 1)::DOUBLE AS label
FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def label_index_rel(spark, folder):
    return X.label_index_table(corpora.documents(spark, folder))


def term_statistics(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The vocabulary, and the statistic of each of its terms."""
    rows = shared_frequencies(spark, folder)
    vocabulary = durable(X.vocabulary_table(rows), "vocabulary")
    kept = rows.join(vocabulary.select("term"), "term", "left_semi")
    return vocabulary, X.feature_statistics(kept, corpora.documents(spark, folder))


@query("chi2_feature_stat_rel", STATISTIC)
def feature_statistic(spark, folder):
    _, statistics = term_statistics(spark, folder)
    return statistics.withColumn("statistic", F.round("statistic", 6))


@query("select_rel", f"{selection(K.SELECTED_FEATURES)}\nSELECT term, log_p FROM chosen JOIN ranked USING (term)")
def select_rel(spark, folder):
    """The terms with the smallest p-values, without vectors."""
    vocabulary, statistics = term_statistics(spark, folder)
    return X.best_terms(statistics, vocabulary)


# Documents without text have no vector, so they are no rows of the stages below.
WITH_TEXT = sql.DOCUMENTS.replace("WHERE lang IS NOT NULL", "WHERE lang IS NOT NULL AND text IS NOT NULL")
COUNTED = X.FeatureSpec(selected=None)


def fitted(spark: SparkSession, folder: str, spec: X.FeatureSpec = X.FeatureSpec()) -> X.Features:
    """The stages fitted on all documents of a folder, anew for every query."""
    return X.fit_features(corpora.documents(spark, folder, null_text="drop"), spec, keep=["doc_id"])


@query("ml_tfidf_vocab", f"""{FREQUENCIES}
SELECT term, (row_number() OVER (ORDER BY cf DESC, term) - 1)::INTEGER AS feature_index FROM vocab""")
def ml_vocabulary(spark, folder):
    return X.vocabulary_frame(fitted(spark, folder, COUNTED))


@query("ml_tf", f"{FREQUENCIES}\nSELECT doc_id, term, n::DOUBLE AS n FROM tf JOIN vocab USING (term)")
def ml_term_counts(spark, folder):
    return (X.vector_terms(fitted(spark, folder, COUNTED), "tf", ["doc_id"])
            .withColumnRenamed("weight", "n"))


DEFAULTS = X.FeatureSpec(tokenizer="whitespace", vocabulary_size=K.DEFAULT_VOCABULARY_SIZE,
                         min_df=K.DEFAULT_DOCUMENT_FREQUENCY, selected=None)


@query("ml_tf_defaults", f"""WITH {sql.tokens('whitespace', min_length=0)},
tf AS (SELECT id AS doc_id, term, count(*) AS n FROM tok GROUP BY ALL),
vocab AS (SELECT term, sum(n) AS cf FROM tf GROUP BY term ORDER BY cf DESC, term LIMIT {K.DEFAULT_VOCABULARY_SIZE})
SELECT doc_id, term, n::DOUBLE AS n FROM tf JOIN vocab USING (term)""".replace(sql.DOCUMENTS, WITH_TEXT))
def ml_term_counts_with_defaults(spark, folder):
    """Spark's plain tokenizer and the vectorizer's defaults: 2^18 terms, one document."""
    return (X.vector_terms(fitted(spark, folder, DEFAULTS), "tf", ["doc_id"])
            .withColumnRenamed("weight", "n"))


@query("ml_tfidf", f"{FREQUENCIES}\nSELECT doc_id, term, round(tfidf, 6) AS tfidf FROM weighted")
def ml_tfidf(spark, folder):
    return (X.vector_terms(fitted(spark, folder, COUNTED), "tfidf", ["doc_id"])
            .select("doc_id", "term", F.round("weight", 6).alias("tfidf")))


@query("ml_label_index", """SELECT lang AS category, (row_number() OVER (
    ORDER BY count(*) DESC, lang) - 1)::DOUBLE AS label
FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang""")
def ml_label_index(spark, folder):
    return fitted(spark, folder, COUNTED).frame.select("category", "label").distinct()


SCALED_ONLY = X.FeatureSpec(normalize="before", selected=None)


@query("l2_norm_rel", f"""{SCALED}
SELECT doc_id, term, round(tfidf / norm, 9) AS weight FROM weighted JOIN norms USING (doc_id)""")
def l2_norm(spark, folder):
    """Normalized TF-IDF vectors, scaled inside each document's row."""
    return (X.vector_terms(fitted(spark, folder, SCALED_ONLY), "scaled", ["doc_id"])
            .select("doc_id", "term", F.round("weight", 9).alias("weight")))


def selected_sql(selected: int) -> str:
    return f"{selection(selected)}\nSELECT term FROM chosen".replace(sql.DOCUMENTS, WITH_TEXT)


@query("ml_select_2000", selected_sql(K.SELECTED_FEATURES))
def select_light(spark, folder):
    return X.selected_terms(fitted(spark, folder)).select("term")


HEAVY = X.FeatureSpec(selected=K.SELECTED_FEATURES_HEAVY)


@query("ml_select_500", selected_sql(K.SELECTED_FEATURES_HEAVY))
def select_heavy(spark, folder):
    return X.selected_terms(fitted(spark, folder, HEAVY)).select("term")


BEFORE = X.FeatureSpec(normalize="before")
SCALED_STATISTIC = f"""{SCALED},
scaled AS (
  SELECT doc_id, term, category, round(tfidf / norm, 12) AS scaled
  FROM weighted JOIN norms USING (doc_id) JOIN (SELECT id AS doc_id, category FROM src) USING (doc_id)),
{contingency('scaled', 'scaled WHERE scaled <> 0')}"""


@query("ml_norm_before_select", f"""{selection(K.SELECTED_FEATURES, SCALED_STATISTIC)}
SELECT term FROM chosen""".replace(sql.DOCUMENTS, WITH_TEXT))
def select_after_norm(spark, folder):
    """Every distinct normalized weight is a value of its own; there is no limit on them."""
    return X.selected_terms(fitted(spark, folder, BEFORE)).select("term")


OVERLAP = f"""{selection(K.SELECTED_FEATURES).replace(sql.DOCUMENTS, WITH_TEXT)},
merged AS (SELECT DISTINCT term FROM ({chi_top()} SELECT term FROM top)),
counts AS (
  SELECT (SELECT count(*) FROM merged JOIN chosen USING (term)) AS common,
         (SELECT count(*) FROM merged ANTI JOIN chosen USING (term)) AS only_left,
         (SELECT count(*) FROM chosen ANTI JOIN merged USING (term)) AS only_right)
SELECT *, round(common / (common + only_right)::DOUBLE * 100, 2) AS overlap_pct FROM counts"""


@query("ml_terms_overlap", OVERLAP)
def overlap_with_ranking(spark, folder):
    """The ranked vocabulary against the terms the selector chose."""
    return overlap(merged_vocabulary(scored(spark, folder)), X.selected_terms(fitted(spark, folder)))
