"""Tokenizer queries: ``(doc_id, term, n)`` of every document."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from lexisift.functions.terms import clean_tokens, parse_list_literal
from lexisift.operators.features import FeatureSpec, stop_word_stage, tokenizer_stage
from lexisift.operators.tokens import (term_frequencies, token_lists, with_column_tokens,
                                       with_tokens)
from lexisift.plans import corpora, sql
from lexisift.plans.registry import query
from lexisift.session import spread
from lexisift.sinks.tables import list_literal
from lexisift.sources.corpus import read_table

PER_DOCUMENT = "SELECT id AS doc_id, term, count(*) AS n FROM tok GROUP BY id, term"


def _register(tokenizer, name=None, stop=True, min_length=2):
    @query(name or f"tok_{tokenizer}",
           f"WITH {sql.tokens(tokenizer, stop=stop, min_length=min_length)}\n{PER_DOCUMENT}")
    def run(spark, folder):
        documents = with_tokens(corpora.documents(spark, folder), tokenizer=tokenizer)
        return term_frequencies(documents, ["doc_id"], min_length=min_length,
                                stop_words=corpora.STOP_WORDS() if stop else None)


_register("translate")
_register("translate_no_dollar", stop=False)
_register("regex")
_register("words")
_register("words", "tok_words_unfiltered", stop=False, min_length=1)
_register("replace_split")
_register("ml_regex", stop=False, min_length=1)
_register("ml_regex_literal", stop=False, min_length=1)
_register("whitespace", stop=False, min_length=0)


def _stage_terms(spark, folder, spec, keep_empty=False):
    stages = Pipeline(stages=[tokenizer_stage(spec), stop_word_stage(spec)])
    documents = corpora.documents(spark, folder, null_text="drop")
    tokens = stages.fit(documents).transform(documents)
    return term_frequencies(tokens, ["doc_id"], "clean_tokens", min_length=0 if keep_empty else 1)


@query("tok_stop_default", f"WITH {sql.tokens('ml_regex', min_length=1)}\n{PER_DOCUMENT}")
def stop_default(spark, folder):
    """The ML stages: regex tokenizer and the built-in stop words."""
    return _stage_terms(spark, folder, FeatureSpec())


@query("tok_stop_default_whitespace",
       f"WITH {sql.tokens('whitespace', min_length=0)}\n{PER_DOCUMENT}")
def stop_default_whitespace(spark, folder):
    """The ML stages: whitespace tokenizer and the built-in stop words."""
    return _stage_terms(spark, folder, FeatureSpec(tokenizer="whitespace"), keep_empty=True)


# A short list of its own for the custom stop word query.
CUSTOM_STOP_WORDS = ("The", "and", "der", "les", "los", "than")


@query("tok_stop_custom", f"""WITH {sql.tokens('ml_regex_literal', stop=False, min_length=1)}
SELECT id AS doc_id, term, count(*) AS n FROM tok
WHERE term NOT IN ({', '.join(sql.quoted(w.lower()) for w in CUSTOM_STOP_WORDS)})
GROUP BY id, term""")
def stop_custom(spark, folder):
    """The ML stage with an own list, compared without regard to case."""
    return _stage_terms(spark, folder, FeatureSpec(tokenizer="ml_regex_literal",
                                                   stop_words=CUSTOM_STOP_WORDS))


@query("tok_stop_frequent", f"""WITH {sql.tokens(stop=False)},
frequent AS (SELECT term FROM (SELECT DISTINCT id, term FROM tok) GROUP BY term
             HAVING count(*) * 5 >= (SELECT count(*) FROM src))
SELECT id AS doc_id, term, count(*) AS n FROM tok
WHERE term NOT IN (SELECT term FROM frequent) GROUP BY id, term""")
def stop_frequent(spark, folder):
    """A stop word frame made from the data."""
    documents = with_tokens(corpora.documents(spark, folder))
    n = documents.agg(F.count(F.lit(1))).scalar()
    frequent = (documents.select(F.explode(F.array_distinct("tokens")).alias("term"))
                .filter(F.length("term") >= 2).groupBy("term")
                .agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") * 5 >= n))
    return term_frequencies(documents, ["doc_id"], stop_words=frequent)


@query("tok_normalise", """WITH raw AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, ' ')) AS word FROM documents),
tok AS (SELECT doc_id, lower(trim(word, E'\\t\\n\\x0b\\f\\r ')) AS term FROM raw)
SELECT doc_id, term, count(*) AS n FROM tok WHERE term <> '' GROUP BY doc_id, term""")
def normalise(spark, folder):
    """Ready-made tokens stored as a list literal: parsed, trimmed, lowered."""
    stored = (spread(read_table(spark, folder, "documents", ["doc_id", "text"]))
              .select("doc_id", list_literal(F.split("text", " ")).alias("literal")))
    cleaned = stored.select("doc_id", clean_tokens(parse_list_literal(F.col("literal"))).alias("tokens"))
    return term_frequencies(cleaned, ["doc_id"], min_length=1)


@query("column_guard", f"""SELECT doc_id,
  array_to_string(list_filter({sql.token_list('regex')}, lambda t: t <> ''), ' ') AS text_tokens,
  array_to_string(list_filter({sql.token_list('regex', 'source')}, lambda t: t <> ''), ' ') AS source_tokens,
  'summary' AS missing
FROM documents""")
def column_guard(spark, folder):
    """Token columns for the text columns that exist; the others are named."""
    table = spread(read_table(spark, folder, "documents", ["doc_id", "text", "source"]))
    tokens, missing = with_column_tokens(table, ["text", "source", "summary"])
    return tokens.select("doc_id", F.array_join("text_tokens", " ").alias("text_tokens"),
                         F.array_join("source_tokens", " ").alias("source_tokens"),
                         F.lit(",".join(missing)).alias("missing"))


@query("tok_lists", f"""SELECT doc_id, array_to_string(list_filter(
    {sql.token_list('regex')},
    lambda t: length(t) > 1 AND t NOT IN ({sql.stop_list()})), ' ') AS tokens
FROM documents WHERE lang IS NOT NULL""")
def filtered_lists(spark, folder):
    """Ordered token lists with repetitions, filtered."""
    documents = with_tokens(corpora.documents(spark, folder), tokenizer="regex")
    lists = token_lists(documents, ["doc_id"], stop_words=corpora.STOP_WORDS())
    return lists.withColumn("tokens", F.array_join("tokens", " "))
