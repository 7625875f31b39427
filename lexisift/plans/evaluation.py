"""Quality of a rule-based language guess, by SQL-checkable aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexisift.operators import evaluate as E
from lexisift.plans.registry import query
from lexisift.session import spread
from lexisift.sources.corpus import read_table

# Words that make the guess, in order of precedence.
GUESSES = (("de", " und "), ("fr", " les "), ("es", " los "))

_CASES = " ".join(f"WHEN contains(lower(text), '{word}') THEN '{lang}'" for lang, word in GUESSES)
GUESSED = f"""pred AS (SELECT doc_id, lang AS label, CASE {_CASES} ELSE 'en' END AS prediction
  FROM documents)"""
MATRIX = f"""WITH {GUESSED},
cm AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction)"""
SCORES = f"""{MATRIX},
sup AS (SELECT label, sum(n)::DOUBLE AS support,
               sum(CASE WHEN label = prediction THEN n ELSE 0 END)::DOUBLE AS hits
        FROM cm GROUP BY label),
pre AS (SELECT prediction AS label, sum(n)::DOUBLE AS predicted FROM cm GROUP BY prediction),
pr AS (SELECT label, support,
              CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
              CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall
       FROM sup LEFT JOIN pre USING (label)),
f AS (SELECT *, CASE WHEN precision + recall > 0
                     THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)"""


def guessed(spark, folder):
    text = F.lower("text")
    guess = None
    for lang, word in GUESSES:
        hit = F.contains(text, F.lit(word))
        guess = F.when(hit, lang) if guess is None else guess.when(hit, lang)
    table = spread(read_table(spark, folder, "documents", ["doc_id", "text", "lang"]))
    return table.select("doc_id", F.col("lang").alias("label"),
                        guess.otherwise("en").alias("prediction"))


@query("confusion_rel", f"{MATRIX}\nSELECT label, prediction, n FROM cm")
def confusion(spark, folder):
    return E.confusion_matrix(guessed(spark, folder))


@query("class_scores_rel",
       f"{SCORES}\nSELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, "
       "round(f1, 9) AS f1 FROM f")
def class_scores(spark, folder):
    scores = E.class_scores(E.confusion_matrix(guessed(spark, folder)))
    return scores.select(F.col("class").alias("label"),
                         *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("f1_weighted_rel", f"{SCORES}\nSELECT round(sum(f1 * support) / sum(support), 9) AS f1 FROM f")
def f1_weighted(spark, folder):
    return E.weighted_f1(guessed(spark, folder)).select(F.round("f1", 9).alias("f1"))


@query("accuracy_rel", f"""WITH {GUESSED}
SELECT round(avg((label = prediction)::INTEGER), 9) AS accuracy FROM pred""")
def accuracy(spark, folder):
    return E.accuracy(guessed(spark, folder)).select(F.round("accuracy", 9).alias("accuracy"))
