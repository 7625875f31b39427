"""Merged vocabularies and their comparison."""

from __future__ import annotations

from lexisift.operators import vocabulary as V
from lexisift.plans import sql
from lexisift.plans.ranking import scored
from lexisift.plans.registry import query
from lexisift.sinks.reports import vocabulary_line

MERGED = "SELECT DISTINCT term FROM top"


def _pair(body: str) -> str:
    """Both vocabularies as ``l`` and ``r``: standard and legacy scores."""
    left = sql.chi_top()
    right = ",\n".join([sql.scores("legacy"), sql.TOP])
    for name in ("abcd", "dens", "scored", "top"):
        right = right.replace(f"{name} AS", f"{name}2 AS").replace(f"FROM {name}", f"FROM {name}2")
    return (f"{left},\n{right},\nl AS ({MERGED}), r AS ({MERGED.replace('top', 'top2')})\n{body}")


def _vocabularies(spark, folder):
    return (V.merged_vocabulary(scored(spark, folder)),
            V.merged_vocabulary(scored(spark, folder, variant="legacy")))


@query("merged_vocab_topk", f"{sql.chi_top()}\n{MERGED}")
def merged_topk(spark, folder):
    return V.merged_vocabulary(scored(spark, folder))


@query("merged_vocab_all", f"{sql.chi(variant='legacy')}\nSELECT DISTINCT term FROM scored")
def merged_all(spark, folder):
    return V.merged_vocabulary(scored(spark, folder, variant="legacy"), scope="all")


@query("vocab_line", f"""{sql.chi_top()}
SELECT string_agg(term, ' ' ORDER BY term) AS line FROM ({MERGED})""")
def line(spark, folder):
    return vocabulary_line(V.merged_vocabulary(scored(spark, folder)))


@query("terms_common", _pair("SELECT term FROM l INTERSECT SELECT term FROM r"))
def common(spark, folder):
    return V.common_terms(*_vocabularies(spark, folder))


@query("terms_only_left", _pair("SELECT term FROM l EXCEPT SELECT term FROM r"))
def only_left(spark, folder):
    return V.terms_only_in_first(*_vocabularies(spark, folder))


@query("terms_only_right", _pair("SELECT term FROM r EXCEPT SELECT term FROM l"))
def only_right(spark, folder):
    left, right = _vocabularies(spark, folder)
    return V.terms_only_in_first(right, left)


@query("terms_overlap_pct", _pair("""SELECT common, only_left, only_right,
  round(common::DOUBLE / (common + only_right) * 100, 2) AS overlap_pct
FROM (SELECT count(*) FILTER (l.term IS NOT NULL AND r.term IS NOT NULL) AS common,
             count(*) FILTER (r.term IS NULL) AS only_left,
             count(*) FILTER (l.term IS NULL) AS only_right
      FROM l FULL JOIN r ON l.term = r.term)"""))
def overlap(spark, folder):
    return V.overlap(*_vocabularies(spark, folder))
