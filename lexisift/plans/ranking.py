"""Top-K terms and report lines."""

from __future__ import annotations

from lexisift.operators.chi_square import STATISTICS, text_statistics
from lexisift.operators.ranking import order_by_category, ranked_lists, top_terms
from lexisift.plans import corpora, sql
from lexisift.plans.registry import query
from lexisift.sinks.reports import category_lines, preview, report_lines
from pyspark.sql import functions as F

RANKED = "SELECT category, rank, term, chi2 FROM top"


def scored(spark, folder, variant="standard", zero="skip", tokenizer="translate", category="lang"):
    return text_statistics(corpora.documents(spark, folder, category), tokenizer,
                           corpora.STOP_WORDS(), variant=variant, zero=zero)


def _lines(number: str, name: str = "category") -> str:
    return f"""SELECT category, {name} || ' ' || string_agg(term || ':' || {number}, ' ' ORDER BY rank) AS line
FROM top GROUP BY category"""


FIXED = "printf('%.3f', chi2)"
# Up to three decimals, at least one.
ROUNDED = "regexp_replace(printf('%.3f', chi2), '(\\.\\d)(\\d*?)0+$', '\\1\\2')"
UNROUNDED = "chi2::VARCHAR"


@query("top75_standard", f"{sql.chi_top()}\n{RANKED}")
def top75_standard(spark, folder):
    return top_terms(scored(spark, folder))


@query("top75_legacy", f"{sql.chi_top(variant='legacy')}\n{RANKED}")
def top75_legacy(spark, folder):
    return top_terms(scored(spark, folder, variant="legacy"))


@query("top75_by_source", f"{sql.chi_top(source=sql.DOCUMENTS_BY_SOURCE)}\n{RANKED}")
def top75_by_source(spark, folder):
    return top_terms(scored(spark, folder, category="source"))


@query("ranked_lists", f"""{sql.chi_top()}
SELECT category, count(*) AS terms, string_agg(term, ' ' ORDER BY rank) AS ranked FROM top GROUP BY category""")
def lists(spark, folder):
    """The ranking as one array per category."""
    return ranked_lists(top_terms(scored(spark, folder))).select(
        "category", F.size("terms").cast("bigint").alias("terms"),
        F.array_join(F.col("terms.term"), " ").alias("ranked"))


@query("category_lines", f"{sql.chi_top(variant='legacy')}\n{_lines(FIXED)}")
def lines_fixed(spark, folder):
    return category_lines(top_terms(scored(spark, folder, variant="legacy")))


@query("category_lines_rounded",
       f"{sql.chi_top(tokenizer='regex', variant='mixed')}\n{_lines(ROUNDED)}")
def lines_rounded(spark, folder):
    return category_lines(top_terms(scored(spark, folder, "mixed", tokenizer="regex")), "rounded")


@query("category_lines_bracket",
       sql.chi_top(tokenizer="replace_split", zero="zero") + "\n"
       + _lines(UNROUNDED, "'<' || category || '>'"))
def lines_bracket(spark, folder):
    top = top_terms(scored(spark, folder, zero="zero", tokenizer="replace_split"))
    return category_lines(top, "unrounded", brackets=True)


@query("report_lines", f"""{sql.chi_top(source=sql.TITLED, variant='legacy', tokenizer='translate_no_dollar')},
lines AS ({_lines(FIXED)})
SELECT line FROM lines
UNION ALL SELECT string_agg(term, ' ' ORDER BY term) FROM (SELECT DISTINCT term FROM top)""")
def report(spark, folder):
    """The whole report: composed text, a line per category, then the merged vocabulary."""
    stats = text_statistics(corpora.titled_documents(spark, folder), "translate_no_dollar",
                            corpora.STOP_WORDS(), variant="legacy")
    return report_lines(top_terms(stats))


@query("report_lines_bracket", sql.chi_top(tokenizer="replace_split", zero="zero") + f""",
lines AS ({_lines(UNROUNDED, "'<' || category || '>'")})
SELECT line FROM lines
UNION ALL SELECT string_agg(term, ' ' ORDER BY term) FROM (SELECT DISTINCT term FROM top)""")
def bracket_report(spark, folder):
    """Bracketed lines in alphabetical order, then the merged vocabulary line."""
    top = top_terms(scored(spark, folder, zero="zero", tokenizer="replace_split"))
    return report_lines(top, "unrounded", brackets=True)


@query("stats_ordered",
       f"{sql.chi(tokenizer='regex', variant='mixed')}\n"
       f"SELECT {', '.join(STATISTICS)} FROM scored ORDER BY category, chi2 DESC, term")
def ordered(spark, folder):
    return order_by_category(scored(spark, folder, "mixed", tokenizer="regex")).select(*STATISTICS)


@query("preview", f"""{sql.chi()}
SELECT category, term, chi2 FROM scored ORDER BY category, chi2 DESC, term LIMIT 10""")
def first_rows(spark, folder):
    """The preview of ten rows that the console report shows."""
    return preview(order_by_category(scored(spark, folder)).select("category", "term", "chi2"))


