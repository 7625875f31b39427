"""Pieces of the SQL equivalents."""

from __future__ import annotations

from lexisift.functions import constants as K
from lexisift.plans.corpora import STOP_WORDS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def stop_list() -> str:
    return ", ".join(quoted(word) for word in STOP_WORDS())


def split_list(text: str, pattern: str) -> str:
    return f"regexp_split_to_array(lower({text}), {quoted(pattern)})"


_WORD = f"[{K.WORD_CHARACTERS}]"
# Separators between two word characters of one token: apostrophes and single hyphens.
WORD_SQL_PATTERN = _WORD + "(?:-?(?:'+-)*'*" + _WORD + ")*"

SPLIT_PATTERNS = {
    "translate": K.TRANSLATE_PATTERN,
    "translate_no_dollar": K.TRANSLATE_PATTERN_WITHOUT_DOLLAR,
    "regex": K.REGEX_PATTERN,
    "ml_regex": K.ML_PATTERN,
    "ml_regex_literal": K.ML_PATTERN_LITERAL,
}


def token_list(tokenizer: str, text: str = "text") -> str:
    """SQL list of raw tokens; splits may leave empty strings at the ends."""
    if tokenizer == "words":
        return f"regexp_extract_all(lower({text}), {quoted(WORD_SQL_PATTERN)})"
    if tokenizer == "replace_split":
        blanked = f"regexp_replace(lower({text}), {quoted(K.REPLACE_PATTERN)}, ' ', 'g')"
        return f"regexp_split_to_array({blanked}, {quoted(f'[{K.JAVA_WHITESPACE}]+')})"
    if tokenizer == "whitespace":
        trimmed = f"regexp_replace(lower({text}), {quoted(f'[{K.JAVA_WHITESPACE}]+$')}, '')"
        return f"regexp_split_to_array({trimmed}, {quoted(f'[{K.JAVA_WHITESPACE}]')})"
    return split_list(text, SPLIT_PATTERNS[tokenizer])


DOCUMENTS = """src AS (
  SELECT doc_id AS id, coalesce(text, '') AS text, lang AS category
  FROM documents WHERE lang IS NOT NULL)"""
DOCUMENTS_BY_SOURCE = DOCUMENTS.replace("lang", "source")
TITLED = """src AS (
  SELECT doc_id AS id, coalesce(text, '') || ' ' || coalesce(source, '') AS text, lang AS category
  FROM documents WHERE lang IS NOT NULL)"""
TURNS = """src AS (
  SELECT conv_id::VARCHAR || ':' || turn::VARCHAR AS id, coalesce(text, '') AS text, role AS category
  FROM conversations WHERE role IS NOT NULL)"""
RATED = """src AS (
  SELECT doc_id AS id, coalesce(text, '') AS text, quality::VARCHAR AS category
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"""


def tokens(tokenizer: str = "translate", source: str = DOCUMENTS, stop: bool = True,
           min_length: int = K.MIN_TERM_LENGTH) -> str:
    """CTEs ``src`` and ``tok(id, category, term)`` with repetitions."""
    stop_filter = f" AND term NOT IN ({stop_list()})" if stop else ""
    return f"""{source},
raw AS (SELECT id, category, unnest({token_list(tokenizer)}) AS term FROM src),
tok AS (SELECT id, category, term FROM raw WHERE length(term) >= {min_length}{stop_filter})"""


COUNTS = """obs AS (
  SELECT category, term, count(*) AS observed
  FROM (SELECT DISTINCT id, category, term FROM tok) GROUP BY category, term),
tt AS (SELECT term, sum(observed)::BIGINT AS total_term FROM obs GROUP BY term),
cc AS (SELECT category, count(*) AS total_category FROM src GROUP BY category),
cells AS (
  SELECT term, category, observed, total_term, total_category,
         observed::DOUBLE AS a, total_term::DOUBLE AS t, total_category::DOUBLE AS cc,
         (SELECT count(*) FROM src)::DOUBLE AS n
  FROM obs JOIN tt USING (term) JOIN cc USING (category))"""

_C_AND_D = {"standard": ("cc - a", "n - cc - (t - a)"),
            "legacy": ("cc", "n - cc - (t - a) - a"),
            "mixed": ("cc", "n - cc - (t - a)")}


def scores(variant: str = "standard", zero: str = "skip", deviant: bool = False) -> str:
    """CTE ``scored`` with the full statistics record; follows ``COUNTS``."""
    c, d = _C_AND_D[variant]
    expected = "t * (cc - a) / n" if deviant else "t * (cc / n)"
    value = "n * ((a * d - b * c) * (a * d - b * c)) / den"
    chosen = (f"SELECT *, {value} AS chi2 FROM dens WHERE den <> 0" if zero == "skip" else
              f"SELECT *, CASE WHEN den = 0 THEN 0.0::DOUBLE ELSE {value} END AS chi2 FROM dens")
    return f"""abcd AS (
  SELECT *, t - a AS b, {c} AS c, {d} AS d, {expected} AS expected FROM cells),
dens AS (SELECT *, (a + b) * (a + c) * (b + d) * (c + d) AS den FROM abcd),
scored AS (
  SELECT term, category, observed, expected, chi2, total_term, total_category
  FROM ({chosen}))"""


def chi(tokenizer: str = "translate", source: str = DOCUMENTS, variant: str = "standard",
        zero: str = "skip", deviant: bool = False, stop: bool = True) -> str:
    """``WITH`` clause up to ``scored``."""
    return "WITH " + ",\n".join([tokens(tokenizer, source, stop), COUNTS,
                                 scores(variant, zero, deviant)])


TOP = f"""top AS (
  SELECT category, rank, term, chi2 FROM (
    SELECT category, term, chi2,
           (row_number() OVER (PARTITION BY category ORDER BY chi2 DESC, term))::INTEGER AS rank
    FROM scored) WHERE rank <= {K.TOP_K})"""


def chi_top(**options) -> str:
    """``WITH`` clause up to ``top``."""
    return chi(**options) + ",\n" + TOP
