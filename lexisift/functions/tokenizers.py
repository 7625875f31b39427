"""Text column -> ``array<string>`` column.

Every tokenizer lower-cases, treats null text as an empty document and keeps
repeated tokens. All of them are built-in expressions, so they run inside the
scan stage without Python workers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexisift.functions import constants as K

Tokenizer = Callable[[Column], Column]


def _split(text: Column, pattern: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), pattern), "")


def translate_tokens(text: Column, dollar: bool = True) -> Column:
    """Delimiters and 0-9 become blanks, then split on Unicode whitespace."""
    return _split(text, K.TRANSLATE_PATTERN if dollar else K.TRANSLATE_PATTERN_WITHOUT_DOLLAR)


def regex_tokens(text: Column) -> Column:
    """Split on runs of Unicode whitespace, Unicode digits and delimiters."""
    return _split(text, K.REGEX_PATTERN)


def word_tokens(text: Column) -> Column:
    """Words with inner apostrophes and hyphens, bounded by word characters.

    A maximal run of word characters, apostrophes and single hyphens is taken and
    then trimmed to its first and last word character, which is what a match
    between two word boundaries gives.
    """
    runs = F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(K.WORD_RUN_PATTERN), F.lit(0))
    return F.array_remove(F.transform(runs, lambda run: F.btrim(run, F.lit("-'"))), "")


def replace_split_tokens(text: Column) -> Column:
    """Delimiter runs (without the dollar sign) become a blank, then split on whitespace."""
    blanked = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), K.REPLACE_PATTERN, " ")
    return F.array_remove(F.split(blanked, char_run(K.JAVA_WHITESPACE)), "")


def ml_regex_tokens(text: Column, newline_splits: bool = True) -> Column:
    """Same result as the ML regex tokenizer stage; the literal pattern has no newline."""
    return _split(text, K.ML_PATTERN if newline_splits else K.ML_PATTERN_LITERAL)


def whitespace_tokens(text: Column) -> Column:
    """Same result as the ML whitespace tokenizer: inner empty tokens stay, trailing ones go."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    blank = char_run(K.JAVA_WHITESPACE)
    return (F.when(lowered.rlike(f"^{blank}$"), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(lowered, f"{blank}$", ""),
                               K.char_class(K.JAVA_WHITESPACE))))


def char_run(characters: str) -> str:
    return K.char_class(characters) + "+"


TOKENIZERS: dict[str, Tokenizer] = {
    "translate": translate_tokens,
    "translate_no_dollar": lambda text: translate_tokens(text, dollar=False),
    "regex": regex_tokens,
    "words": word_tokens,
    "replace_split": replace_split_tokens,
    "ml_regex": ml_regex_tokens,
    "ml_regex_literal": lambda text: ml_regex_tokens(text, newline_splits=False),
    "whitespace": whitespace_tokens,
}
