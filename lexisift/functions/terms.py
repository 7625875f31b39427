"""Operations on token arrays and on the columns that hold them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexisift.functions import constants as K


def strip(word: Column) -> Column:
    """Without whitespace of any kind at both ends."""
    return F.btrim(word, F.lit(K.STRIPPED))


def keep_terms(tokens: Column, stop_words: Iterable[str] = (),
               min_length: int = K.MIN_TERM_LENGTH) -> Column:
    """Drop short tokens and stop words, keep order and repetitions."""
    words = sorted(set(stop_words))
    kept = F.filter(tokens, lambda token: F.length(token) >= min_length)
    if words:
        kept = F.filter(kept, lambda token: ~token.isin(words))
    return kept


def clean_tokens(tokens: Column) -> Column:
    """Trim and lower ready-made tokens, drop nulls and empty ones."""
    cleaned = F.transform(tokens, lambda token: F.lower(strip(token)))
    return F.coalesce(F.filter(cleaned, lambda token: token != ""),
                      F.array().cast("array<string>"))


# An element that does not start with a quote.
_UNQUOTED_ELEMENT = r"""[\[,]\s*[^\s'"\]]"""
_JSON_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true"}


def parse_list_literal(literal: Column) -> Column:
    """``['a', "it's"]`` -> array; null when it is no list, non-strings dropped.

    Elements are typed one by one only where the text may hold something unquoted;
    all other lists take the faster string parser.
    """
    typed = F.filter(F.from_json(literal, "array<variant>", _JSON_OPTIONS),
                     lambda item: F.schema_of_variant(item) == "STRING")
    return (F.when(literal.rlike(_UNQUOTED_ELEMENT),
                   F.transform(typed, lambda item: F.variant_get(item, "$", "string")))
            .otherwise(F.from_json(literal, "array<string>", _JSON_OPTIONS)))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, n>>`` of one document, without leaving its row.

    The tokens are sorted and run lengths read off the positions where the value
    changes, so counting repeated terms per document needs no shuffle.
    """
    def run_lengths(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, F.greatest(i - 2, F.lit(0)))))

        def counted(first: Column) -> Column:
            return F.transform(first, lambda start, k: F.struct(
                F.get(ordered, start - 1).alias("term"),
                (F.coalesce(F.get(first, k + 1), size + 1) - start).cast("bigint").alias("n")))

        return bind(starts, counted)

    return bind(F.sort_array(tokens), run_lengths)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
