"""The text stages of the feature pipeline, on whole Arrow columns.

Spark's tokenizer, stop word remover and count vectorizer make a Java string of every token.
Here texts are split, filtered and counted as byte and number arrays, a batch at a time, to the
same counts; the stages stay what pipelines and fitted models hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer, StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.functions import constants as K

# Bytes of text, bytes of joined terms and tokens that are worked on at once; a longer row
# is one piece. Text is cut finer, as a short dictionary of tokens stays in the processor's cache.
TEXT_BYTES = 1 << 20
TERM_BYTES = 1 << 22
TOKENS = 1 << 21
SIGMA = "\u03a3"


def _pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so much together, or of one row."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield begin, end
        begin = end


def _split(text: pa.Array, delimiters: str) -> pa.ListArray:
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    _, offsets, data = text.buffers()
    at = np.frombuffer(offsets, wide)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    single = np.ones(256, bool)
    single[[ord(c) for c in delimiters if ord(c) < 128]] = False
    inside = single[data]
    for sign in (c.encode() for c in delimiters if ord(c) >= 128):
        found = np.flatnonzero(data == sign[0])
        found = found[found <= len(data) - len(sign)]
        for i, byte in enumerate(sign):
            found = found[data[found + i] == byte]
        inside[(found[:, None] + np.arange(len(sign))).ravel()] = False
    # A token begins behind a delimiter or where a text begins, and ends in front of either.
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    starts = at[:-1][at[:-1] < len(data)]
    first[starts] = inside[starts]
    last[:-1] &= ~inside[1:] | first[1:]
    begins = np.flatnonzero(first)
    places = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - begins)]).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(begins), pa.py_buffer(places), pa.py_buffer(data[inside]))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, at), pa.int32()), tokens)


def _cells(rows: np.ndarray, codes: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, codes and numbers of the distinct pairs, by row and code."""
    cells, counts = np.unique(rows.astype(np.int64) * terms + codes, return_counts=True)
    return cells // max(1, terms), cells % max(1, terms), counts


def _lists(rows: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)


def counted_words(text: pa.Array, delimiters: str, stop_words: pa.Array) -> pa.Array:
    """Each text's distinct tokens, without stop words, joined by blanks, and their counts as bytes.

    Tokens are what stands between runs of the delimiters, of which the blank is one.
    """
    if text.null_count:
        raise ValueError("text must not be null")
    sizes, found = pc.binary_length(text).to_numpy(zero_copy_only=False), []
    for a, b in _pieces(sizes, TEXT_BYTES):
        lists = _split(text.slice(a, b - a), delimiters)
        coded = lists.flatten().dictionary_encode()
        kept = ~pc.is_in(coded.dictionary, value_set=stop_words).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
        rows, codes, counts = _cells(pc.list_parent_indices(lists).to_numpy()[kept], coded.indices.to_numpy()[kept], len(coded.dictionary))
        at = _lists(rows, b - a)
        words = pa.ListArray.from_arrays(pa.array(at), coded.dictionary.take(pa.array(codes)))
        found.append(pa.StructArray.from_arrays([pc.binary_join(words, " "), pa.Array.from_buffers(
            pa.binary(), b - a, [None, pa.py_buffer(at * np.int32(4)), pa.py_buffer(counts.astype("<i4"))])], names=["terms", "counts"]))
    return pa.concat_arrays(found) if found else pa.array([], pa.struct({"terms": pa.string(), "counts": pa.binary()}))


def _coded(tokens: pa.Array) -> Iterator[tuple]:
    """Per piece: its number of rows; row, place among the piece's distinct tokens and count of each row's tokens; those.

    ``tokens`` are lists of strings, or what ``counted_words`` gives.
    """
    if pa.types.is_struct(tokens.type):
        joined, numbers = (tokens.field(name) for name in ("terms", "counts"))
        for a, b in _pieces(pc.binary_length(joined).to_numpy(zero_copy_only=False), TERM_BYTES):
            lists, part = _split(joined.slice(a, b - a), " "), numbers.slice(a, b - a)
            at = np.frombuffer(part.buffers()[1], np.int32)[part.offset:part.offset + len(part) + 1]
            held = part.buffers()[2]
            counts = np.frombuffer(held, np.uint8)[at[0]:at[-1]].copy().view("<i4") if held is not None else np.zeros(0, np.int32)
            coded = lists.flatten().dictionary_encode()
            yield (b - a, pc.list_parent_indices(lists).to_numpy().astype(np.int64), coded.indices.to_numpy(), counts, coded.dictionary)
        return
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    for a, b in _pieces(sizes, TOKENS):
        piece = tokens.slice(a, b - a)
        flat, rows = piece.flatten(), pc.list_parent_indices(piece).to_numpy()
        if flat.null_count:
            present = flat.is_valid()
            flat, rows = flat.filter(present), rows[present.to_numpy(zero_copy_only=False)]
        coded = flat.dictionary_encode()
        yield (b - a, *_cells(rows, coded.indices.to_numpy(), len(coded.dictionary)), coded.dictionary)


def partial_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(term, df, cf)`` of a part of the rows: documents that hold a term, and its occurrences."""
    for batch in batches:
        for _, _, codes, counts, terms in _coded(batch.column(0)):
            df, cf = np.bincount(codes, minlength=len(terms)), np.bincount(codes, counts, minlength=len(terms))
            yield pa.record_batch({"term": terms.cast(pa.string()), "df": pa.array(df, pa.int64()), "cf": pa.array(cf.astype(np.int64))})


def term_totals(rows: DataFrame, tokens: str) -> DataFrame:
    """``(term, df, cf)`` of a column of tokens; terms are combined before they are shuffled."""
    parts = rows.select(tokens).mapInArrow(partial_frequencies, "term string, df bigint, cf bigint")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def count_vectors(tokens: pa.Array, vocabulary: pa.Array) -> pa.Array:
    """Sparse vectors of the counts of the vocabulary's terms, as Spark's vector type stores them."""
    if tokens.null_count:
        raise ValueError("tokens must not be null")
    size, found = len(vocabulary), []
    for n, rows, codes, counts, terms in _coded(tokens):
        place = pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
        feature = place[codes]
        known = np.flatnonzero(feature >= 0)
        known = known[np.argsort(rows[known] * size + feature[known])]
        at = pa.array(_lists(rows[known], n))
        found.append(pa.StructArray.from_arrays(
            [pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, size), pa.int32()),
             pa.ListArray.from_arrays(at, pa.array(feature[known], pa.int32())),
             pa.ListArray.from_arrays(at, pa.array(counts[known], pa.float64()))], names=["type", "size", "indices", "values"]))
    return pa.concat_arrays(found) if found else pa.array([], pa.struct(
        {"type": pa.int8(), "size": pa.int32(), "indices": pa.list_(pa.int32()), "values": pa.list_(pa.float64())}))


def _splits(stage, remover) -> bool:
    """Whether the two stages split at runs of known delimiters, lower-cased, and drop stop words of any case."""
    return (isinstance(stage, RegexTokenizer) and stage.getPattern() in K.ML_DELIMITERS and stage.getGaps()
            and stage.getToLowercase() and stage.getMinTokenLength() == 1
            and isinstance(remover, StopWordsRemover) and not remover.getCaseSensitive()
            and remover.isDefined("inputCol") and remover.getInputCol() == stage.getOutputCol())


def applied(stages: Sequence[Transformer], rows: DataFrame, counted: bool = False) -> DataFrame:
    """``rows`` transformed by the stages in turn.

    With ``counted`` the column behind tokenizer and stop words holds what ``counted_words`` gives,
    and the one between them is left out: enough for the vectorizer, and few bytes for the JVM.
    """
    stages = list(stages)
    while stages:
        stage = stages.pop(0)
        if counted and stages and _splits(stage, stages[0]):
            rows = _counted(stage, stages.pop(0), rows)
        elif isinstance(stage, CountVectorizerModel) and stage.getMinTF() == 1 and not stage.getBinary():
            vocabulary = pa.array(stage.vocabulary, pa.string())
            counts_of = F.arrow_udf(lambda tokens, known=vocabulary: count_vectors(tokens, known), VectorUDT())
            rows = rows.withColumn(stage.getOutputCol(), counts_of(stage.getInputCol()))
        else:
            rows = stage.transform(rows)
    return rows


def _counted(tokenizer: RegexTokenizer, remover: StopWordsRemover, rows: DataFrame) -> DataFrame:
    """Texts with a capital sigma are split by the stages: Java and SQL disagree on where one is final."""
    text, output = F.col(tokenizer.getInputCol()), remover.getOutputCol()
    delimiters = K.ML_DELIMITERS[tokenizer.getPattern()]
    words = pa.array(sorted({w.lower() for w in remover.getStopWords() if w is not None}), pa.string())
    counts_of = F.arrow_udf(lambda found: counted_words(found, delimiters, words), "terms string, counts binary")
    sigma, odd = F.contains(text, F.lit(SIGMA)), f"{output}_of_sigma"
    rows = rows.withColumn(odd, F.when(sigma, text).otherwise(""))
    rows = tokenizer.copy({tokenizer.inputCol: odd, tokenizer.outputCol: f"{odd}_tokens"}).transform(rows)
    # Split already, lower-cased as the stage does it, and so joined again.
    lowered = F.when(sigma, F.array_join(f"{odd}_tokens", " ")).otherwise(F.lower(text))
    return rows.withColumn(output, counts_of(lowered)).drop(odd, f"{odd}_tokens")
