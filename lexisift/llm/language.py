"""Language identification by compression.

For each language a raw zstandard dictionary is cut from labelled documents. A text is
encoded once with each dictionary, and the language whose dictionary gives the smallest
result is chosen; a text that two languages fit about alike is rejected. A dictionary saves
a bounded number of bytes, so long texts are encoded in blocks of about one size, all of
them, and the sizes added up: the margin then does not shrink with length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.llm.tables import blocks_for

SAMPLE_DOCS = 48         # labelled documents per language that a dictionary is cut from
SAMPLE_CHARS = 2_400     # characters that each of them adds at most
LANGUAGES = 64           # languages a model may have, so that it stays within about 20 MB
LEVEL = 6                # compression of long texts
SHORT, SHORT_LEVEL = 512, 12   # shorter texts (bytes) are compressed harder, as ties are likelier
BLOCK = 1 << 15          # bytes of a long text that are encoded at a time
NARROW = 0.005           # margin of the best over the second, as a share of its size
UNKNOWN = "und"
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def plain(text: str) -> bytes:
    """Lower-cased UTF-8 with every ASCII character but letters turned into a space."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS)


def blocks(content: bytes) -> list[bytes]:
    """The whole content in pieces of about one size, at most ``BLOCK`` bytes each."""
    count = blocks_for(len(content), BLOCK)
    ends = [len(content) * k // count for k in range(count + 1)]
    return [content[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def training_rows(doc_id: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id as text is not 1 modulo 3."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 != 1


def learn_dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionaries from ``(doc_id, text, lang)`` rows, all of which may be learned from.

    A bounded sample: per language the ``SAMPLE_DOCS`` documents whose ids hash lowest,
    ``SAMPLE_CHARS`` characters of each. The ids are ranked first, without their texts.
    """
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # Expected to pass four times the sample; the exact cut follows on the few that are left.
    share = 4.0 * SAMPLE_DOCS / F.col("n")
    near = F.pmod(order, F.lit(1 << 20)) < share * (1 << 20)
    few = rows.join(F.broadcast(counts.limit(LANGUAGES + 1)), "lang").where(near)
    cut = few.select("lang", order.alias("order"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order", "text")))
    sample = ranked.where(F.col("rank") <= SAMPLE_DOCS).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("texts")).limit(LANGUAGES + 1).collect()
    if len(sample) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    return {r["lang"]: plain("\n".join(t["text"] for t in r["texts"]))
            for r in sorted(sample, key=lambda r: r["lang"])}


class Encoders:
    """One compressor per language, made once for a task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.long = [self._compressor(d, LEVEL) for d in dictionaries.values()]
        self.short = [self._compressor(d, SHORT_LEVEL) for d in dictionaries.values()]

    @staticmethod
    def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=data, write_checksum=False, write_content_size=False)

    def decide(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, score, rejected)``; the score grows from 0 with the margin."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        content = plain(text)
        compressors = self.short if len(content) < SHORT else self.long
        parts = blocks(content)
        sizes = sorted((sum(len(c.compress(part)) for part in parts), name)
                       for c, name in zip(compressors, self.names, strict=True))
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        margin = (sizes[1][0] - sizes[0][0]) / sizes[0][0]
        return sizes[0][1], 1.0 - math.exp(-20 * margin), margin < NARROW


def _predict(dictionaries: dict[str, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(dictionaries)
        for batch in batches:
            decided = [encoders.decide(t.as_py()) for t in batch.column("text")]
            names, scores, rejected = zip(*decided, strict=True) if decided else ((), (), ())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()),
                "rejected": pa.array(rejected, pa.bool_())})
    return run


def predict_languages(documents: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, rejected``.

    Only the text is looked at. Null texts and texts without a letter are ``und`` and
    rejected; so is everything if no language was learned. Equal sizes go to the language first
    by name, with score 0. Repeated rows give a row each; other columns are ignored.
    ``held_out`` is null without a ``doc_id``.
    """
    held = (~training_rows()).alias("held_out")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(dictionaries), "doc_id long, held_out boolean, lang_pred string, "
                            "score double, rejected boolean")


def identify(documents: DataFrame) -> DataFrame:
    """Learn from the documents that may be learned from, then predict all of them."""
    return predict_languages(documents, learn_dictionaries(documents.where(training_rows())))


def known_language(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without those that language identification rejects."""
    dictionaries = learn_dictionaries(documents.where(training_rows()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(dictionaries)
        for batch in batches:
            yield batch.filter(pa.array([not encoders.decide(t.as_py())[2] for t in batch.column("text")], pa.bool_()))
    return documents.mapInArrow(run, documents.schema)
