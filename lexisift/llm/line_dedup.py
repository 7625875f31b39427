"""Line dedup by winnowing over line hashes.

Each line is hashed. From every line, forwards and backwards, the shortest run with enough
words is a window; its smallest line hash is its fingerprint, so equal runs have equal
fingerprints wherever they stand. Positions are joined by fingerprint. Windows over
a fingerprint that occurs once are done; the others are matched as wholes with the
first place they stand at. Forward and backward windows around a matched line
extend the match to both ends of the repeated run, and later copies of the run are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexisift.session import durable

MIN_WORDS = 30     # words that a repeated run of lines has at least


def _windows(lines: list[str], min_words: int) -> set[tuple[int, int]]:
    """``(start, end)`` of the shortest runs from each line, forwards and backwards."""
    total = np.cumsum([0] + [len(line.split()) for line in lines])
    if total[-1] < min_words:
        return set()
    n = len(lines)
    ends = np.searchsorted(total, total[:-1] + min_words)           # first end with enough words
    starts = np.searchsorted(total, total[1:] - min_words, "right") - 1   # last start with enough
    return ({(i, int(e)) for i, e in enumerate(ends) if e <= n}
            | {(int(s), j + 1) for j, s in enumerate(starts) if s >= 0})


def _fingerprints(min_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                lines = text.split("\n")
                spans = _windows(lines, min_words)
                if not spans:
                    continue
                digests = np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))
                                       for x in lines), np.uint64, len(lines))
                signed = digests.view(np.int64)
                for start, end in sorted(spans):
                    at = start + int(signed[start:end].argmin())
                    out.append((doc_id, start, end, at, int(signed[at]),
                                xxhash.xxh3_128_digest(digests[start:end].tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "start", "end", "at", "fingerprint", "content"])
    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, deleted = [], [], []
        for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
            lines = text.as_py().split("\n") if text.is_valid else []
            keep = np.ones(len(lines), bool)
            for r in runs.as_py() or ():
                keep[r["start"]:r["end"]] = False
            texts.append("\n".join(x for x, k in zip(lines, keep, strict=True) if k) if text.is_valid else None)
            counts.append(len(lines))
            deleted.append(int((~keep).sum()))
        columns = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "runs"}
        columns["text"] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_pydict(columns | {
            "n_lines": pa.array(counts, pa.int64()), "n_deleted": pa.array(deleted, pa.int64())})


def repeated_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, start, end)``: windows of lines that stand at an earlier place as well.

    Places are ordered by ``doc_id``, then line. Lines are numbered from 0, ``end`` is
    exclusive.
    """
    rows = documents.where("text is not null and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = durable(rows.mapInPandas(_fingerprints(min_words),
                                       "doc_id long, start int, end int, at int, fingerprint long, content binary"), "windows")
    # A fingerprint is a line: one that stands in a single place has nothing to be joined with.
    place = F.struct("doc_id", "at")
    twice = windows.groupBy("fingerprint").agg(F.min(place).alias("low"), F.max(place).alias("high")).where(
        "low <> high").select("fingerprint")
    matched = windows.join(twice, "fingerprint")
    first = matched.groupBy("content").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n"))
    later = matched.join(first.where("n > 1").drop("n"), "content").where(
        F.struct("doc_id", "start") > F.col("first"))
    return later.select("doc_id", "start", "end").distinct()


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of the documents, repeated runs cut from ``text``, and ``n_lines``, ``n_deleted``.

    A run is a series of whole lines (separated by a line feed) with at least ``min_words``
    words; it is repeated if equal lines stand in a row at an earlier place, in the same
    document too. A line inside any repeated run is deleted, others stay as they are, so
    short repeated lines stay. Null and empty texts, and rows without ``doc_id``, come back
    unchanged. Rows that repeat a ``doc_id`` count as one place each line and lose the same lines.
    """
    runs = repeated_runs(documents, min_words).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "end")).alias("runs")).withColumnRenamed("doc_id", "run_doc")
    columns = [c for c in documents.columns if c not in ("n_lines", "n_deleted", "runs", "run_doc")]
    own = documents.select(*columns).withColumn("text", F.col("text").cast("string"))
    joined = own.join(runs, F.col("doc_id") == F.col("run_doc"), "left").drop("run_doc")
    schema = StructType(own.schema.fields).add("n_lines", "long").add("n_deleted", "long")
    return joined.mapInArrow(_kept, schema)
