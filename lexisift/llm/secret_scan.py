"""Secret scans: fixed patterns, and character Markov models for everything else.

Two first-order models of characters are trained from labelled samples: random strings
(values that the patterns find) and ordinary identifiers (all other strings of the same
alphabet). A string is a secret if the log-likelihood ratio of the two is high enough.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
SAMPLE_DOCS = 20_000     # documents, chosen by the hash of their id, that the models are trained on
BACK_OFF = 50            # weight of single characters where pairs are rare
LEAST_CHARS = 16         # characters of a string that the models judge
LEAST_RATIO = 20.0       # log-likelihood ratio, in nats, from which a string is a secret
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_AT = {c: i for i, c in enumerate(_ALPHABET)}

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_STRING = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{6,}")


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _free(start: int, end: int, taken: list[tuple[int, int, int]]) -> bool:
    return all(end <= s or start >= e for s, _, e in taken)


def _transitions(strings: list[str], counts: np.ndarray) -> None:
    for s in strings:
        for a, b in pairwise(s):
            if a in _AT and b in _AT:
                counts[_AT[a], _AT[b]] += 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = len(_ALPHABET)
    counts = np.zeros((2, size, size), np.int64)
    for batch in batches:
        for value in batch.column("text"):
            text = value.as_py()
            taken = pattern_spans(text)
            _transitions([re.split(r"[:=\s\"']", text[s:e])[-1] if k == 0 else text[s:e] for s, k, e in taken], counts[0])
            _transitions([m[0] for m in _WORD.finditer(text) if _free(m.start(), m.end(), taken)], counts[1])
    label, before, after = np.nonzero(counts)
    yield pa.RecordBatch.from_pydict({
        "label": pa.array(label, pa.int32()), "before": pa.array(before, pa.int32()),
        "after": pa.array(after, pa.int32()), "n": pa.array(counts[label, before, after], pa.int64())})


def train(documents: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each character pair, random strings over identifiers.

    The sample is bounded by ``SAMPLE_DOCS``; the counts that reach the driver are bounded
    by the alphabet. Without any sample the ratios are 0 and the models find nothing.
    """
    rows = documents.where("text is not null").select(
        F.xxhash64(F.col("doc_id").cast("string")).alias("key"), F.col("text").cast("string").alias("text"))
    share = min(1.0, SAMPLE_DOCS / max(1, documents.count()))
    sample = rows.where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text")
    counted = (sample.mapInArrow(_count, "label int, before int, after int, n long")
               .groupBy("label", "before", "after").agg(F.sum("n").alias("n")).collect())
    size = len(_ALPHABET)
    counts = np.zeros((2, size, size))
    for r in counted:
        counts[r["label"], r["before"], r["after"]] = r["n"]
    single = counts.sum(axis=1, keepdims=True) + 0.5
    single /= single.sum(axis=2, keepdims=True)
    logs = np.log((counts + BACK_OFF * single) / (counts.sum(axis=2, keepdims=True) + BACK_OFF))
    return logs[0] - logs[1]


def find_spans(text: str, ratios: np.ndarray) -> list[tuple[int, int, int]]:
    """All spans of a text, patterns first, then strings that the models call random."""
    found = pattern_spans(text)
    added = []
    for m in _STRING.finditer(text):
        at = np.fromiter((_AT[c] for c in m[0]), np.int64, m.end() - m.start())
        if ratios[at[:-1], at[1:]].sum() >= LEAST_RATIO and _free(m.start(), m.end(), found):
            added.append((m.start(), 3, m.end()))
    return sorted(found + added)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(ratios: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(v.as_py() or "", ratios) for v in batch.column("text")]
            base = [spelled([x for x in spans if x[1] < 3]) for spans in found]
            count = lambda k: pa.array([sum(x[1] == k for x in spans) for spans in found], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                "base_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                "spans": pa.array([spelled(spans) for spans in found], pa.string()), "n_markov": count(3)})
    return run


def scan_secrets(documents: DataFrame, ratios: np.ndarray | None = None) -> DataFrame:
    """One row per document: counts per kind, a digest of the pattern spans, and all spans.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov``. Spans are
    ``kind:start:end`` in code points, end exclusive, by start and then kind; they stand
    comma-joined. A Markov span never overlaps a pattern span. Null texts count as empty;
    repeated rows give a row each, rows without ``doc_id`` too; other columns are ignored.
    Models are trained on the documents themselves unless ``ratios`` are given.
    """
    ratios = train(documents) if ratios is None else ratios
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(ratios), "doc_id long, n_assign long, n_access long, n_hex long, "
                           "base_sha256 string, spans string, n_markov long")
