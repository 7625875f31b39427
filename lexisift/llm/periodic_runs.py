"""Periodic runs of words by string synchronising sets.

A run is a stretch of words that repeats a block of ``q`` words, ``q`` being its smallest
period, and that no neighbouring word extends. Periods from t to 2t - 1 are looked for at
scale t, for t = 1, 2, 4 and so on. There, position i belongs to the synchronising set if the
smallest hash among the windows of t words that start at i to i + t is that of the first
or of the last. Windows that repeat a block of at most t / 4 words do not count. So
membership depends on the 2t words from i alone, equal contexts are in it together, and
any 2t neighbouring positions outside highly periodic regions hold a member.

Members with equal contexts that follow each other at a distance of t to 2t - 1 propose
this distance as a period; every run of four or more blocks has such a pair, since two of its
contexts at a smaller distance would give it a smaller period. Proposals are then
extended word by word. The windows left out lie in runs of a period of at most t / 4, which
smaller scales have found before, so no run is lost.

Texts are independent rows. Those of a batch lie one after the other with a word of its
own behind each, so that every step works on long arrays; time is n log^2 n, memory a few
arrays of n numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.llm.hashing import mix

BATCH_WORDS = 200_000    # words that are worked on at a time; a longer text is a batch of its own
MIN_LENGTH = 6           # words that a run has at least
MIN_EXPONENT = 4         # blocks that a run has at least

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_NONE = np.uint64(2**64 - 1)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of both arrays agree; looks at ever larger pieces."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:min(at + step, n)] != b[at:min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return n


def _extended(words: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The maximal stretch around ``start`` to ``end`` that keeps the period."""
    right = _agreeing(words[end:], words[end - period:])
    left = _agreeing(words[:start][::-1], words[:start + period][::-1])
    return start - left, end + right


def _members(windows: np.ndarray, scale: int) -> np.ndarray:
    """Synchronising positions, given the hashes of windows (``_NONE`` for those left out)."""
    least, width = windows, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    first, last = windows[:-scale], windows[scale:]
    least = np.minimum(least[:len(last)], last)
    return np.flatnonzero(((first == least) | (last == least)) & (least != _NONE))


def _covered(runs: list[tuple[int, int, int]], scale: int, size: int) -> np.ndarray:
    """Windows of ``scale`` words inside a run of a period of at most a quarter of that."""
    change = np.zeros(size + 1, np.int64)
    for start, end, period in runs:
        if 4 * period <= scale <= end - start:
            change[start] += 1
            change[end - scale + 1] -= 1
    return change.cumsum()[:size] > 0


def _proposed(members: np.ndarray, contexts: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """``(first, last, period)`` of members that belong to one chain of equal contexts."""
    order = np.argsort(contexts, kind="stable")
    at, context = members[order], contexts[order]
    distance = np.diff(at)
    near = (context[1:] == context[:-1]) & (distance >= scale) & (distance < 2 * scale)
    at, distance = at[:-1][near], distance[near]
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    new = np.flatnonzero((np.diff(distance) != 0) | (np.diff(at) > 2 * scale)) + 1
    for low, high in zip(np.r_[0, new], np.r_[new, len(at)]):
        if high > low:
            yield int(at[low]), int(at[high - 1]), int(distance[low])


def find_runs(codes: np.ndarray, lengths: np.ndarray, exponent: int = MIN_EXPONENT,
              least: int = MIN_LENGTH) -> np.ndarray:
    """Rows ``(text, start, length, period)``, sorted, of texts of word codes laid end to end.

    ``codes`` are not negative; ``lengths`` are those of the texts.
    """
    texts = np.arange(len(lengths))
    owner = np.repeat(texts, lengths + 1)                 # with one separator behind each text
    ends = np.cumsum(lengths + 1) - 1
    words = np.empty(len(owner), np.int64)
    words[np.setdiff1d(np.arange(len(owner)), ends, assume_unique=True)] = codes
    words[ends] = -1 - texts
    begin = ends - lengths
    windows = mix((words.astype(np.uint64) + np.uint64(1)) * _LEFT)
    origin, known, found = np.arange(len(owner)), [], []
    scale = 1
    while True:
        long = lengths >= exponent * scale
        if not long.any():
            break
        keep = long[owner]
        if keep.mean() < 0.75:                            # shorter texts are done
            place = np.cumsum(keep) - 1
            known = [(int(place[s]), int(place[s]) + e - s, p) for s, e, p in known if keep[s]]
            windows = np.concatenate([windows, np.zeros(len(words) - len(windows), np.uint64)])[keep]
            words, owner, origin = words[keep], owner[keep], origin[keep]
            windows = windows[:len(words) - scale + 1]
        if len(words) < 2 * scale:
            break
        doubled = mix(windows[:-scale] * _LEFT + windows[scale:] * _RIGHT)
        fit = windows
        if any(4 * p <= scale <= e - s for s, e, p in known):
            fit = np.where(_covered(known, scale, len(windows)), _NONE, windows)
        members = _members(fit, scale)
        done_period, done_end = 0, 0
        for first, last, period in _proposed(members, doubled[members], scale):
            if period == done_period and first + period < done_end:
                continue
            start, end = _extended(words, first, last + period + 2 * scale, period)
            done_period, done_end = period, end
            if end - start >= exponent * period:
                found.append((origin[start], end - start, period))
            if end - start >= 4 * period:
                known.append((start, end, period))
        windows, scale = doubled, 2 * scale
    rows = np.array([r for r in found if r[1] >= least], np.int64).reshape(-1, 3)
    text = np.searchsorted(ends, rows[:, 0])
    rows = np.column_stack([text, rows[:, 0] - begin[text], rows[:, 1:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def kept_words(length: int, runs: np.ndarray) -> np.ndarray:
    """Indices of the words that no run holds behind its first block."""
    change = np.zeros(length + 1, np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    return np.flatnonzero(change.cumsum()[:length] == 0)


def _scan(exponent: int, least: int):
    def pieces(texts: Iterator[bytes | None]) -> Iterator[list[list[bytes]]]:
        held, size = [], 0
        for text in texts:
            held.append((text or b"").split())
            size += len(held[-1])
            if size >= BATCH_WORDS:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in pieces(v.as_py() for v in batch.column("text").cast(pa.binary())):
                lengths = np.array([len(t) for t in texts], np.int64)
                codes = pd.factorize(np.array([w for t in texts for w in t], object))[0]
                rows = find_runs(codes, lengths, exponent, least)
                cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
                kept = []
                for k, words in enumerate(texts):
                    if cuts[k] < cuts[k + 1]:
                        words = [words[i] for i in kept_words(len(words), rows[cuts[k]:cuts[k + 1], 1:])]
                    kept.append(b" ".join(words))
                fields = {n: pa.array(rows[:, i + 1]) for i, n in enumerate(("start", "length", "period"))}
                runs = pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(at, len(texts)), "n_words": pa.array(lengths),
                    "runs": runs, "collapsed": pa.array(kept, pa.binary()).cast(pa.string())})
                at += len(texts)
    return run


def periodic_runs(documents: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per document.

    Words are separated by ASCII white space and compared as they are. ``runs`` are all
    runs of at least ``min_length`` words and ``min_exponent`` times their smallest period, by
    start and then period, with ``start`` as a word number from 0. ``collapsed`` is the text
    without the words that a run holds behind its first block, joined by one blank.
    Null texts count as empty and have no runs; runs that overlap are all listed;
    repeated rows and rows without ``doc_id`` give a row each; an empty table gives none;
    other columns are ignored. Below an exponent of four the proposals would not be complete, so
    that is an error.
    """
    if min_exponent < 4:
        raise ValueError("min_exponent must be at least 4")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(min_exponent, min_length), f"doc_id long, n_words long, runs {RUNS}, collapsed string")
