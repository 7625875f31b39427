"""License scans with a trained classifier of word windows.

A paragraph is a run of non-blank lines, so a wrapped notice is whole. Windows of a few words
and of some more slide over every paragraph; each, a bag of hashed word n-grams, goes to
a multinomial logistic regression that names a family or ``unknown``. It is trained on
variants of notices among other words, and on windows from anywhere in the documents; how
sure it has to be is calibrated on notices and windows kept out of training. Neighbouring
windows of one family are a passage, which counts if it holds enough of the word pairs
of one of that family's templates within a stretch not much longer than the template.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.llm.hashing import mix

BUCKETS = 1 << 13        # hashed n-gram features
SIZES = ((8, 4), (32, 8))    # words of a window, and from one to the next
SAMPLE_DOCS = 4_000      # documents that give windows to the training sample
VARIANTS = 10            # made from each notice, half of them for each size of window
MISSED = 0.02            # share of held-out notices that calibration may give up
FALSE = 0.001            # share of held-out windows that it lets pass otherwise
CONFIRMED = 0.7          # share of a template's word pairs that a passage must hold
SLACK = 1.5              # words of that stretch as a share of those of the template
BLOCK = 1 << 16          # words that are scored at a time
_MARKS = b"#/*%!|<>-=~+_`"   # at the ends of words: comment signs and rulers
UNKNOWN = "unknown"

# Names of the licences of each family, and sentences that refer to one.
NAMES = {
    "agpl": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0-or-later", "AGPL-3.0-only"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "bsd": ["BSD License", "3-Clause BSD License", "2-Clause BSD License", "BSD-3-Clause", "BSD-2-Clause"],
    "cc-by": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0"],
    "cc0": ["CC0 1.0 Universal Public Domain Dedication", "CC0-1.0"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License version 2 or later", "GNU GPL v3",
            "GPL-3.0-or-later", "GPL-2.0-only"],
    "isc": ["ISC License", "ISC"],
    "lgpl": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License version 3 or later",
             "LGPL-2.1-or-later", "LGPL-3.0-only"],
    "mit": ["MIT License", "MIT"],
    "mpl": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
}
PHRASES = ["Licensed under the {}", "Released under the {}", "Distributed under the terms of the {}", "Available under the {}",
           "This work is licensed under a {}", "This work is licensed under the {}", "Licensed under {}"]
IDENTIFIER = "SPDX-License-Identifier: {}"

# Usual notices of each family, by sentence or paragraph.
NOTICES = {
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation"],
    "apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
            "ARE DISCLAIMED."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation",
            "You should have received a copy of the GNU General Public License along with this program."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction",
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so",
            "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
}


def _referring(name: str) -> list[str]:
    single = " " not in name
    return [*([IDENTIFIER.format(name)] if single else []), *(p.format(name) for p in PHRASES if not single or "the {}" in p
                                                              or p == "Licensed under {}")]


TEMPLATES = {family: [*NOTICES.get(family, []), *(t for name in names for t in _referring(name))] for family, names in NAMES.items()}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the words and of the pairs of words in a row."""
    return (np.concatenate([hashes, _pairs(hashes)]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _words(text: str) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().translate(None, b".,;:()\"'").replace(b"licence", b"license").split()
    return [w for w in (x.strip(_MARKS) for x in words) if w]


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * np.uint64(3) + hashes[1:])


# Each template as family, number of words and places of its pairs in the table of all pairs.
_LENGTHS = [(family, len(_words(t)), _pairs(_word_hashes(_words(t)))) for family, texts in TEMPLATES.items() for t in texts]
_PAIRS = np.unique(np.concatenate([pairs for _, _, pairs in _LENGTHS]))
_HELD = np.array([np.isin(_PAIRS, pairs) for _, _, pairs in _LENGTHS])
_NEEDED = CONFIRMED * _HELD.sum(axis=1)
_MAYBE = np.zeros(BUCKETS, bool)
_MAYBE[_PAIRS & np.uint64(BUCKETS - 1)] = True


def _paragraphs(text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words of a text, the line number of each and the paragraph of each.

    A word broken at its hyphen is one word, of the line that it starts on.
    """
    words, sizes, parts, part, broken = [], [], [], 0, False
    for line in text.split("\n"):
        found = _words(line)
        part += not found
        if broken and found:
            words[-1] += b"-" + found.pop(0)
        broken = len(line := line.rstrip()) > 1 and line[-1] == "-" and line[-2].isalnum() and bool(words or found)
        words += found
        sizes.append(len(found))
        parts.append(part)
    return words, np.repeat(np.arange(len(sizes)), sizes), np.repeat(parts, sizes)


def _tightest(at: list[int], pairs: list[int], low: int, high: int, reach: int) -> tuple[int, int, int]:
    """Of the windows that start at hits ``low`` to ``high``: ``(most pairs, first hit, last hit)``, the shortest."""
    best = (0, 0, low, low)
    for i in range(low, high + 1):
        seen, last = set(), i
        for j in range(i, len(at)):
            if at[j] - at[i] >= reach:
                break
            if pairs[j] not in seen:
                seen.add(pairs[j])
                last = j
        best = max(best, (len(seen), at[i] - at[last], -i, last))
    return best[0], -best[2], best[3]


def _passages(at: np.ndarray, pairs: np.ndarray, need: float, reach: int) -> Iterator[tuple[int, int, int]]:
    """First and last hit, and number of different pairs, of the passages that hold ``need`` of them within ``reach``."""
    if len(at) < need:
        return
    at, pairs = at.tolist(), pairs.tolist()
    inside, end, start = Counter(), 0, 0
    while start < len(at):
        while end < len(at) and at[end] - at[start] < reach:
            inside[pairs[end]] += 1
            end += 1
        step = start + 1
        if len(inside) >= need:
            held, first, last = _tightest(at, pairs, start, end - 1, reach)
            yield first, last, held
            step = last + 1
        for k in range(start, min(step, end)):
            inside[pairs[k]] -= 1
            if not inside[pairs[k]]:
                del inside[pairs[k]]
        start = step
        if end < start:
            end = start


def _hits(hashes: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the pairs, within a paragraph, that stand in a template, and places in the table of pairs."""
    if len(hashes) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = _pairs(hashes)
    at = np.flatnonzero(_MAYBE[pairs & np.uint64(BUCKETS - 1)] & (parts[:-1] == parts[1:]))
    place = np.minimum(np.searchsorted(_PAIRS, pairs[at]), len(_PAIRS) - 1)
    real = _PAIRS[place] == pairs[at]
    return at[real], place[real]


def candidates(hashes: np.ndarray, parts: np.ndarray, wanted: str | None = None) -> list[tuple[str, int, int, float]]:
    """``(family, first word, last word, share of it)`` of all passages that hold enough of a template, of one family if wanted."""
    at, place = _hits(hashes, parts)
    out = []
    for (family, length, _), held in zip(_LENGTHS, _HELD, strict=True):
        if wanted not in (None, family):
            continue
        own, need, reach = held[place], CONFIRMED * held.sum(), int(SLACK * length)
        if own.sum() < need:
            continue
        mine, which = at[own], place[own]
        # Paragraphs are moved apart, so that no stretch reaches over their border.
        apart = mine + parts[mine] * (reach + 1)
        out += [(family, int(mine[a]), int(mine[b]) + 1, n / int(held.sum())) for a, b, n in _passages(apart, which, need, reach)]
    return out


def holds_template(text: str) -> bool:
    words, _, parts = _paragraphs(text)
    return bool(candidates(_word_hashes(words), parts))


def _vector(words: list[bytes]) -> SparseVector:
    at, n = np.unique(_features(_word_hashes(words)), return_counts=True)
    return SparseVector(BUCKETS, at.tolist(), (n / np.sqrt(n.sum())).tolist())


def _variants(notice: str, others: list[list[bytes]], rng: random.Random) -> Iterator[list[bytes]]:
    """Windows that hold a notice, or a part of a long one, some words lost, among other words."""
    for k in range(VARIANTS):
        size = SIZES[k % len(SIZES)][0]
        words = _words(notice)
        at = rng.randrange(max(1, len(words) - size + 1))
        words = words[at:at + size]
        words = [w for w in words if rng.random() > 0.1] or words if k >= len(SIZES) else words
        room = rng.randrange(size - len(words) + 1) if len(words) < size else 0
        around = rng.choice(others)[:room] if others else []
        cut = rng.randrange(len(around) + 1)
        yield [*around[:cut], *words, *around[cut:]]


class Classifier:
    """Weights of the families and of ``unknown``, and the probability of any family above which a window counts."""

    def __init__(self, families: list[str], weights: np.ndarray, intercepts: np.ndarray, least: float = 0.5):
        self.families, self.weights, self.intercepts, self.least = families, weights, intercepts, least

    def probabilities(self, words: list[bytes]) -> np.ndarray:
        """Of one window by itself."""
        features = _features(_word_hashes(words))
        logits = self.weights[features].sum(axis=0) / np.sqrt(max(1, len(features))) + self.intercepts
        value = np.exp(logits - logits.max())
        return value / value.sum()

    def best(self, words: list[bytes]) -> str:
        """The most likely family, ``unknown`` included."""
        return self.families[int(self.probabilities(words).argmax())]

    def windows(self, hashes: np.ndarray, parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(family, first word, end)`` of the windows that count, of all windows of all paragraphs."""
        n = len(hashes)
        last = np.searchsorted(parts, parts, "right")          # where the paragraph of a word ends
        first = np.searchsorted(parts, parts)
        for low in range(0, n, BLOCK):
            high = min(n, low + BLOCK + max(size for size, _ in SIZES))
            part = hashes[low:high]
            ones = self._sums(part & np.uint64(BUCKETS - 1))
            twos = self._sums(_pairs(part) & np.uint64(BUCKETS - 1))
            for size, step in SIZES:
                at = np.arange(low, min(n, low + BLOCK))
                at = at[(at - first[at]) % step == 0]            # counted from the start of the paragraph
                end = np.minimum(at + size, last[at])
                many = 2 * (end - at) - 1
                logits = (ones[end - low] - ones[at - low] + twos[end - low - 1] - twos[at - low]) / np.sqrt(many)[:, None]
                logits += self.intercepts
                best = logits[:, :-1].argmax(axis=1)
                known = np.exp(logits[:, :-1] - logits[:, -1:]).sum(axis=1)     # odds against unknown
                for k in np.flatnonzero(known > self.least / (1 - self.least)):
                    yield int(best[k]), int(at[k]), int(end[k])

    def _sums(self, buckets: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(buckets) + 1, len(self.families)))
        np.cumsum(self.weights[buckets.astype(np.int64)], axis=0, out=sums[1:])
        return sums

    def passages(self, hashes: np.ndarray, parts: np.ndarray) -> list[tuple[str, int, int]]:
        """Windows of one family that touch, within a paragraph, as ``(family, first word, end)``."""
        out: list[list] = []
        for family, at, end in sorted(self.windows(hashes, parts)):
            if out and out[-1][0] == family and at <= out[-1][2] and parts[at] == parts[out[-1][1]]:
                out[-1][2] = max(out[-1][2], end)
            else:
                out.append([family, at, end])
        return [(self.families[f], at, end) for f, at, end in out]


def train(documents: DataFrame) -> Classifier:
    """Fit on variants of the notices and on windows of documents.

    Up to ``SAMPLE_DOCS`` documents, chosen by hash, give two windows each from anywhere in their
    text, without those that hold a template. A third of the windows and of the variants
    stay out of training. The probability of not being unknown that a window needs lies above
    all but ``FALSE`` of the held-out windows, but not above more than ``MISSED`` of the held-out notices.
    """
    texts = documents.where("text is not null")
    total = max(1, texts.count())
    chosen = texts.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(total)) < SAMPLE_DOCS)
    largest = max(size for size, _ in SIZES)
    words = chosen.select("doc_id", F.split("text", r"\s+").alias("w"))
    start = F.pmod(F.xxhash64("doc_id", "salt"), F.greatest(F.size("w") - largest + 1, F.lit(1))).cast("int") + 1
    pieces = words.withColumn("salt", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.array_join(F.transform(F.slice("w", start, F.lit(largest)), lambda w: F.substring(w, 1, 200)), " "))
    ordinary = sorted({t for t, in pieces.collect() if _words(t) and not holds_template(t)})
    rng = random.Random(4)
    # Half of them are cut to the smaller size.
    windows = [_words(t)[:size] for k, t in enumerate(ordinary) for size in [SIZES[k % len(SIZES)][0]]]
    families = [*TEMPLATES, UNKNOWN]
    held, learned = windows[::3], [w for k, w in enumerate(windows) if k % 3]
    notices = [(k, v) for k, family in enumerate(families[:-1]) for t in TEMPLATES[family] for v in _variants(t, learned, rng)]
    kept_out, notices = notices[::3], [n for k, n in enumerate(notices) if k % 3]
    rows = [(float(k), _vector(v)) for k, v in notices]
    rows += [(float(len(families) - 1), _vector(w)) for w in [*learned, _words("no words of a license at all")]]
    model = LogisticRegression(regParam=0.001, maxIter=30, family="multinomial").fit(
        documents.sparkSession.createDataFrame(rows, ["label", "features"]))
    found = Classifier(families, model.coefficientMatrix.toArray().T.copy(), model.interceptVector.toArray())
    false, true = ([1 - found.probabilities(w)[-1] for w in side] for side in (held, [v for _, v in kept_out]))
    found.least = float(min(max(0.5, np.quantile(false, 1 - FALSE) if false else 0.0), np.quantile(true, MISSED), 1 - 1e-9))
    return found


def license_spans(text: str, classifier: Classifier) -> list[tuple[str, int, int]]:
    """``(family, line, words)`` of the notices of a text: the line of the first word, and their length."""
    words, lines, parts = _paragraphs(text)
    hashes = _word_hashes(words)
    spans = set()
    # Without enough pairs of some template, or in a paragraph without any, nothing can be confirmed,
    # so the windows need no score.
    at, place = _hits(hashes, parts)
    if not (_HELD[:, np.unique(place)].sum(axis=1) >= _NEEDED).any():
        return []
    own = np.isin(parts, parts[at])
    passages = []
    if own.any():
        at = np.flatnonzero(own)
        passages = [(f, int(at[low]), int(at[high - 1]) + 1) for f, low, high in classifier.passages(hashes[at], parts[at])]
    for family, low, high in passages:
        # The ends of a notice may lie outside the windows that count.
        margin = SIZES[-1][0]
        begin = max(low - margin, int(np.searchsorted(parts, parts[low])))
        end = min(high + margin, int(np.searchsorted(parts, parts[low], "right")))
        for _, first, last, share in candidates(hashes[begin:end], parts[begin:end], family):
            first, last = first + begin, last + begin
            # The notice itself, without what stands around it, has to be of the family too.
            if first < high and last >= low and classifier.best(words[first:last + 1]) == family:
                spans.add((-share, first - last, first, last, family))
    out: list[list] = []
    # Words belong to the family that they hold most of; what shares words within it is one notice.
    for _, _, first, last, family in sorted(spans):
        shared = [x for x in out if first <= x[1] and last >= x[0]]
        if all(x[2] == family for x in shared):
            out = [x for x in out if x not in shared]
            out.append([min([first, *(x[0] for x in shared)]), max([last, *(x[1] for x in shared)]), family])
    return sorted(((family, int(lines[a]), b - a + 1) for a, b, family in out), key=lambda x: (x[1], x[0], x[2]))


def _scan(classifier: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({(line, f) for f, line, _ in license_spans(t.as_py(), classifier)}) if t.is_valid else []
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_license": pa.array([len(f) for f in found], pa.int64()),
                "families": pa.array([",".join(sorted({x[1] for x in f})) for f in found], pa.string()),
                "lines": pa.array([",".join(f"{x[1]}:{x[0]}" for x in f) for f in found], pa.string())})
    return run


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_license, families, lines``.

    ``families`` are those found, sorted and comma-joined; ``lines`` has ``family:line number``
    (from 0) in order, the line being that of a notice's first word. A notice may go on over
    several lines up to a blank one (or one of comment signs alone), and may stand anywhere
    among other words; one that only refers to a licence by a usual sentence counts. Null, empty and wordless texts have none.
    Repeated rows and rows without ``doc_id`` give a row each; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(train(rows)), "doc_id long, n_license long, families string, lines string")
