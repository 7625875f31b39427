import hashlib
import random
import zlib

import numpy as np
import pytest

from lexisift.llm import queries
from lexisift.llm.periodic_runs import find_runs, kept_words, periodic_runs
from tests.llm.conftest import rows_of


def plain_runs(words, exponent=4, least=6):
    """Every period tried on every stretch."""
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                stretch = words[i:i + length]
                if not any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def got(texts, **options):
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.array([w for t in texts for w in t], np.int64)
    rows = find_runs(codes, lengths, **options).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == k] for k in range(len(texts))]


def random_text(rng):
    words = []
    while len(words) < rng.randrange(1, 160):
        kind = rng.random()
        block = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 12))]
        if kind < 0.25:                                     # a run whose block is itself repetitive
            block = block[:2] * rng.randrange(1, 7) + block[2:4]
        words += (block * rng.randrange(1, 9))[:rng.randrange(1, 90)]
    return words


def test_runs_equal_every_period_tried():
    rng = random.Random(5)
    for _ in range(120):
        texts = [random_text(rng) for _ in range(rng.randrange(1, 9))] + [[]]
        assert got(texts) == [plain_runs(t) for t in texts]


def test_runs_of_few_letters():
    rng = random.Random(6)
    texts = [[rng.randrange(2) for _ in range(rng.randrange(200))] for _ in range(150)]
    assert got(texts) == [plain_runs(t) for t in texts]
    assert got(texts, exponent=6, least=9) == [plain_runs(t, 6, 9) for t in texts]


def test_long_runs_and_long_periods():
    rng = random.Random(7)
    block = [rng.randrange(10**6) for _ in range(5000)]
    text = [1] * 30 + block * 4 + block[:17] + [2, 3] * 9000 + [5]
    assert got([text, text[:100]]) == [
        [(0, 30, 1), (30, 20017, 5000), (20047, 18000, 2)], [(0, 30, 1)]]


def test_many_texts_do_not_run_into_each_other():
    texts = [[1, 2]] * 50 + [[1]] * 50 + [[3] * 6]
    assert got(texts) == [[]] * 100 + [[(0, 6, 1)]]


def test_kept_words():
    assert kept_words(8, np.array([(1, 6, 1)])).tolist() == [0, 1, 7]
    assert kept_words(3, np.empty((0, 3), np.int64)).tolist() == [0, 1, 2]


def test_operator_defined_cases(spark, make):
    documents = make([(1, "a b " * 4 + "c"), (2, None), (3, ""), (4, " \n\t\x0b "), (None, "x " * 7),
                      (5, "é é " + " é" * 7), (5, "é é " + " é" * 7)], extra="runs")
    result = periodic_runs(documents)
    assert result.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in result.collect()]
    strange = (5, 8, [(1, 7, 1)], "é é  é")
    assert sorted(rows, key=repr) == sorted([
        (1, 9, [(0, 8, 2)], "a b c"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""),
        (None, 7, [(0, 7, 1)], "x"), strange, strange], key=repr)
    assert periodic_runs(documents.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(documents, min_exponent=3)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    first = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    return (doc_id, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def test_query_equals_plain_python(spark, tmp_path, make):
    rng = random.Random(8)
    documents = [(k, " ".join(f"w{w}" for w in random_text(rng))) for k in range(300)]
    documents += [(300, None), (301, ""), (None, "q " * 40), (7, "again " * 9)]
    documents += [(k, " ".join(f"u{i}" for i in range(57 + k % 31))) for k in range(400, 600)]
    make(documents, extra="period").write.parquet(str(tmp_path / "documents.parquet"))
    result = queries.op12_periodic_runs(spark, str(tmp_path))
    assert rows_of(result, "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                   "runs_sha256", "collapsed_sha256") == sorted((expected(*d) for d in documents), key=repr)
