import math
import re

import numpy as np
import pytest

from lexisift.llm import decontaminate, topk


def brute_top(rows, queries, k):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {i: v for i, v in fine if i in queries}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in fine if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(16_384, 2_048), (50, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(0, 0.2, 40).astype(np.float32).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[3][1]) for k in range(30)]                       # ties
    rows += [(500, None), (501, [None] * 40), (502, [float("nan")] * 40), (503, [float("inf")] * 40), (None, rows[0][1]),
             (600, [0.5, 0.25]), (700, [0.1, 0.1]), (800, []), (900, []), (900, []), (1100, [3e9] * 40)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    queries = {i for i, _ in rows if i is not None and i % 100 == 0}
    found = topk.exact_top_k(df, df.where("vec_id % 100 = 0"), 10)
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None) for i, v in rows]
    got = sorted(map(tuple, found.collect()))
    assert [r for r in got if r[0] not in (900,)] == [r for r in brute_top(rows, queries, 10) if r[0] != 900]
    assert found.where("query_id = 800").count() == 2                         # both rows of 900
    assert topk.exact_top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("candidates", [16_384, 7])
def test_components_of_any_size(spark, monkeypatch, candidates):
    """Scores are exact, rank by their value beyond 64 bits as well, and are null there."""
    monkeypatch.setattr(topk, "CANDIDATES", candidates)
    rng = np.random.default_rng(5)
    rows = [(100, [3e6, 1.0]), (1, [2.5e6, 2.0]), (200, [2.0**31, 2.0**31, 2.0**31, 2.0**31]), (2, [2.0**31] * 4),
            (300, [1e300, -1e300, 0.5]), (3, [1e300, 1.0, 1.0]), (4, [-1e300, 1.0, 1.0]), (5, [1e299, 1.0, 0.0])]
    rows += [(10 + k, rng.normal(0, 10.0 ** rng.integers(-1, 14), 4).tolist()) for k in range(60)]
    rows += [(400 + 100 * k, rng.normal(0, 10.0 ** (4 * k), 4).tolist()) for k in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.exact_top_k(df, df.where("vec_id % 100 = 0"), 10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got[100]) == [(1, 1, 7864320000002097152)]
    want = {}
    for q, rank, vec_id, score in brute_top(rows, {i for i, _ in rows if i % 100 == 0}, 10):
        want.setdefault(q, []).append((rank, vec_id, score if -2**63 <= score < 2**63 else None))
    assert {q: sorted(v) for q, v in got.items()} == want
    assert any(score is None for v in want.values() for _, _, score in v)


def test_repeated_query_rows(spark):
    rows = [(100, [2.0, 0.0]), (100, [1.0, 5.0]), (100, [1.0, 5.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(3)
        found = topk.exact_top_k(df, df.where("vec_id = 100"), 10)
        assert sorted(map(tuple, found.collect())) == [(100, 1, 2, 5 * 1024**2), (100, 2, 1, 1024**2)]


def test_dropping_candidates_changes_nothing():
    rng = np.random.default_rng(3)
    vectors = (rng.normal(0, 1, (3000, 64)) * np.geomspace(500, 1, 64)).astype(np.int64)
    ids = np.arange(3000)
    found = list(topk.block_top([5, 9], vectors[[5, 9]], ids, vectors, 10))
    for q in (5, 9):
        scores = vectors @ vectors[q]
        best = [i for i in np.lexsort((ids, -scores)) if i != q][:10]
        assert [(i, s) for p, i, s in found if p == q] == [(i, scores[i]) for i in best]
    floors = np.array([float(found[9][2]), np.nan])          # of the tenth; a floor drops no tie with it
    assert list(topk.block_top([5, 9], vectors[[5, 9]], ids, vectors, 10, floors)) == found


def words_of(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[k:k + window]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if owners := windows.get(tuple(words[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= {str(i) for i in owners if i is not None}
        out.append((doc, len(words), len(hit), len(found), bool(hit)))
    return sorted(out, key=repr)


def corpus():
    rng = np.random.default_rng(12)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "naïve", "X9"]
    def text(n):
        return " ".join(rng.choice(vocabulary, n))
    items = [(k, text(25)) for k in range(20)] + [(50, "short one"), (51, "Été"), (52, None), (53, "..."), (None, text(12)), (54, text(25))]
    items += [(60, items[3][1]), (3, items[3][1])]
    docs = [(k, text(120)) for k in range(40)]
    docs += [(100 + k, f"{text(30)}, {items[k][1].upper() if items[k][1].isascii() else items[k][1]}! {text(20)}") for k in range(20)]
    docs += [(200, " ".join(items[4][1].split()[:10])), (201, " ".join(items[4][1].split()[:9])), (202, None), (203, ""), (204, "?!"),
             (205, "a short, ONE"), (None, items[5][1]), (206, items[-3][1]), (206, items[-3][1]), (207, "w1 " * 50_000)]
    return docs, items


@pytest.mark.parametrize("limit", [50_000, 0])
def test_contamination_equals_brute_force(spark, make, monkeypatch, limit):
    """With the broadcast and beyond its bound."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    docs, items = corpus()
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, hash int")
    found = decontaminate.contamination(make(docs, extra="hash"), benchmark)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found.collect()), key=repr)
    assert got == brute_hits(docs, items)


def test_contamination_without_items_or_documents(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.contamination(make([(1, "a b"), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in found) == [(1, 2, 0, False), (2, 0, 0, False)]
    one = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(make([]), one).count() == 0


def test_contamination_runs_no_python(spark, make):
    one = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = decontaminate.contamination(make([(1, "a b")]), one)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
