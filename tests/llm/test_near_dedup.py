import random
from itertools import combinations

import numpy as np
import pytest

from lexisift.llm import near_dedup
from lexisift.llm.components import connected_components
from lexisift.llm.hashing import shingle_set


def brute_force(rows, size, percent=80):
    """Components by comparing every pair of plain shingle sets."""
    def shingles(text):
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split(" ")
        words = [w for w in words if w]
        width = min(size, len(words))
        return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if words else set()
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for base in range(12):
        words = rng.choices(vocabulary, k=60)
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [" ".join(passage + rng.choices(vocabulary, k=90)) for _ in range(80)]     # a common passage
    rows += ["", "one two three", "ONE two  three", None, "x", "x"]
    return list(enumerate(rows))


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force(make):
    rows = corpus()
    for size in (4, 5):
        assert result(near_dedup.near_duplicates(make(rows), size)) == brute_force(rows, size)


def test_branching_and_blocks_lose_nothing(make, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "SALTED", 3)
    monkeypatch.setattr(near_dedup, "DEPTH", 3)
    monkeypatch.setattr(near_dedup, "TRIED", 1)
    rows = corpus()
    assert result(near_dedup.near_duplicates(make(rows), 4)) == brute_force(rows, 4)


def test_odd_rows(make):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (3, None), (4, ""), (5, " \n\t")]
    found = near_dedup.near_duplicates(make(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found if r.doc_id is not None) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]
    assert near_dedup.near_duplicates(make([])).count() == 0


def test_repeated_ids_with_other_texts(make):
    """All texts of an id belong to one component, and each links by its own words."""
    rng = random.Random(11)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(1000)}" for _ in range(40)) for x in "abcd")
    rows = [(1, a), (1, b), (2, a + " word"), (3, b + " word"), (4, c), (5, c + " word"), (6, d), (7, d), (7, c), (9, "x"), (9, "")]
    found = near_dedup.near_duplicates(make(rows), 4)
    assert sorted({(r.doc_id, r.component_id) for r in found.collect()}) == [
        (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4), (7, 4), (9, 9)]
    assert found.count() == len(rows)


@pytest.mark.parametrize("percent", [50, 65, 95, 100])
def test_other_similarities(make, percent):
    rng = random.Random(percent)
    rows = corpus()
    for _ in range(40):                  # pairs just above and below
        words = [f"p{rng.randrange(10**6)}" for _ in range(103)]
        cut = int(100 * 2 * percent / (100 + percent)) + rng.randrange(-2, 4)
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:cut] + [f"q{rng.randrange(10**6)}" for _ in range(103 - cut)]))]
    assert result(near_dedup.near_duplicates(make(rows), 4, percent)) == brute_force(rows, 4, percent)


def test_trees_and_misses_follow_the_similarity(make):
    assert (near_dedup.trees_for(80), near_dedup.misses_for(80)) == (12, 73)
    assert near_dedup.trees_for(50) > 100 and near_dedup.trees_for(100) == 1 and near_dedup.misses_for(100) == 0
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(make([(1, "a")]), 4, 49)


def test_words_are_ascii_lowered_and_split_at_ascii_space():
    assert len(shingle_set("A b c\x0bd", 4)) == 1
    assert np.array_equal(shingle_set("É x", 4), shingle_set("É X", 4))
    assert not np.array_equal(shingle_set("É x", 4), shingle_set("é x", 4))
    assert len(shingle_set("y " * 300_000, 4)) == 1


def test_leaf_links_connect_what_is_linked():
    base = np.arange(100, dtype=np.int64)
    sets = [base, base[:90], base[:80], base + 1000]
    assert near_dedup.links_between(np.array([1, 2, 3, 4]), sets, 80) == [(1, 2), (1, 3)]
    assert near_dedup.links_between(np.array([5, 5, 9]), sets[:3], 80) == [(5, 9)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (7, 7), (4, 1), (None, 3)] + [(100 + k, 101 + k) for k in range(40)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 12: 10} | {100 + k: 100 for k in range(41)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
