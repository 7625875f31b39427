import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexisift.llm import prefix_trie, queries
from lexisift.llm.prefix_trie import DoubleArray, ends_digests, prefix_nodes, sequences

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(paths):
    """``{conv_id: [(turn, words), ...]}`` to sorted rows, prefix by prefix."""
    members = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
    rows = []
    for node, convs in members.items():
        under = [m for m in members if m[:len(node)] == node]
        has_child = {m[:-1] for m in members if m}
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        rows.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                     sum(len(m) == len(node) + 1 for m in under), sum(m not in has_child for m in under),
                     sum((len(members[m]) - 1) * m[-1][1] for m in under if m),
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def random_paths(rng, n):
    paths = {}
    for conv in rng.sample(range(-50, 5 * n), n):
        path = [("hot", 3)] if rng.random() < 0.6 else []
        path += [(f"t{rng.randrange(3)}", rng.randrange(4)) for _ in range(rng.randrange(5))]
        if rng.random() < 0.3:
            path = [("hot", 3), ("t0", 1), ("t1", 2), ("t0", 1), ("t0", 1), ("t2", 7)]
        paths[conv] = path
    return paths


def as_frame(spark, paths):
    key = lambda t: hashlib.sha256(f"{t[0]} {t[1]}".encode()).digest()[:16]
    return spark.createDataFrame([(c, [(bytearray(key(t)), t[1]) for t in p], 1) for c, p in paths.items()],
                                 f"conv_id long, turns {prefix_trie.TURNS}, node int")


@pytest.mark.parametrize("shard_paths, batch_turns", [(4096, 50_000), (5, 10), (1, 1), (20, 50_000)])
def test_nodes_equal_plain_python(spark, shard_paths, batch_turns):
    paths = random_paths(random.Random(shard_paths), 250)
    got = prefix_nodes(as_frame(spark, paths), shard_paths, batch_turns)
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=repr) == plain_nodes(paths)
    assert got.select("node").distinct().count() == got.count()


def test_double_array_finds_paths_and_nothing_else():
    rng = random.Random(3)
    paths = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(6))) for _ in range(2000)})
    trie = DoubleArray(paths)
    prefixes = {p[:k] for p in paths for k in range(len(p) + 1)}
    assert len(trie.states) == len(prefixes)
    def walk(path):
        state = np.array([0])
        for turn in path:
            state = trie.step(state, np.array([turn]))
            if state[0] < 0:
                return None
        return int(state[0])
    slots = {walk(p) for p in prefixes}
    assert None not in slots and slots == set(trie.states.tolist())
    for path in list(prefixes)[:300]:
        for turn in (0, 17, 39, 40, 10**6):
            assert (walk((*path, turn)) is not None) == ((*path, turn) in prefixes)


def test_long_conversation(spark):
    paths = {1: [(f"t{k}", 1) for k in range(3000)], 2: [(f"t{k}", 1) for k in range(2000)], 3: []}
    rows = {(r.depth, r.conv_id): r for r in prefix_nodes(as_frame(spark, paths), shard_paths=1).collect()}
    assert len(rows) == 3001
    assert rows[0, 1].saved_tokens == 2000 and rows[0, 1].n_leaves == 1
    assert rows[2000, 1].n_convs == 2 and rows[2001, 1].n_convs == 1
    assert rows[2000, 1].ends_sha256 == hashlib.sha256(b"2").hexdigest()


def test_ids_of_many_members(spark, monkeypatch):
    members = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit(b"a")).otherwise(F.lit(b"b")).alias("node"),
                                         F.col("id").alias("conv_id"))
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 100)
    want = {b"a": ",".join(str(i) for i in range(20_000) if i % 3), b"b": ",".join(str(i) for i in range(0, 20_000, 3))}
    got = {bytes(r.node): r.ends_sha256 for r in ends_digests(members.repartition(7)).collect()}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_defined_cases(spark):
    schema = "conv_id long, turn long, role string, text string, key string, node int"
    rows = [(1, 1, "user", "b  c", "x", 1), (1, None, None, None, "x", 1), (1, 0, "user", "a", "x", 1),
            (2, 5, "user", "a", "x", 1), (2, 5, "user", "a", "x", 1), (None, 1, "user", "lost", "x", 1), (3, 0, "us", "era", "x", 1)]
    frame = spark.createDataFrame(rows, schema)
    got = {r.conv_id: [(bytes(t.key), t.words) for t in r.turns] for r in sequences(frame).collect()}
    assert {c: [w for _, w in t] for c, t in got.items()} == {1: [0, 1, 2], 2: [1, 1], 3: [1]}
    assert got[2][0] == got[2][1] == got[1][1] and got[3][0] != got[1][1]
    assert prefix_nodes(sequences(frame)).where("depth = 0").first().n_convs == 3
    empty = prefix_nodes(sequences(frame.limit(0)))
    assert empty.count() == 0 and empty.columns[1:] == COLUMNS
    odd = spark.createDataFrame([(None, []), (7, None)], f"conv_id long, turns {prefix_trie.TURNS}")
    assert [(r.conv_id, r.depth, r.n_leaves) for r in prefix_nodes(odd).collect()] == [(7, 0, 1)]


def test_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(9)
    original = {c: [(rng.choice(["user", "assistant"]), f"w{rng.randrange(3)} " * rng.randrange(4)) for _ in range(rng.randrange(1, 6))]
                for c in range(130) if c != 40}
    rows = [(c, t, *turn) for c, turns in original.items() for t, turn in enumerate(turns)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    paths = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = [((r, t), len(t.split())) for r, t in original.get(c - c % 20, [])[:h] + turns[h:]]
    assert any(not p for p in paths.values())
    got = queries.op13_prefix_trie(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=repr) == plain_nodes(paths)
