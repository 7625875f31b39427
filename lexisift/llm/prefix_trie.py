"""Prefix trie of conversations in double arrays.

A node is a distinct sequence of first turns; its members are the conversations that start with
it. Equal conversations are one path with a weight. Paths are dealt to shards by a prefix:
the shortest of 1, 2, 4, ... turns that at most ``shard_paths`` distinct paths share, so a
first turn that stands in a third of all conversations is split by what follows it. Every
task packs the paths of its shards into double arrays: turns get dense ids, state s has its child
by turn t in slot ``base[s] + t``, and ``check`` of that slot is s. Walking all paths through
the arrays gives the nodes and their aggregates.

A node at or below its shard's prefix is in that shard alone and complete. Those above
are shared: each shard reports its part and what its complete nodes add below them,
the parts are added up by node, and sums over subtrees go up along their (few) shared
ancestors. Nothing but the smallest id of all conversations passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisift.llm.tables import blocks_for, text_of
from lexisift.session import durable

KEY_BYTES = 16           # of the SHA-256 that stands for a turn or for a sequence of turns
SHARD_PATHS = 4_096      # distinct paths that may share the prefix of a shard
BATCH_TURNS = 50_000     # turns after which shards no longer share a double array
TASK_TURNS = 200_000     # turns of one task, about
PROBES = 64              # free slots tried for a state's children before they go behind the end
CHUNK_BYTES = 1 << 16    # listed ids that make one row on the way to a digest

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<key:binary,words:int>>"
_UNSET = np.iinfo(np.int64).min
_NODES = ("node binary, depth long, shared boolean, conv_id long, parent binary, parent_conv_id long, n_convs long, "
          "words long, n_children long, n_leaves long, saved_tokens long, ends boolean, above array<binary>")


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the turns of each conversation in order, as ``(key, words)``.

    Order is by ``turn``, null first, then by key. The key stands for role and text, null counting
    as empty; ``words`` are runs of characters other than ASCII white space. Rows without
    ``conv_id`` belong to no conversation; repeated rows are turns of their own. A
    conversation is one row of some 30 bytes a turn.
    """
    role, text = text_of("role"), text_of("text")
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), _digest(whole).alias("key"),
        F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "key", "words")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["key"], t["words"])).alias("turns"))


def _digest(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, KEY_BYTES)


def _prefix(depth: Column) -> Column:
    """The key of the first ``depth`` turns."""
    keys = F.transform(F.slice("turns", F.lit(1), depth), lambda t: F.hex(t["key"]))
    return _digest(F.unhex(F.array_join(keys, "")))


class DoubleArray:
    """A trie over paths of dense turn ids; ``base`` and ``check`` are indexed by state."""

    def __init__(self, paths: list[tuple[int, ...]]):
        """``paths`` are sorted and distinct. The root is state 0."""
        self.base, self.check, self.depth = [_UNSET], [-1], [0]
        self._used, self._low = bytearray(b"\1"), 1
        waiting = [(0, 0, len(paths), 0)]
        for state, low, high, depth in waiting:
            turns, starts = [], []
            for at in range(low, high):
                path = paths[at]
                if len(path) > depth and (not turns or path[depth] != turns[-1]):
                    turns.append(path[depth])
                    starts.append(at)
            if not turns:
                continue
            base = self._room(turns)
            self.base[state] = base
            for turn, start, end in zip(turns, starts, [*starts[1:], high]):
                slot = base + turn
                self._used[slot], self.check[slot], self.depth[slot] = 1, state, depth + 1
                waiting.append((slot, start, end, depth + 1))
        size = len(self.check)
        self.base, self.check, self.depth = (np.array(x, np.int64) for x in (self.base, self.check, self.depth))
        self.states = np.flatnonzero(np.frombuffer(self._used, np.uint8)[:size])

    def _room(self, turns: list[int]) -> int:
        """A base that puts all children into free slots: first fit, then behind the end."""
        self._low = slot = self._next(self._low)
        base, spread = None, turns[-1] - turns[0]
        for _ in range(PROBES):
            used = self._used
            if all(not used[i] for t in turns if (i := slot + t - turns[0]) < len(used)):
                base = slot - turns[0]
                break
            slot = self._next(slot + 1)
        if base is None:
            self._low, slot = slot, len(self._used)     # a crowded stretch is not looked at again
            base = slot - turns[0]
        more = slot + spread + 1 - len(self._used)
        if more > 0:
            self._used.extend(bytes(more))
            self.base.extend([_UNSET] * more)
            self.check.extend([-1] * more)
            self.depth.extend([-1] * more)
        return base

    def _next(self, slot: int) -> int:
        found = self._used.find(0, slot)
        return len(self._used) if found < 0 else found

    def step(self, states: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of states by turns; -1 where there is none."""
        slots = self.base[states] + turns
        inside = (self.base[states] != _UNSET) & (slots >= 0) & (slots < len(self.check))
        slots = np.where(inside, slots, 0)
        return np.where(inside & (self.check[slots] == states), slots, -1)


def _nodes(batch: pa.Table) -> pa.RecordBatch:
    """The nodes of a batch of paths ``(prefix_turns, n, first, turns)``."""
    turns = batch.column("turns").combine_chunks()
    if isinstance(turns, pa.ChunkedArray):
        turns = turns.chunk(0)
    lengths = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    items = turns.flatten()
    dense, keys = pd.factorize(np.array([*items.field("key").to_pylist(), None], object)[:-1])
    words = np.zeros(max(len(keys), 1), np.int64)
    words[dense] = items.field("words").to_numpy()
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    paths = [tuple(dense[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
    order = sorted(range(len(paths)), key=paths.__getitem__)
    trie = DoubleArray([paths[k] for k in order])

    size, states, base = len(trie.check), trie.states, trie.base
    weight, first, prefix = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "first", "prefix_turns"))
    n, smallest = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    shared, ends, turn = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, np.int64)
    rows, at, depth = np.arange(len(paths)), np.zeros(len(paths), np.int64), 0
    while len(rows):                                    # all paths, one turn at a time
        here = at[rows]
        np.add.at(n, here, weight[rows])
        np.minimum.at(smallest, here, first[rows])
        shared[here] |= depth < prefix[rows]
        ends[here[lengths[rows] == depth]] = True
        rows = rows[lengths[rows] > depth]
        taken = dense[cuts[rows] + depth]
        at[rows] = trie.step(at[rows], taken)
        turn[at[rows]] = taken
        depth += 1

    parent, level = trie.check, trie.depth
    children = np.bincount(parent[states[1:]], minlength=size)
    complete = np.bincount(parent[states[1:]], weights=~shared[states[1:]], minlength=size).astype(np.int64)
    last = np.where(level > 0, words[turn], 0)
    leaves = ((children == 0) & ~shared).astype(np.int64)
    saved = np.where(shared, 0, (n - 1) * last)
    down = states[np.argsort(-level[states], kind="stable")]
    for group in np.split(down, np.flatnonzero(np.diff(level[down])) + 1):
        group = group[~shared[group]]                  # what is below a shared node is added up later
        if len(group) and level[group[0]] > 0:
            np.add.at(leaves, parent[group], leaves[group])
            np.add.at(saved, parent[group], saved[group])

    names: list[bytes | None] = [None] * size
    names[0] = hashlib.sha256().digest()[:KEY_BYTES]
    stack, before = [hashlib.sha256()], ()
    trail = [0]
    for k in order:
        path, same = paths[k], 0
        while same < min(len(path), len(before)) and path[same] == before[same]:
            same += 1
        del stack[same + 1:], trail[same + 1:]
        for t in path[same:]:
            state, digest = int(base[trail[-1]]) + t, stack[-1].copy()
            digest.update(keys[t])
            names[state] = digest.digest()[:KEY_BYTES]
            stack.append(digest)
            trail.append(state)
        before = path

    def above(state: int) -> list[bytes]:
        found = []
        while (state := int(parent[state])) >= 0:
            found.append(names[state])
        return found

    top = shared[states] | ((level[states] > 0) & shared[parent[states]])     # with a shared parent, or shared
    up = [int(parent[s]) for s in states]
    return pa.RecordBatch.from_pydict({
        "node": pa.array([names[s] for s in states], pa.binary()), "depth": level[states], "shared": shared[states],
        "conv_id": smallest[states],
        "parent": pa.array([names[p] if t and p >= 0 else None for t, p in zip(top, up)], pa.binary()),
        "parent_conv_id": pa.array([None if t else int(smallest[p]) for t, p in zip(top, up)], pa.int64()),
        "n_convs": n[states], "words": last[states], "n_children": np.where(shared, complete, children)[states],
        "n_leaves": leaves[states], "saved_tokens": saved[states], "ends": ends[states],
        "above": pa.array([above(s) if shared[s] else None for s in states.tolist()], pa.list_(pa.binary()))})


def _tries(batch_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; shards are put together up to ``batch_turns``."""
        held, size, shard = [], 0, None
        for batch in batches:
            shards = batch.column("shard").to_pylist()
            lengths = batch.column("turns").value_lengths().to_pylist()
            low = 0
            for at, name in enumerate(shards):
                if name != shard and size >= batch_turns:
                    if at > low:
                        held.append(batch.slice(low, at - low))
                    yield _nodes(pa.Table.from_batches(held))
                    held, size, low = [], 0, at
                shard = name
                size += lengths[at] + 1
            if low < batch.num_rows:
                held.append(batch.slice(low))
        if held:
            yield _nodes(pa.Table.from_batches(held))
    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(node, conv_id)`` to comma-joined pieces ``(node, low, ids)``."""
    node, low, ids, size = None, None, [], 0
    def piece():
        return pa.RecordBatch.from_pydict({
            "node": pa.array([node], pa.binary()), "low": pa.array([low], pa.int64()), "ids": [",".join(ids)]})
    done: list[pa.RecordBatch] = []
    for batch in batches:
        for name, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (name != node or size >= CHUNK_BYTES):
                done.append(piece())
                ids, size = [], 0
                if len(done) >= 1000:
                    yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                    done = []
            if not ids:
                node, low = name, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        done.append(piece())
    if done:
        yield from pa.Table.from_batches(done).combine_chunks().to_batches()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest per node."""
    def rows(found):
        return pa.RecordBatch.from_pydict({"node": pa.array([f[0] for f in found], pa.binary()),
                                           "ends_sha256": [f[1].hexdigest() for f in found]})
    node, digest, found = None, None, []
    for batch in batches:
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if digest is not None and name == node:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                found.append((node, digest))
            node, digest = name, hashlib.sha256(ids.encode())
        if len(found) >= 10_000:
            yield rows(found)
            found = []
    if digest is not None:
        yield rows([*found, (node, digest)])


def ends_digests(members: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` from ``(node, conv_id)``: of the ids in ascending order, joined by commas.

    Ids are sorted by range, so a node with a third of them is joined by many tasks;
    one task then feeds its pieces, of some 64 KB each, to the digest as they come.
    """
    pieces = (members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInArrow(_chunks, "node binary, low long, ids string"))
    return (pieces.repartition("node").sortWithinPartitions("node", "low")
            .mapInArrow(_listed, "node binary, ends_sha256 string"))


def prefix_nodes(paths: DataFrame, shard_paths: int = SHARD_PATHS, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """One row per node of the trie over ``(conv_id, turns)``, each ``conv_id`` once.

    ``node`` (key of its turns), ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (that of the
    node without the last turn; null for the root), ``n_convs``, ``n_children``, ``n_leaves`` and
    ``saved_tokens`` (over the subtree, the node included: nodes without children, and members
    but one times words of the last turn) and ``ends_sha256`` (of the ids of members without further
    turns). A conversation without turns ends at the root; without conversations there
    is no node. Rows without ``conv_id`` take no part, null turns count as none; other
    columns are ignored.
    """
    taken = paths.where("conv_id is not null").select(
        "conv_id", F.coalesce("turns", F.array().cast(TURNS)).alias("turns"))
    members = durable(taken.withColumn("node", _prefix(F.size("turns"))), "paths")
    copies = members.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    depths = F.filter(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda k: F.pow(F.lit(2), k).cast("int")),
                      lambda d: d <= F.size("turns"))
    distinct = durable(
        copies.join(members.select(F.col("conv_id").alias("first"), "turns"), "first")
        .withColumn("levels", F.transform(depths, lambda d: F.struct(d.alias("prefix_turns"), _prefix(d).alias("shard")))),
        "distinct_paths")
    levels = distinct.select("node", F.explode("levels").alias("level"))
    crowded = durable(levels.groupBy(F.col("level.shard").alias("crowd")).agg(F.count(F.lit(1)).alias("paths"))
                      .where(F.col("paths") > shard_paths).select("crowd"), "crowded")
    placed = (levels.join(crowded, F.col("level.shard") == F.col("crowd"), "left_anti")
              .groupBy("node").agg(F.min("level").alias("level")))
    # A path that ends inside crowded prefixes is a shard of its own, and all of its nodes are shared.
    dealt = distinct.join(placed, "node", "left").select(
        F.coalesce("level.shard", "node").alias("shard"),
        F.coalesce("level.prefix_turns", F.size("turns") + 1).alias("prefix_turns"), "n", "first", "turns")
    total = distinct.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    found = durable(dealt.repartition(blocks_for(total, TASK_TURNS), "shard").sortWithinPartitions("shard")
                    .mapInArrow(_tries(batch_turns), _NODES), "trie")

    parts = found.where("shared").groupBy("node").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("above").alias("above"),
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), F.bool_or("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    shared = durable(parts, "shared")
    below = shared.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("more"))
    whole = shared.join(below, "node", "left").withColumn("n_children", F.expr("n_children + coalesce(more, 0)"))
    sums = (whole.select(F.explode(F.concat(F.array("node"), "above")).alias("node"),
                         F.expr("n_leaves + if(n_children = 0, 1, 0)").alias("l"),
                         F.expr("saved_tokens + (n_convs - 1) * words").alias("s"))
            .groupBy("node").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens")))
    upper = whole.drop("n_leaves", "saved_tokens").join(sums, "node")

    parents = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    smallest = shared.where("depth = 0").agg(F.min("conv_id")).first()[0]
    columns = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    # The children of the root are by far the most, and need no join.
    below_root = F.when(F.col("depth") == 1, F.lit(smallest).cast("long"))
    complete = found.where("not shared")
    nodes = (complete.where("parent is null").select(columns)
             .unionByName(complete.where("depth = 1").withColumn("parent_conv_id", below_root).select(columns))
             .unionByName(upper.where("depth <= 1").withColumn("parent_conv_id", below_root).select(columns)))
    for deeper in (complete.where("parent is not null and depth > 1").drop("parent_conv_id"), upper.where("depth > 1")):
        nodes = nodes.unionByName(deeper.join(parents, "parent").select(columns))
    ended = nodes.where("ends").join(ends_digests(members.select("node", "conv_id")), "node", "left")
    return (ended.unionByName(nodes.where("not ends").withColumn("ends_sha256", F.lit(EMPTY_SHA256)))
            .drop("ends"))
