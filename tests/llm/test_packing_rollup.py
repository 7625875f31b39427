import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexisift.llm import packing
from lexisift.llm.bpe import PieceEncoder
from lexisift.llm.token_rollup import Rollup, changes
from lexisift.session import shared_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)
ENCODER = PieceEncoder(VOCABULARY)


def ids_of(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([" ", " ", " ", "  ", "\n", "\t", " ", "word", "don't", "'s", "é", "12", "...", "<|endoftext|>",
                                 "\x1c", "日本", "A", "-", "\r\n", " ", "😀"]), max_size=16))
def test_ids_equal_the_tokenizer(parts):
    text = "".join(parts)
    assert ENCODER.encode(text).tolist() == ids_of(text)


PARTS = [" ", " ", " ", "  ", "\n", "\t", " ", "word", "don't", "'s", "é", "12", "...", "<|endoftext|>", "\x1c", "日本", "A", "-", "\r\n",
         "\u2003", "😀"]


@settings(max_examples=700, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=6), st.sampled_from([1, 20, 10**6]))
def test_ids_of_many_texts_equal_the_tokenizer(texts, chunk):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("lexisift.llm.bpe.CHUNK", chunk)
        found = []
        for ids, ends in ENCODER.encode_many(pa.array(texts, pa.string())):
            found += [part.tolist() for part in np.split(ids, ends[:-1])]
            assert ends[-1] == len(ids)
    assert found == [ids_of(t or "") for t in texts]


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr("lexisift.llm.bpe.REMEMBERED", 20)
    small = PieceEncoder(VOCABULARY)
    for k in range(30):
        text = " ".join(f"w{k * 7 + j}" for j in range(15))
        assert small.encode(text).tolist() == ids_of(text)
        assert next(small.encode_many(pa.array([text])))[0].tolist() == ids_of(text)
        assert len(small.known) <= 20 + 17         # and those of one text
    text = " ".join(f"v{j}" for j in range(50))       # more pieces than are remembered
    assert small.encode(text).tolist() == ids_of(text)


def check(docs, pieces, length=1024):
    """Every id in one piece, sequences gapless, nothing padded beyond powers of two."""
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append(ids_of(text or "") + [0])
    sequences = defaultdict(list)
    covered = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        covered[p.doc_id].append(p)
    for doc_id, versions in texts.items():
        ids = versions[0]
        own = sorted(covered.pop(doc_id), key=lambda p: (p.start, p.sequence_id))
        assert sum(p.length for p in own) == sum(map(len, versions))
        if len(versions) == 1:
            at = 0
            for p in own:
                assert p.start == at and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
                at += p.length
    assert not covered
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or at & (at - 1) == 0 and at < length
    return sequences


def test_round_trip(make, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TAILS", 20)
    rng = np.random.default_rng(4)
    docs = [(k, " ".join(f"t{k % 7}w{j}" for j in rng.integers(0, 60, rng.integers(1, 900)))) for k in range(90)]
    docs += [(200, None), (201, ""), (202, "<|endoftext|> x"), (203, "long " * 30_000), (204, "same"), (204, "same"), (None, "no id")]
    pieces = packing.pack(make(docs, extra="tail")).collect()
    sequences = check(docs, pieces)
    shards = len({s >> 32 for s in sequences})
    assert sum(sum(n for _, n in parts) < 1024 for parts in sequences.values()) <= 10 * shards
    assert packing.pack(make([])).count() == 0


def test_neighbours_share_words():
    """A window is filled with the tails that BM25 ranks first among those unused."""
    rng = np.random.default_rng(6)
    tails = [rng.integers(100 * (k % 5), 100 * (k % 5) + 100, 200).astype(np.uint32) for k in range(40)]
    df = np.bincount(np.concatenate([np.unique(t) for t in tails]), minlength=600)
    weights = np.maximum(0, np.log((40 - df + 0.5) / (df + 0.5)))
    index = packing.Index(tails, weights, 200.0)
    for seed in (0, 7, 23):
        tf = [np.bincount(t, minlength=600) for t in tails]
        plain = [sum(weights[t] * f[t] * 2.2 / (f[t] + 1.2) for t in np.unique(tails[seed]) if f[t]) for f in tf]
        assert np.allclose(index.scores(seed), plain)
    windows = packing.fill(tails, weights, 200.0, 1024)
    full = [w for w in windows if sum(x[2] for x in w) == 1024]
    alike = np.mean([len({x[0] % 5 for x in w}) == 1 for w in full[:4]])
    assert alike >= 0.5


def test_places_are_the_winners_of_the_races():
    rng = np.random.default_rng(12)
    weights = np.maximum(0, rng.normal(1, 1, 300))
    described = [np.unique(rng.integers(0, 300, n), return_counts=True) for n in (50, 1, 200, 7)]
    described += [(np.zeros(0, np.int64), np.zeros(0, np.int64)), (np.flatnonzero(weights == 0)[:3], np.ones(3, np.int64))]
    race = packing.races(weights)
    got = packing.places(described, race, 60.0)
    for (terms, tf), place in zip(described, got, strict=True):
        won = np.frombuffer(place, ">u4").astype(int)
        for k in range(packing.HASHES):
            values = {t: race[k][t] / (n * 2.2 / (n + 1.2 * (0.25 + 0.75 * tf.sum() / 60.0))) for t, n in zip(terms, tf)}
            best = min(values, key=values.get, default=None)
            assert won[k] == (best + 1 if best is not None and np.isfinite(values[best]) else 0)


def test_statistics_are_of_whole_documents(make, monkeypatch):
    """Frequencies, mean length and terms include what stands in full windows."""
    docs = [(1, "alpha " * 40 + "omega"), (2, "beta " * 30), (3, "alpha beta"), (4, None)]
    seen, counted = [], {}
    index = packing.Index
    def spied(tails, weights, mean, described=None):
        seen.append((weights, mean, [dict(zip(t.tolist(), n.tolist(), strict=True)) for t, n in described], tails))
        return index(tails, weights, mean, described)
    monkeypatch.setattr(packing, "Index", spied)
    rows = [ids_of(t or "") + [0] for _, t in docs]
    for row in rows:
        for token in set(row):
            counted[token] = counted.get(token, 0) + 1
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs], "text": pa.array([t for _, t in docs], pa.string())})
    made = list(packing._tokenized(VOCABULARY, 16)([batch]))
    df = next(packing._frequencies(iter(made))).to_pydict()
    assert dict(zip(df["token"], df["df"], strict=True)) == counted
    packing._packed(np.ones(60_000), 20.0, 16).one(0, pa.Table.from_batches(made))
    assert seen[0][2] == [dict(Counter(r)) for r in rows]
    assert [len(t) for t in seen[0][3]] == [len(r) % 16 for r in rows]


def test_like_documents_share_shards_at_any_size(make, monkeypatch):
    """Documents of one topic meet in a shard although there are many shards."""
    monkeypatch.setattr(packing, "SHARD_TAILS", 40)
    rng = np.random.default_rng(8)
    docs = [(k, " ".join(f"topic{k % 60}word{j}" for j in rng.integers(0, 12, 80))) for k in range(1200)]
    where = {p.doc_id: p.sequence_id >> 32 for p in packing.pack(make(docs)).collect()}
    assert len(set(where.values())) >= 20
    shared = np.mean([where[k] == where[j] for k in range(60) for j in range(k + 60, 1200, 60)])
    assert shared > 0.3           # about 1 in 30 if they were dealt out by a hash


def totals(rollup, names):
    return {(r.source, r.lang): (r.documents, r.tokens, r.characters) for r in rollup.totals(names).collect()}


def test_rollup_follows_inserts_deletes_and_revisions(spark, make):
    docs = [(1, "one two", "en", "a"), (2, "three", "en", "a"), (3, None, None, None), (4, "vier fünf", "de", "b"), (4, "vier fünf", "de", "b")]
    rollup = Rollup(spark, shared_folder(spark, "rollup"))
    def count(*texts):
        return len(texts), sum(len(ids_of(t or "")) for t in texts), sum(len(t or "") for t in texts)
    assert rollup.commit("load", changes(make(docs), 1, "v"))
    loaded = {("a", "en"): count("one two", "three"), (None, None): count(None), ("b", "de"): count("vier fünf", "vier fünf")}
    assert totals(rollup, ["load"]) == loaded
    assert not rollup.commit("load", changes(make(docs), 1, "v"))
    assert totals(rollup, ["load"]) == loaded
    gone = changes(make(docs[3:]), -1, "v")
    new = changes(make([(1, "one two three", "en", "a")]), 1, "v")
    rollup.commit("next", gone.unionByName(changes(make(docs[:1]), -1, "v")).unionByName(new))
    assert totals(rollup, ["load", "next"]) == {("a", "en"): count("one two three", "three"), (None, None): count(None)}
    assert totals(rollup, ["load", "never"]) == loaded
    assert rollup.totals([]).count() == 0
    rollup.commit("empty", changes(make([]), 1, "v"))
    assert totals(rollup, ["load", "empty"]) == loaded


def test_unfinished_batches_are_not_read(spark, make, tmp_path):
    rollup = Rollup(spark, str(tmp_path))
    rollup.commit("a", changes(make([(1, "x", "en", "s")]), 1, "v"))
    (tmp_path / "a" / "_SUCCESS").unlink()
    assert rollup.totals(["a"]).count() == 0
    assert rollup.commit("a", changes(make([(1, "x", "en", "s")]), 1, "v"))
    assert totals(rollup, ["a"]) == {("s", "en"): (1, 1, 1)}


def test_registered_rollup_equals_a_recount(spark):
    import os
    import re
    from pathlib import Path

    import pyarrow.parquet as pq

    from lexisift.llm.queries import op9_token_rollup
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(folder).exists():
        pytest.skip("no test tables")
    seen, expected = set(), defaultdict(lambda: [0, 0, 0])
    for r in sorted(pq.read_table(f"{folder}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"]):
        if r["text"] is not None and r["text"] in seen:
            continue
        seen.add(r["text"])
        text = re.sub(r"[ \t]*\n\s*", "\n", r["text"] or "", flags=re.ASCII)
        for k, n in enumerate((1, len(ids_of(text)), len(text))):
            expected[r["source"], r["lang"]][k] += n
    found = {(r.source, r.lang): [r.documents, r.tokens, r.characters] for r in op9_token_rollup(spark, folder).collect()}
    assert found == dict(expected)
