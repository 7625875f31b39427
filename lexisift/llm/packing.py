"""Packing documents into training sequences by lexical retrieval.

Full windows of a long document are cut off as they are. What is left of each document,
its tail, goes to a shard of tails with like content, which keeps a BM25 inverted index of its documents: each is
described by all of its token ids, those of the full windows included, and document
frequencies and the mean length are those of all whole documents. Each sequence starts
from a seed tail and is filled with its best unused neighbours; the last one is cut where
the window ends and its rest seeds the next sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.llm.bpe import default_vocabulary, encoder
from lexisift.llm.tables import blocks_for
from lexisift.session import durable

LENGTH = 1024
END_ID = 0
SHARD_TAILS = 1_000     # tails of one shard, up to half as many again
HASHES = 8              # weighted minwise terms that place a tail
SPLITS = 1 << 14        # ranges of the placed tails at most; each is cut into shards
K1, B = 1.2, 0.75       # BM25
TAILS = "doc_id long, doc_tokens long, whole array<long>, tail binary, terms binary, tfs binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenized(vocabulary: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_many
        for batch in batches:
            tokens, whole, tails, terms, tfs = [], [], [], [], []
            for flat, ends in encode(batch.column("text")):
                # With the closing id behind each text.
                flat = np.insert(flat.astype("<u4"), ends, END_ID)
                ends = ends + np.arange(1, len(ends) + 1)
                for low, high in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
                    ids, cut = flat[low:high], (high - low) // length * length
                    tokens.append(len(ids))
                    whole.append([_crc(ids[k:k + length]) for k in range(0, cut, length)])
                    tails.append(ids[cut:].tobytes())
                    # A document without full windows is its tail, from which its terms follow.
                    term, tf = _counted(ids) if cut else (None, None)
                    terms.append(term.astype("<u4").tobytes() if cut else None)
                    tfs.append(tf.astype("<u4").tobytes() if cut else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "doc_tokens": pa.array(tokens, pa.int64()),
                "whole": pa.array(whole, pa.list_(pa.int64())), "tail": pa.array(tails, pa.binary()),
                "terms": pa.array(terms, pa.binary()), "tfs": pa.array(tfs, pa.binary())})
    return run


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and their counts; a little faster than ``np.unique``."""
    ids = np.sort(ids)
    at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])[:len(ids)])
    return ids[at], np.diff(at, append=len(ids))


def _terms(tail: bytes, terms: bytes | None, tfs: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of the whole document and how often each stands in it."""
    if terms is None:
        return _counted(np.frombuffer(tail, "<u4"))
    return np.frombuffer(terms, "<u4"), np.frombuffer(tfs, "<u4").astype(np.int64)


def _described(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for values in zip(*(batch.column(name) for name in ("tail", "terms", "tfs")), strict=True):
        yield _terms(*(v.as_py() for v in values))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for ids, _ in _described(batch):
            if len(ids) and ids[-1] >= len(counts):
                counts = np.concatenate([counts, np.zeros(int(ids[-1]) + 1 - len(counts), np.int64)])
            counts[ids] += 1
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"token": pa.array(found, pa.int64()), "df": pa.array(counts[found], pa.int64())})


class Index:
    """BM25 inverted index of the documents of one shard.

    ``described`` has the distinct ids and their counts of each whole document; without it
    the tails are whole documents.
    """

    def __init__(self, tails: list[np.ndarray], weights: np.ndarray, mean: float,
                 described: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.terms, docs, tfs = [], [], []
        for at, (terms, tf) in enumerate(described or [np.unique(t, return_counts=True) for t in tails]):
            size = tf.sum()
            useful = weights[terms] > 0     # a term in half of all documents adds nothing
            terms, tf = terms[useful], tf[useful]
            self.terms.append(terms)
            docs.append(np.full(len(terms), at))
            tfs.append(tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean)) * weights[terms])
        flat = np.concatenate(self.terms)
        order = np.argsort(flat, kind="stable")
        self.docs, self.weights = np.concatenate(docs)[order], np.concatenate(tfs)[order]
        # Where each of the document's terms has its postings.
        low, high = np.searchsorted(flat[order], flat), np.searchsorted(flat[order], flat, "right")
        ends = np.cumsum([len(t) for t in self.terms])
        self.places = [(low[e - len(t):e], high[e - len(t):e]) for t, e in zip(self.terms, ends, strict=True)]
        self.size = len(tails)

    def scores(self, seed: int) -> np.ndarray:
        low, high = self.places[seed]
        if not len(low):
            return np.zeros(self.size)
        spans = high - low
        ends = spans.cumsum()
        at = np.repeat(low - ends + spans, spans) + np.arange(ends[-1])
        return np.bincount(self.docs[at], self.weights[at], self.size)


def fill(tails: list[np.ndarray], weights: np.ndarray, mean: float, length: int,
         described: list[tuple[np.ndarray, np.ndarray]] | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(tail, start in it, length)``, all full but the last, smaller ones.

    What is left at the end is cut into powers of two, which need no padding.
    """
    index = Index(tails, weights, mean, described)
    unused = np.array([len(t) > 0 for t in tails])
    starts = np.zeros(len(tails), np.int64)
    sequences, current = [], None
    following = iter(np.argsort([-len(t) for t in tails], kind="stable"))
    while True:
        if current is None:
            current = next((t for t in following if unused[t]), None)
            if current is None:
                break
            unused[current] = False
        room, window = length, []
        scores = None
        while current is not None:
            left = len(tails[current]) - starts[current]
            take = int(min(left, room))
            window.append((int(current), int(starts[current]), take))
            starts[current] += take
            room -= take
            if left > take:
                break                       # its rest seeds the next sequence
            seed = window[0][0]
            current = None
            if room and unused.any():
                if scores is None:
                    scores = index.scores(seed)
                current = int(np.where(unused, scores, -1.0).argmax())
                unused[current] = False
            if not room:
                break
        sequences.append(window)
    if sequences and (left := sum(x[2] for x in sequences[-1])) < length:
        window, powers = sequences.pop(), [1 << k for k in reversed(range(left.bit_length())) if left >> k & 1]
        for power in powers:
            piece = []
            while power:
                tail, start, n = window.pop(0)
                take = min(n, power)
                piece.append((tail, start, take))
                power -= take
                if n > take:
                    window.insert(0, (tail, start + take, n - take))
            sequences.append(piece)
    return sequences


def races(weights: np.ndarray) -> np.ndarray:
    """For every hash and id the value that is divided by the id's weight in a document."""
    draws = np.random.default_rng(20).random((HASHES, len(weights)))
    return np.where(weights > 0, -np.log1p(-draws) / np.maximum(weights, 1e-12), np.inf)


def places(described: list[tuple[np.ndarray, np.ndarray]], race: np.ndarray, mean: float) -> list[bytes]:
    """For each document the ids that win under each hash, so that documents alike in BM25 weight sort together.

    Two documents share an entry with the likeness of their weighted terms as probability;
    later entries split what shares the earlier ones.
    """
    sizes = np.array([len(terms) for terms, _ in described])
    if not sizes.sum():
        return [bytes(4 * HASHES)] * len(described)
    terms, tf = (np.concatenate([d[i] for d in described]) for i in (0, 1))
    starts = np.cumsum(sizes) - sizes
    full = sizes > 0
    lengths = np.zeros(len(sizes))
    lengths[full] = np.add.reduceat(tf, starts[full])
    gain = tf * (K1 + 1) / (tf + K1 * (1 - B + B * np.repeat(lengths, sizes) / mean))
    won = np.zeros((len(described), HASHES), ">u4")
    for k in range(HASHES):
        values = race[k][terms] / gain
        least = np.minimum.reduceat(values, starts[full])
        hit = np.flatnonzero(values == np.repeat(least, sizes[full]))
        # The first of equals; nothing wins where no term has a weight.
        owner = np.searchsorted(starts[full], hit, "right") - 1
        first = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]
        won[full, k] = np.where(np.isfinite(least), terms[first].astype(np.int64) + 1, 0)
    return [row.tobytes() for row in won]


def _placed(weights: np.ndarray, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        race = races(weights)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                yield part.append_column("place", pa.array(places(list(_described(part)), race, mean), pa.binary()))
    return run


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in runs of ``SHARD_TAILS``, or evenly cut near the end."""
    held = None
    for batch in batches:
        more = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, more]) if held is not None else more
        while held.num_rows >= 2 * SHARD_TAILS:
            yield held.slice(0, SHARD_TAILS)
            held = held.slice(SHARD_TAILS)
    if held is not None and held.num_rows:
        cut = held.num_rows if held.num_rows <= 1.5 * SHARD_TAILS else held.num_rows // 2
        yield held.slice(0, cut)
        if cut < held.num_rows:
            yield held.slice(cut)


def _packed(weights: np.ndarray, mean: float, length: int):
    def one(shard: int, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending"), ("tail", "ascending")])
        tokens = table.column("doc_tokens").to_numpy()
        tails = [np.frombuffer(t.as_py(), "<u4") for t in table.column("tail")]
        rows, sequence = [], shard << 32
        for at, crcs in enumerate(table.column("whole")):
            for k, crc in enumerate(crcs.as_py()):
                rows.append((at, k * length, length, crc, sequence, 0))
                sequence += 1
        for window in fill(tails, weights, mean, length, list(_described(table))):
            offset = 0
            for at, start, n in window:
                begins = tokens[at] - len(tails[at]) + start
                rows.append((at, begins, n, _crc(tails[at][start:start + n]), sequence, offset))
                offset += n
            sequence += 1
        at, start, n, crc, seq, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        return pa.table({"doc_id": table.column("doc_id").take(pa.array(at)), "start": start, "length": n,
                         "ids_crc32": crc, "doc_tokens": tokens[at], "sequence_id": seq, "offset": offset})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = TaskContext.get().partitionId()
        for number, table in enumerate(shards(batches)):
            yield from one(split << 17 | number, table).to_batches()
    run.one = one
    return run


def pack(documents: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's ids are those of its text and one closing id 0, so a null or empty text
    is that id alone. Each id lies in one piece. Sequences are full, but for a few per
    shard whose lengths are powers of two, so nothing is padded. Repeated rows and rows
    without ``doc_id`` are packed each; other columns are ignored; no documents give no rows.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tails = durable(rows.mapInArrow(_tokenized(vocabulary, length), TAILS), "tails")
    # At most one number per entry of the vocabulary reaches the driver.
    frequencies = tails.mapInArrow(_frequencies, "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))
    found = frequencies.toArrow()
    n, mean = tails.agg(F.count("*"), F.avg("doc_tokens")).first()
    token, df = found.column("token").to_numpy(), found.column("df").to_numpy()
    weights = np.zeros(int(token.max()) + 1 if len(token) else 1)
    weights[token] = np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))
    mean = max(float(mean or 1), 1.0)
    placed = tails.mapInArrow(_placed(weights, mean), f"{TAILS}, place binary")
    # What shares its place is dealt out by a hash, so a large group fills several ranges.
    order = ["place", F.xxhash64("doc_id", "tail", "whole")]
    ranges = placed.repartitionByRange(min(blocks_for(n, SHARD_TAILS), SPLITS), *order).sortWithinPartitions(*order)
    return ranges.drop("place").mapInArrow(_packed(weights, mean, length), PIECES)
