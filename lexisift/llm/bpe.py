"""Byte-level BPE ids of many texts, with the vocabulary files that are installed.

Pieces between single spaces are encoded once per worker and remembered, as words repeat.
Whatever the split could change (runs of white space, special strings) goes to the
tokenizer as a whole text, so ids always equal those of the tokenizer file.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 8_000_000       # bytes of text that are cut into pieces at a time
REMEMBERED = 1_000_000  # pieces (about 150 bytes each) that a worker remembers before it starts anew


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Number of each piece; a new one is encoded when it is first asked for.

    With the byte length of every id, many new pieces are encoded as one text and cut apart
    where the bytes of each end.
    """

    def __init__(self, piece: Callable[[str], list[int]], sizes: np.ndarray | None = None):
        super().__init__()
        self.piece, self.sizes = piece, sizes
        self.starts, self.lengths, self.ids = array("q"), array("q"), array("I")

    @staticmethod
    def alone(text: str) -> bool:
        """A piece that touches other white space cannot stand alone."""
        return bool(text) and not text[0].isspace() and not text[-1].isspace()

    def __missing__(self, text: str) -> int:
        ids = self.piece(" " + text) if self.alone(text) else None
        self.starts.append(len(self.ids))
        self.lengths.append(-1 if ids is None else len(ids))
        self.ids.extend(ids or ())
        number = self[text] = len(self)
        return number

    def learn(self, texts: Iterable[str]) -> None:
        """Encode all pieces that are not known yet."""
        new = [t for t in texts if t not in self and self.alone(t)]
        if self.sizes is None or not new:
            return
        ids = np.array(self.piece(" " + " ".join(new)), np.uint32)
        ends = np.cumsum(pc.binary_length(pa.array(new, pa.large_string())).to_numpy() + 1)
        reached = self.sizes[ids].cumsum()
        cuts = np.searchsorted(reached, ends)
        if cuts[-1] >= len(ids) or (reached[cuts] != ends).any():
            return                          # some id lies across two pieces: one by one, when asked for
        cuts = np.concatenate([[0], cuts + 1])
        low, base = len(self), len(self.ids)
        self.starts.frombytes((cuts[:-1] + base).astype(np.int64).tobytes())
        self.lengths.frombytes(np.diff(cuts).astype(np.int64).tobytes())
        self.ids.frombytes(ids.tobytes())
        self.update(zip(new, range(low, low + len(new))))


class PieceEncoder:
    """Ids of texts under one tokenizer file.

    The same vocabulary as ranks, if it lies beside the file, encodes single pieces
    faster; without it the tokenizer itself does.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = vocabulary.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.piece = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                           special_tokens={}).encode_ordinary
            self.sizes = np.zeros(max(table.values()) + 1, np.int64)
            for token, rank in table.items():
                self.sizes[rank] = len(token)
        else:
            self.piece, self.sizes = self.whole, None
        self.known = _Pieces(self.piece, self.sizes)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text as unsigned 32-bit integers."""
        pieces = text.split(" ")
        if len(pieces) < 3 or (pieces[0] and pieces[0][-1].isspace()) or any(s in text for s in self.special):
            return np.array(self.whole(text) if any(s in text for s in self.special) else self.piece(text), np.uint32)
        first, last, middle = pieces[0], pieces[-1], pieces[1:-1]
        if len(self.known) > REMEMBERED:
            self.known = _Pieces(self.piece, self.sizes)
        known = self.known
        at = np.fromiter(map(known.__getitem__, middle), np.int64, len(middle))
        lengths = np.frombuffer(known.lengths, np.int64)[at]
        if lengths.min() < 0:
            return np.array(self.piece(text), np.uint32)
        starts, ends = np.frombuffer(known.starts, np.int64)[at], lengths.cumsum()
        inner = np.frombuffer(known.ids, np.uint32)[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]
        head = self.piece(first) if first else []
        return np.concatenate([np.array(head, np.uint32), inner, np.array(self.piece(" " + last), np.uint32)])


    def encode_many(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, ends)`` of runs of texts: their ids one after the other, and where each text ends.

        The same ids as from ``encode``, text by text. Pieces are cut and numbered by Arrow, so
        Python sees each distinct piece of a run once. Null texts count as empty.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes, low = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while low < len(texts):
            before = sizes[low - 1] if low else 0
            high = max(int(np.searchsorted(sizes, before + CHUNK, "right")), low + 1)
            yield self._encode_run(texts.slice(low, high - low))
            low = high

    def _encode_run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.split_pattern(texts, " ")
        counts, values = cut.value_lengths().to_numpy().astype(np.int64), cut.flatten().dictionary_encode()
        last = np.cumsum(counts) - 1
        first = last - counts + 1
        if len(self.known) > REMEMBERED:
            self.known = _Pieces(self.piece, self.sizes)
        spelled = values.dictionary.to_numpy(zero_copy_only=False)
        self.known.learn(spelled)
        numbers = np.fromiter(map(self.known.__getitem__, spelled), np.int64, len(spelled))
        places = values.indices.to_numpy()
        at = numbers[places]
        starts, lengths = (np.frombuffer(a, np.int64)[at] for a in (self.known.starts, self.known.lengths))
        known = len(self.known.ids)
        own, added = [], known          # ids of what is not between two single blanks

        def put(place: int, ids) -> None:
            nonlocal added
            starts[place], lengths[place] = added, len(ids)
            own.append(np.array(ids, np.uint32))
            added += len(ids)
        special = np.zeros(len(texts), bool)
        for name in self.special:
            special |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        # A piece that touches other white space, but for the outer ones, needs the whole text.
        inner = lengths < 0
        inner[first] = inner[last] = False
        touching = np.add.reduceat(inner, first) > 0 if len(first) else np.zeros(0, bool)
        for k, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
            head = spelled[places[a]]
            if special[k] or touching[k] or b - a < 2 or (head and head[-1].isspace()):
                text = texts[k].as_py()
                lengths[a:b + 1] = 0
                put(a, self.whole(text) if special[k] else self.piece(text))
                continue
            put(a, self.piece(head) if head else ())
            if lengths[b] < 0:
                put(b, self.piece(" " + spelled[places[b]]))
        ends = lengths.cumsum()
        ids = np.concatenate([np.frombuffer(self.known.ids, np.uint32, known), *own]) if own else np.zeros(0, np.uint32)
        total = int(ends[-1]) if len(ends) else 0
        # Half the memory traffic where positions fit into 32 bits.
        kind = np.int32 if max(total, len(ids)) < 2**31 else np.int64
        shift = (starts - ends + lengths).astype(kind)
        return ids[np.repeat(shift, lengths) + np.arange(total, dtype=kind)], ends[last]


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> PieceEncoder:
    """One encoder per worker and vocabulary file."""
    return PieceEncoder(vocabulary)
