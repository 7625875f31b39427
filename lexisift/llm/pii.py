"""Personal data by anchor expansion.

One Aho-Corasick pass finds at-signs, schemes, plus signs, digits and account cues.
From each anchor a local parser expands to the boundaries of an address, number or
account and validates it. Nothing but the surroundings of anchors is parsed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "url", "account")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte")   # followed by an account number

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_LOGIN = re.compile(r"[^\s/@:\"'<>]+:[^\s/@\"'<>]+@[A-Za-z0-9.-]+")
_ACCOUNT = re.compile(r"(?:\x20?(?:no|nr|number)\b\.?)?\x20?[:#]\x20?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}|[0-9]{8,18}(?![0-9]))",
                      re.ASCII)


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for mark in ("@", "+", "://", *"0123456789"):
        automaton.add_word(mark, mark if mark in "@+://" else "digit")
    for cue in CUES:
        for written in (cue, cue.capitalize(), cue.upper()):
            automaton.add_word(written, "cue")
    automaton.make_automaton()
    return automaton


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _iban(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of all personal data in a text."""
    found: list[tuple[int, int, int]] = []
    email_from = dotted_from = card_from = phone_from = 0
    for end, anchor in _anchors().iter(text):
        at = end - len(anchor) + 1 if anchor == "://" else end
        if anchor == "digit":
            if at >= dotted_from:
                dotted_from = _DOTTED.match(text, at).end()
                found += [(1, m.start(), m.end()) for m in _IP.finditer(text, at, dotted_from)
                          if all(map(_octet, m.groups()))]
            if at >= card_from:
                number = _CARD.match(text, at)
                card_from = number.end() if number else at + 1
                if number:
                    digits = re.sub(r"[\x20-]", "", number[0])
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        found.append((2, at, card_from))
        elif anchor == "@":
            start = at
            while start > email_from and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1)
            if start < at and domain:
                found.append((0, start, domain.end()))
                email_from = domain.end()
        elif anchor == "+":
            if at >= phone_from and (number := _PHONE.match(text, at)):
                phone_from = number.end()
                if 9 <= sum(c.isdigit() for c in number[0]) <= 15:
                    found.append((3, at, phone_from))
        elif anchor == "://":
            start = at
            while start > 0 and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (login := _LOGIN.match(text, at + 3)):
                found.append((4, start, login.end()))
        elif (number := _ACCOUNT.match(text, end + 1)) and (number[1][0].isdigit() or _iban(number[1])):
            found.append((5, number.start(1), number.end(1)))
    return sorted(found)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find_spans(v.as_py() or "") for v in batch.column("text")]
        base = [spelled([x for x in spans if x[0] < 4]) for spans in found]
        count = lambda k: pa.array([sum(x[0] == k for x in spans) for spans in found], pa.int64())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), **{f"n_{KINDS[k]}": count(k) for k in range(4)},
            "base_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
            "spans": pa.array([spelled(spans) for spans in found], pa.string()),
            "n_url": count(4), "n_account": count(5)})


def scan_personal(documents: DataFrame) -> DataFrame:
    """One row per document: counts per kind, a digest of the base spans, and all spans.

    ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_url, n_account``. Spans
    are ``kind:start:end`` in code points, end exclusive, by kind and then start. ``url``
    is an address that carries a login, ``account`` a number after an account cue, or a
    valid IBAN there. Null texts count as empty; repeated rows give a row each,
    rows without ``doc_id`` too; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                           "base_sha256 string, spans string, n_url long, n_account long")
