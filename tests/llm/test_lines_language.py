import random

import pytest

from lexisift.llm import language
from lexisift.llm.line_dedup import dedup_lines


def brute_force(rows, least):
    """Lines in a run with enough words that stands at an earlier place as well."""
    docs = {i: (t.split("\n") if t is not None else []) for i, t in rows}
    seen, result = set(), {}
    for i in sorted(docs):
        lines, drop = docs[i], set()
        for a in range(len(lines)):
            words, here = 0, []
            for b in range(a, len(lines)):
                here.append(lines[b])
                words += len(lines[b].split())
                if words >= least:
                    if tuple(here) in seen:
                        drop |= set(range(a, b + 1))
                    result.setdefault("new", []).append(tuple(here))
            seen |= set(result.pop("new", []))
        result[i] = (len(lines), len(drop), None if rows_text(rows, i) is None else
                     "\n".join(x for k, x in enumerate(lines) if k not in drop))
    return result


def rows_text(rows, i):
    return next(t for j, t in rows if j == i)


def test_line_dedup_equals_brute_force(make):
    rng = random.Random(5)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randrange(0, 9))) for _ in range(30)]
    rows = [(k, "\n".join(rng.choices(lines[:10 + k], k=rng.randrange(1, 25)))) for k in range(60)]
    block = "\n".join(lines[20:28])
    rows += [(100 + k, f"own line {k}\n{block}\nlast {k}") for k in range(40)]
    rows += [(200, None), (201, ""), (202, "x " * 3000), (203, "x " * 3000)]
    for least in (1, 8, 20):
        found = {r.doc_id: (r.n_lines, r.n_deleted, r.text) for r in dedup_lines(make(rows), least).collect()}
        assert found == brute_force(rows, least)


def test_line_dedup_odd_rows(make):
    text = "\n".join(" ".join("abcdefghijkl") for _ in range(1)) + "\n" + "word " * 40
    docs = make([(1, text), (1, text), (None, text), (2, text), (3, None)], extra="runs")
    found = sorted(((r.doc_id, r.n_deleted, r.text) for r in dedup_lines(docs).collect()), key=repr)
    assert found == sorted([(1, 0, text), (1, 0, text), (None, 0, text), (2, 2, ""), (3, 0, None)], key=repr)
    assert dedup_lines(make([])).count() == 0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    parts = {"aa": ["the", "ing", "tion", "wh", "er"], "bb": ["schen", "ung", "keit", "ver", "ß"], "cc": ["eau", "oi", "tre", "é", "x"]}
    rows = []
    for k in range(400):
        name = ("aa", "aa", "bb", "cc")[k % 4]
        words = ["".join(rng.choices(parts[name], k=3)) for _ in range(60)]
        rows.append((k, " ".join(words), name))
    return rows


def test_language_accuracy_on_held_out_documents(make, texts):
    found = {r.doc_id: r for r in language.identify(make(texts)).collect()}
    held = [(found[i].lang_pred, name) for i, _, name in texts if found[i].held_out]
    assert len(held) > 80 and all(a == b for a, b in held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_labels_of_held_out_rows_are_not_learned(make, texts):
    import zlib
    spoiled = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else name) for i, t, name in texts]
    assert sorted(map(tuple, language.identify(make(spoiled)).collect())) == sorted(
        map(tuple, language.identify(make(texts)).collect()))


def test_clean_long_texts_are_not_rejected(make, texts):
    """The margin does not shrink with length."""
    encoders = language.Encoders(language.learn_dictionaries(make(texts)))
    prose = {n: " ".join(t for _, t, name in texts[200:] if name == n) for n in ("aa", "bb", "cc")}
    for name, once in prose.items():
        words = once.split()
        def text(size, seed):
            rng = random.Random(seed)
            return " ".join(rng.choices(words, k=size // 8))
        short, long = text(600_000, 1), text(3_000_000, 2)
        assert len(long) > 2_000_000
        (_, few, _), (found, many, rejected) = encoders.decide(short), encoders.decide(long)
        assert found == name and not rejected and abs(few - many) < 0.05
    assert b"".join(language.blocks(b"x" * 100_001)) == b"x" * 100_001
    assert max(map(len, language.blocks(b"x" * 100_001))) <= language.BLOCK


def test_language_odd_rows(make, texts):
    docs = make([*texts, (900, None), (901, ""), (902, "123 ²"), (None, texts[0][1]), (903, "é" * 200_000), (904, texts[2][1], None)])
    found = {r.doc_id: r for r in language.identify(docs).collect()}
    assert [found[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert all(found[k].rejected and found[k].score == 0 for k in (900, 901, 902))
    assert found[None].lang_pred == "aa" and found[None].held_out is None
    assert found[903].lang_pred in ("aa", "bb", "cc") and found[904].lang_pred == "bb"
    kept = language.known_language(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} & {900, 901, 902} == set()
    none = make([])
    assert language.identify(none).count() == language.known_language(none).count() == 0
    nothing = language.identify(make([(1, "some text", None)])).first()
    assert (nothing.lang_pred, nothing.rejected) == ("und", True)
