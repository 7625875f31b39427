import hashlib
import re
import textwrap
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexisift.llm import license_scan, pii, secret_scan

EMPTY = hashlib.sha256(b"").hexdigest()


def plain_secrets(text):
    """The patterns as they are defined, one kind after the other."""
    found = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def plain_personal(text):
    found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    def luhn(digits):
        odd = [int(c) for c in digits[::-1]]
        return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(odd)) % 10 == 0
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["token", "SECRET", "api_key", "apikey", "Passwd", "password", ":", "=", " ", '"', "'",
                                 "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef0123", "f", "ſecret", "é", ".", "\n"]),
                max_size=14))
def test_secret_patterns(parts):
    text = "".join(parts)
    assert secret_scan.pattern_spans(text) == plain_secrets(text)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", "@", ".", "-", "_", "+", "+1", " ", "(", ")", "1", "25", "256", "4111 1111 1111 1111",
                                 "4111-1111", "192.168.0.1", "é", "x@y.de", "://", "0", "\n", "%"]), max_size=16))
def test_personal_base_kinds(parts):
    text = "".join(parts)
    assert [s for s in pii.find_spans(text) if s[0] < 4] == plain_personal(text)


def test_personal_extra_kinds_and_leading_zeros():
    text = "see ftp://me:pw@host.org/x, IBAN: DE89 3704 0044 0532 0130 00 and account no: 12345678; ip 0000000000001.1.1.1"
    found = [(pii.KINDS[k], text[s:e]) for k, s, e in pii.find_spans(text) if k != 2]
    assert ("url", "ftp://me:pw@host.org") in found and ("account", "12345678") in found
    assert ("account", "DE89 3704 0044 0532 0130 00") in found and ("ip", "0000000000001.1.1.1") in found
    assert pii.find_spans("IBAN: DE89 3704 0044 0532 0130 01, https://host.org/a account of many") == []


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_scans_on_odd_rows(make):
    long = "x" * 300_000 + " a@b.org " + "1" * 5_000
    docs = make([(1, None), (2, ""), (None, "a@b.org"), (3, long), (3, long)], extra="spans")
    assert rows(pii.scan_personal(docs), "doc_id", "n_email", "spans") == sorted(
        [(1, 0, ""), (2, 0, ""), (None, 1, "email:0:7"), (3, 1, "email:300001:300008"), (3, 1, "email:300001:300008")], key=repr)
    assert {r.base_sha256 for r in pii.scan_personal(docs).where("doc_id < 3").collect()} == {EMPTY}
    assert rows(secret_scan.scan_secrets(docs), "doc_id", "n_hex", "n_markov") == sorted(
        [(1, 0, 0), (2, 0, 0), (None, 0, 0), (3, 1, 0), (3, 1, 0)], key=repr)
    none = make([])
    assert pii.scan_personal(none).count() == secret_scan.scan_secrets(none).count() == 0


def test_markov_model_finds_random_strings_only(make):
    rng = np.random.default_rng(1)
    letters = list(string.ascii_letters + string.digits)
    words = ["internationalization", "compute_average_value", "responsibilities", "characteristically", "getUserAccountName"]
    rows_ = [(k, f"token={''.join(rng.choice(letters, 32))} and {words[k % 5]} with {words[(k + 1) % 5]}") for k in range(200)]
    secret = "".join(rng.choice(letters, 40))
    rows_.append((900, f"{' '.join(words)} then {secret} ends"))
    ratios = secret_scan.train(make(rows_[:200]))
    found = {r.doc_id: r for r in secret_scan.scan_secrets(make(rows_), ratios).collect()}
    start = rows_[-1][1].index(secret)
    assert found[900].spans == f"markov:{start}:{start + 40}"
    assert all(found[k].n_markov == 0 and found[k].n_assign == 1 for k in range(200))


def test_wrapped_and_embedded_licenses(make):
    """Notices are found however their lines are broken, and among other words."""
    words = ["ordinary", "text", "about", "nothing", "public", "version", "work", "file", "license", "holder"]
    rng = np.random.default_rng(3)
    def some(n):
        return " ".join(rng.choice(words, n))
    notices = [(f, t) for f, texts in license_scan.TEMPLATES.items() for t in texts]
    docs, expected = [(k, f"{some(12)}\n{some(12)}") for k in range(100)], {}
    for k, (family, t) in enumerate(notices):
        for kind, (text, line) in enumerate([
                (f"{some(9)}\n\n{textwrap.fill(t, 30)}\n\n{some(9)}", 2),
                ("x = 1\n#\n" + textwrap.indent(textwrap.fill(t, 72), "# "), 2),
                ("/*\n" + textwrap.indent(textwrap.fill(t, 72), " * ", lambda _: True) + "\n */\n" + some(5), 1),
                (f"{some(8)}\n{some(20)} {t} {some(20)}", 1), (f"{some(300)} {t} {some(200)}", 0)]):
            docs.append((1000 + 10 * k + kind, text))
            expected[docs[-1][0]] = (1, family, f"{family}:{line}")
    broken = license_scan.TEMPLATES["bsd"][0].split()        # no half of it is a notice
    docs.append((5000, " ".join(broken[:11]) + "\n\n" + " ".join(broken[11:])))
    docs.append((5001, "Licensed under the MIT License.\nLicensed under the MIT License.\nLicensed under CC BY 4.0."))
    found = {r.doc_id: (r.n_license, r.families, r.lines) for r in license_scan.scan_licenses(make(docs)).collect()}
    assert {k: found[k] for k in expected} == expected
    assert all(found[k][0] == 0 for k in [*range(100), 5000])
    assert found[5001] == (3, "cc-by,mit", "mit:0,mit:1,cc-by:2")


def test_licenses(make):
    words = ["ordinary", "text", "about", "nothing", "public", "version", "work", "file", "license", "holder"]
    rng = np.random.default_rng(2)
    other = [" ".join(rng.choice(words, 12)) for _ in range(150)]
    rows_ = [(k, f"{other[k]}\n{other[-k - 1]}") for k in range(100)]
    rows_ += [(1000 + k, f"{other[k % 150]}\n{t}\n{other[(k + 1) % 150]}") for k, t in enumerate(
        t for texts in license_scan.TEMPLATES.values() for t in texts)]
    rows_ += [(300, None), (301, ""), (None, "Released under the MIT License."), (302, " \n,.\n")]
    found = license_scan.scan_licenses(make(rows_)).collect()
    assert len(found) == len(rows_)
    expected = [f for f, texts in license_scan.TEMPLATES.items() for _ in texts]
    got = {r.doc_id: r for r in found}
    assert [got[1000 + k].families for k in range(len(expected))] == expected
    assert all(got[1000 + k].lines == f"{f}:1" for k, f in enumerate(expected))
    assert [got[k].n_license for k in [*range(100), 300, 301, 302]] == [0] * 103
    assert got[None].families == "mit"
    assert license_scan.scan_licenses(make([])).count() == 0


@pytest.fixture(scope="module")
def licenses(make):
    """A classifier trained next to plain text that uses some of the words of licenses."""
    words = ["ordinary", "text", "about", "nothing", "public", "version", "work", "file", "license", "holder", "under", "the", "of"]
    rng = np.random.default_rng(7)
    docs = [(k, "\n".join(" ".join(rng.choice(words, 40)) for _ in range(5))) for k in range(400)]
    return license_scan.train(make(docs)), words


UNSEEN = [
    ("mit", "This module is distributed under the terms of the MIT licence, see the file COPYING."),
    ("apache", "// SPDX-License-Identifier: Apache-2.0"), ("gpl", "/* SPDX-License-Identifier: GPL-2.0-only */"),
    ("gpl", "The tool is available under the GNU General Public License version 3 or later."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE"),
    ("lgpl", "You may use this library; it is licensed under the GNU Lesser General Public License, version 2.1 only."),
    ("mpl", "All code in this folder is released under the Mozilla Public License 2.0 unless noted."),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "Photos by their authors. This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this data."),
    ("bsd", "Code: Copyright 2010. Redistribution and use in source or binary forms, with or without modification, are permitted "
            "provided that these conditions are met"),
]


def test_notices_that_were_not_in_training(licenses):
    """Other wording, lost words, other text around: nine in ten are found, and nothing else."""
    classifier, words = licenses
    for family, text in UNSEEN:
        assert [f for f, _, _ in license_scan.license_spans(text, classifier)] == [family], text
    rng = np.random.default_rng(11)
    hits = total = 0
    for family, texts in license_scan.TEMPLATES.items():
        for t in texts:
            kept = t.split()
            if len(kept) >= 6:
                kept = [w for w in kept if rng.random() > 0.05]
            around = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(2)]
            found = license_scan.license_spans(f"{around[0]} {' '.join(kept)} {around[1]}", classifier)
            total += 1
            hits += [f for f, _, _ in found] == [family]
    assert hits >= 0.9 * total
    plain = [" ".join(rng.choice(words, 200)) for _ in range(300)] + [
        "Her driving license was renewed under the new law.", "the terms of the agreement and the public work of the holder",
        "MIT is a university. Apache is a helicopter. The mozilla was a lizard."]
    assert sum(bool(license_scan.license_spans(t, classifier)) for t in plain) <= 3


def test_windows_equal_one_by_one(licenses, monkeypatch):
    """All windows of all paragraphs, each scored by itself."""
    classifier, words = licenses
    rng = np.random.default_rng(13)
    notices = [t for texts in license_scan.TEMPLATES.values() for t in texts]
    texts = ["", "one", "\n\n", "two words"] + ["\n".join(
        " ".join(rng.choice(words, rng.integers(0, 30))) + (" " + notices[rng.integers(len(notices))] if rng.random() < 0.3 else "")
        for _ in range(12)) for _ in range(12)]
    for block in (license_scan.BLOCK, 10):
        monkeypatch.setattr(license_scan, "BLOCK", block)
        for text in texts:
            found, _, parts = license_scan._paragraphs(text)
            hashes, expected = license_scan._word_hashes(found), []
            for low, high in ((np.flatnonzero(parts == p)[0], np.flatnonzero(parts == p)[-1] + 1) for p in np.unique(parts)):
                for size, step in license_scan.SIZES:
                    for at in range(low, high, step):
                        end = min(at + size, high)
                        chances = classifier.probabilities(found[at:end])
                        if 1 - chances[-1] > classifier.least:
                            expected.append((int(chances[:-1].argmax()), at, end))
            assert sorted(classifier.windows(hashes, parts)) == sorted(expected)
