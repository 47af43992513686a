from __future__ import annotations

import hashlib

import numpy as np

from demandgrid.llm.fingerprints import as_strings, edited, fingerprint_edits, fingerprints, likeness, phrases
from tests.llm.conftest import words


def one(texts):
    return fingerprints(texts)


def test_equal_texts_equal_fingerprints_whatever_stands_beside_them():
    texts = [" ".join(words(i, 40 + 13 * i)) for i in range(8)] + ["", "a", "ab", "aaaa", "aaaaa"]
    together = as_strings(*one(texts))
    alone = [as_strings(*one([t]))[0] for t in texts]
    assert together == alone
    assert len(set(together)) == len(texts)


def test_labels_never_tie_and_phrases_are_short():
    text = "".join(words(3, 5_000))
    names = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    first = np.zeros(len(names), bool)
    first[0] = True
    found, _ = phrases(names, first)
    assert len(names) / 12 < len(found) < len(names) / 2


def test_equal_substrings_share_interior_names():
    shared = " ".join(words(4, 200))
    levels = []
    for lead in ("", "x", "quite another start of a text "):
        names = np.frombuffer((lead + shared).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        first = np.zeros(len(names), bool)
        first[0] = True
        names, first = phrases(names, first)
        names, first = phrases(names, first)
        levels.append(set(names.tolist()))
    assert len(levels[0] & levels[1] & levels[2]) > 0.9 * len(levels[0])


def test_likeness():
    a, b = " ".join(words(5, 800)), " ".join(words(6, 800))
    half = a[: len(a) // 2] + b[: len(a) // 2]
    near = likeness(one([a, a, a, ""]), one([a, half, b, ""]))
    assert near[0] == 1 and near[3] == 1
    assert 0.3 < near[1] < 0.7 and near[2] < 0.15


def test_query_against_plain_loop(spark, docs_frame):
    rows = [(i * 7 % 101, " ".join(words(i, i % 30))) for i in range(101)]
    got = {r["doc_id"]: r for r in fingerprint_edits(docs_frame(rows)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        new = edited(text, follow)
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        sides = [one([t]) for t in (text, new, follow)]
        assert [got[i]["fingerprint"], got[i]["edited_fingerprint"]] == [as_strings(*s)[0] for s in sides[:2]]
        assert [got[i]["near_edited"], got[i]["near_next"]] == [likeness(sides[0], s)[0] for s in sides[1:]]


def test_odd_rows(odd_docs, odd_rows, no_docs, docs_frame):
    got = fingerprint_edits(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert sorted(r["n_chars"] for r in got) == sorted(len(t or "") for _, t, *_ in odd_rows)
    assert fingerprint_edits(no_docs).count() == 0
    only = fingerprint_edits(docs_frame([(1, "abcd")])).collect()
    assert only[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
