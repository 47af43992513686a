from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandgrid.llm import fim


def plainly(doc_id, text):
    """One text, cut and joined as strings."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_against_plain_strings_and_round_trip(spark, docs_frame, odd_rows):
    r = random.Random(3)
    alphabet = ["a", "Z", "bc", " ", "\n", "é", "🙂", "<", ">", "P", "S", "M", "<P", "P>", "<S", "1", "\x00", "中"]
    rows = odd_rows + [(100 + i, "".join(r.choice(alphabet) for _ in range(r.randrange(60)))) for i in range(600)]
    rows += [(1000, "x <P> y"), (1001, "<M>"), (1002, "<S"), (1003, "S>"), (1004, "ab " * 700_000)]
    docs = docs_frame(rows).repartition(3)
    got = fim.restore(fim.fill_in_middle(docs)).collect()
    want = sorted(((r[0], *plainly(r[0], r[1]), r[1] or "") for r in rows), key=str)
    assert sorted(((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output, x.restored) for x in got), key=str) == want
    assert {x.form for x in got} == {"plain", "psm", "spm"}


def test_pieces_and_segments_change_nothing(monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice("ab é🙂.") for _ in range(r.randrange(40))) for _ in range(200)]
    data, offsets = fim.pack(pa.array(texts))
    draws = np.array([[r.randrange(2**32) for _ in range(4)] for _ in texts])
    whole = fim.transform(data, offsets, draws)
    monkeypatch.setattr(fim, "SEGMENT", 7)
    again = fim.transform(data, offsets, draws)
    assert all((a == b).all() for a, b in zip(whole, again, strict=True))
    back, ends, lost = fim.invert(again[4], again[5], again[1])
    assert not lost.any() and fim.unpack(back, ends).to_pylist() == texts
    monkeypatch.setattr(fim, "PIECE", 50)
    assert [i for a, b in fim.pieces(offsets) for i in range(a, b)] == list(range(len(texts)))


def test_outputs_without_their_marks_are_not_restored(spark):
    rows = [(1, "psm", "<P>a<S>c<M>b"), (2, "psm", "<S>a<P>c<M>b"), (3, "spm", "<S>c<P>a<M>b"), (4, "psm", "a"), (5, "plain", "<P>"), (6, "psm", None), (7, None, "t"), (8, "psm", "x<P>a<S>c<M>b")]
    got = fim.restore(spark.createDataFrame(rows, "doc_id bigint, form string, output string").withColumn("restored", F.lit(1)))
    assert {r.doc_id: r.restored for r in got.collect()} == {1: "abc", 2: None, 3: "abc", 4: None, 5: "<P>", 6: None, 7: "t", 8: None}


@pytest.mark.parametrize("name", ["odd_docs", "no_docs"])
def test_other_columns_and_empty_tables(request, name):
    docs = request.getfixturevalue(name)
    assert fim.restore(fim.fill_in_middle(docs)).count() == docs.count()
