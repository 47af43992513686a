from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.llm import repeats
from tests.llm.conftest import words


def plain(texts: list[bytes], window: int) -> list[tuple]:
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + gone, strict=False))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(docs, texts, **options):
    got = {r["doc_id"]: r for r in repeats.find_repeats(docs, **options).collect()}
    for i, want in enumerate(plain([t.encode() for t in texts], options.get("window", repeats.WINDOW))):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, (i, texts[i][:80])


def test_small_window_against_counting(docs_frame):
    """Few letters: many partial, overlapping, nested and periodic repeats."""
    r = random.Random(5)
    base = ["".join(r.choice("ab") for _ in range(n)) for n in (0, 3, 19, 20, 21, 60, 200, 200, 35)]
    base += ["a" * 50, "ab" * 40, base[6][30:110] + base[7][60:90], base[5], base[5], "é" * 30, "xé" * 30]
    compare(docs_frame(list(enumerate(base))), base, window=20, reach=9, width=4)


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(docs_frame, seed):
    r = random.Random(seed)
    passages = [" ".join(words(seed * 100 + k, 60 + 30 * k)) for k in range(4)]
    texts = []
    for i in range(40):
        parts = [" ".join(words(1_000 * seed + i, r.randrange(150)))]
        parts += [r.choice(passages)[r.randrange(40) :] for _ in range(r.randrange(3))]
        r.shuffle(parts)
        texts.append(" ".join(parts))
    texts += [texts[0], texts[1][:-1], "x" * 1_000, "x" * 399, "x" * 400]
    compare(docs_frame(list(enumerate(texts))), texts)


def test_segments_change_nothing(docs_frame, monkeypatch):
    text = " ".join(words(9, 300))
    texts = [text, "y" + text, text[200:], text + text]
    rows = [list(repeats.sheaves(t.encode(), 400, 257)) for t in texts]
    monkeypatch.setattr(repeats, "SEGMENT", 150)
    assert [len(x) for x in rows] != [len(list(repeats.sheaves(t.encode(), 400, 257))) for t in texts]
    compare(docs_frame(list(enumerate(texts))), texts)


def test_a_pass_against_counting(spark):
    """Runs over many ranges, one value that fills several of them, and rows that count more than once."""
    r = random.Random(8)
    rows = [(r.randrange(40), r.choice([b"a", b"b"]), k, 1) for k in range(60)] + [(7, b"hot", k, 1) for k in range(400)]
    rows += [(100 + k, b"", k, 1 + k % 2) for k in range(10)] + [(-5, b"first", 1, 1), (999, b"last", 1, 1)]
    df = spark.createDataFrame(rows, "a bigint, b binary, tie bigint, n bigint").repartition(3)
    counts = Counter()
    for a, b, _, n in rows:
        counts[a, b] += n
    want = sorted((a, bytes(b), t, n) for a, b, t, n in rows if counts[a, b] > 1)
    got = repeats.radix_pass(df, ["a", "b"], ["tie"], df.columns, "test")
    assert sorted((x.a, bytes(x.b), x.tie, x.n) for x in got.collect()) == want
    every = repeats.radix_pass(df, ["a", "b"], ["tie"], df.columns, "test", drop=False).collect()
    assert len(every) == len(rows) and {(x.a, bytes(x.b)) for x in every if x.repeated} == {k for k, n in counts.items() if n > 1}
    assert sorted((x.a, bytes(x.b)) for x in every if x.leader) == sorted(counts)
    assert repeats.radix_pass(df.limit(0), ["a", "b"], ["tie"], df.columns, "test").count() == 0


def test_a_hot_digit_is_spread(spark):
    hot = spark.range(8_000).select(F.lit(3).cast("bigint").alias("a"), F.col("id").alias("tie"))
    hot = hot.unionByName(spark.range(800).select((F.col("id") + 10).alias("a"), F.col("id").alias("tie")))
    kept = repeats.radix_pass(hot, ["a"], ["tie"], ["a", "tie"], "test")
    sizes = [x["n"] for x in kept.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    laid = hot.repartitionByRange(4, "a", "tie").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert sum(sizes) == 8_000 and max(x["n"] for x in laid) <= 2 * 8_800 / 4


def test_anchor_is_the_first_smallest():
    data = np.frombuffer(" ".join(words(3, 300)).encode(), np.uint8)
    at = repeats.anchors(data, 400, 257)
    assert len(at) == len(data) - 399
    assert ((at >= np.arange(len(at))) & (at < np.arange(len(at)) + 257)).all()


def test_odd_rows(odd_docs, odd_rows, no_docs):
    got = repeats.find_repeats(odd_docs).collect()
    texts = [(r[1] or "").encode() for r in odd_rows]
    want = sorted(zip((str(r[0]) for r in odd_rows), plain(texts, 400), strict=True))
    assert sorted((str(r["doc_id"]), (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == want
    assert repeats.find_repeats(no_docs).count() == 0
