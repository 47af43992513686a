from __future__ import annotations

import importlib
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from demandgrid.llm import neardup
from tests.llm.conftest import DOCS, words


@pytest.fixture
def folder(spark, tmp_path, docs_frame):
    def build(rows, items, labels):
        docs_frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return build


def test_each_decision_takes_effect(spark, folder):
    item = " ".join(words(900, 25))
    rows, labels = [], []
    for i in range(400):
        text = words(i, 60)
        if i % 8 == 0:
            text[5], text[20] = "vilest", "dunce"
        if i % 8 == 1:
            text = words(i - i % 64, 60)  # copies of one document in eight
        if i % 8 == 2:
            text[30:30] = item.split()
        rows.append((i, " ".join(text), "en", f"s{i % 3}"))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 8 == 0)))
    sf_dir = folder(rows, [(1, item)], labels)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    ids = Counter(r["doc_id"] for r in out)
    copies = {}
    for i in range(400):
        if i % 8 == 1:
            copies.setdefault(i - i % 64, []).append(i)
    gone = {i for i in range(400) if i % 8 in (0, 2)} | {i for g in copies.values() for i in g[1:]}
    assert not gone & set(ids)
    assert max(ids.values()) <= 3 and set(r["shard"] for r in out) <= set(range(24))
    kept = [r for r in rows if r[0] not in gone]
    left = {s: sum(len(t.split()) for _, t, _, x in kept if x == s) for s in ("s0", "s1", "s2")}
    total = sum(left.values())
    taken = Counter()
    for r in out:
        taken[r["source"]] += len(r["text"].split())
    for s, w in zip(("s0", "s1", "s2"), (5, 2, 1), strict=True):
        assert abs(taken[s] - total * w / 8) <= 60  # no source reaches three times its size here
    for s in range(24):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_stages_keep_the_columns(spark, folder, odd_rows):
    sf_dir = folder(odd_rows, [(1, "nothing of the kind is in there")], [(4, 1, 0)])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        assert docs.dtypes == [tuple(c.split()) for c in DOCS.split(", ")], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder([], [], [])).count() == 0


def test_registered():
    importlib.reload(contract)
    names = contract.queries()
    assert "pipeline" in names and [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13
    assert neardup.SIMILARITY == 0.8 and neardup.SHINGLE == 5
