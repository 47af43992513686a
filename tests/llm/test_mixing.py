from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from demandgrid.llm.mixing import mix_plan, mix_rows
from tests.llm.conftest import DOCS, words


def shared(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by the rule as it is stated: share by weight, cut at three times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                target[s] = most * sizes[s]
                open_.remove(s)
    return target


@pytest.mark.parametrize("sources", [{"a": 300, "b": 20, "c": 40}, {"a": 1, "b": 300, "c": 5, "d": 4, None: 90}, {"z": 7}])
def test_targets_and_taken(docs_frame, sources):
    rows, i = [], 0
    for s, n in sources.items():
        for _ in range(n):
            rows.append((i, " ".join(words(i, 400 if i % 50 == 3 else 1 + i % 9)), "en", s))  # a few are huge
            i += 1
    got = mix_plan(docs_frame(rows)).collect()
    sizes = Counter()
    for _, text, _, s in rows:
        sizes[s] += len(text.split())
    want, taken = shared(sizes), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sources:
        left = want[s] - taken[s]
        own = [r for r in got if r["source"] == s]
        unused = [r["size"] for r in own if r["copies"] == min(x["copies"] for x in own)]
        assert -1e-6 <= left and (left <= 0.002 * want[s] or left < min(unused))
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix_plan(docs_frame(rows)).collect()))


def test_rows_follow_the_plan(docs_frame):
    rows = [(i, " ".join(words(i, 3)), "en", "ab"[i % 7 == 0]) for i in range(200)]
    plan = {r["doc_id"]: r["copies"] for r in mix_plan(docs_frame(rows)).collect()}
    out = Counter(r["doc_id"] for r in mix_rows(docs_frame(rows)).collect())
    assert out == {k: n for k, n in plan.items() if n}


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = mix_plan(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert {r["taken"] for r in got if r["size"] == 0} == {0}
    assert mix_rows(odd_docs).columns == odd_docs.columns
    assert mix_rows(odd_docs).count() == sum(r["copies"] for r in got)
    assert mix_plan(no_docs).count() == 0 and mix_rows(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "s", 0)], DOCS)
    assert {(r["target"], r["taken"]) for r in mix_plan(empty).collect()} == {(0.0, 0)}
