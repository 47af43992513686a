from __future__ import annotations

import re
from collections import Counter

import pytest

from demandgrid.llm import decontaminate
from tests.llm.conftest import words


def shingles(tokens: list[str]) -> Counter:
    return Counter(" ".join(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4)))


def weight(c: Counter) -> int:
    return sum(len(s) * n for s, n in c.items())


def plain(docs, items, limit=0.8) -> dict:
    """Best similarity of any item-sized window, over all windows."""
    found = {}
    for d, text in docs:
        have = re.findall(r"[^\W_]+", text.lower())
        for k, item in items:
            want = re.findall(r"[^\W_]+", item.lower())
            y, best = shingles(want), 0.0
            for start in range(max(1, len(have) - len(want) + 1) if want and have else 0):
                x = shingles(have[start : start + len(want)])
                best = max(best, weight(x & y) / weight(x | y))
            if best >= limit:
                found[d, k] = best
    return found


@pytest.fixture
def items_frame(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


def cases():
    items = [(k, " ".join(words(50 + k, n))) for k, n in enumerate((38, 38, 20, 59, 12, 6, 5, 3, 1))]
    items.append((20, items[0][1]))
    around = [" ".join(words(90 + i, 60)) for i in range(20)]
    one = items[0][1].split()
    docs = [(0, around[0]), (1, f"{around[1]} {items[0][1]} {around[2]}"), (2, items[3][1].upper().replace(" ", ", ")), (3, items[2][1][:-1])]
    docs += [(4, " ".join([*one[:1], "changed", *one[2:]])), (5, " ".join([*one[:20], "changed", *one[21:]]))]
    docs += [(6, f"{around[3]} {' '.join(one[:-1])}"), (7, f"{around[4]} {' '.join(one[:20])} put in {' '.join(one[20:])} {around[5]}")]
    docs += [(8, " ".join(t for _, t in items)), (9, f"{around[6]} {items[5][1]} {around[7]} {items[6][1]} {items[5][1]}")]
    docs += [(10, " ".join(one[2:36])), (11, ""), (12, "!!"), (13, f"{items[1][1]} {around[8]}"), (14, f"{items[1][1]} {around[8]}")]
    return docs, items


def test_against_all_windows(docs_frame, items_frame):
    docs, items = cases()
    got = {}
    for r in decontaminate.find_leaks(docs_frame(docs), items_frame(items)).collect():
        key = r["doc_id"], r["item_id"]
        got[key] = max(got.get(key, 0), r["similarity"])
        assert r["distance"] <= decontaminate.RADIUS
    assert got == pytest.approx(plain(docs, items))


def test_blocks_join_lined_up_pairs_only(spark, docs_frame, items_frame, monkeypatch):
    """Many items of one length, each in a document of its own: pairs grow with the documents, not with their square."""
    seen = {}
    plainly = decontaminate.near_pairs

    def counted(lined_up, windows, items):
        out = decontaminate.materialize(plainly(lined_up, windows, items), "test")
        seen.update(lined_up=lined_up.count(), near=out.count())
        return out

    monkeypatch.setattr(decontaminate, "near_pairs", counted)
    items = [(k, " ".join(words(700 + k, 15))) for k in range(60)]
    docs = [(k, f"{' '.join(words(k, 9))} {t} {' '.join(words(300 + k, 9))}") for k, t in items]
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs_frame(docs), items_frame(items)).collect()}
    assert got == {(k, k) for k in range(60)} and seen == {"lined_up": 60, "near": 60}


def test_items_of_many_words(docs_frame, items_frame):
    long = words(5, 10_000)
    docs = [(1, " ".join(["in", "front", *long, "behind"])), (2, " ".join(long[:7_000] + words(6, 3_000))), (3, " ".join(long[:9_500]))]
    again = ["one", "and", "the", "same"] * 2_000
    got = decontaminate.find_leaks(docs_frame([*docs, (4, " ".join(again))]), items_frame([(1, " ".join(long)), (2, " ".join(again[:-4]))]))
    found = {}
    for r in got.collect():
        found[r.doc_id, r.item_id] = max(found.get((r.doc_id, r.item_id), 0), r.similarity)
    assert found == {(1, 1): 1.0, (3, 1): pytest.approx(0.95, abs=0.01), (4, 2): 1.0}


def test_plan_is_native(spark, docs_frame, items_frame):
    docs, items = cases()
    plan = decontaminate.find_leaks(docs_frame(docs), items_frame(items))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_dropped_documents(docs_frame, items_frame):
    docs, items = cases()
    kept = {r["doc_id"] for r in decontaminate.drop_leaks(docs_frame(docs), items_frame(items)).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in plain(docs, items)}


def test_odd_rows(odd_docs, odd_rows, no_docs, items_frame):
    items = items_frame([(1, "a text without id"), (2, None), (3, ""), (4, "--"), (None, "ñ ÄÖ ñ")])
    got = decontaminate.find_leaks(odd_docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(None, 1), (10, None)}
    kept = decontaminate.drop_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows) - 3
    assert decontaminate.find_leaks(no_docs, items).count() == 0
    nothing = items_frame([])
    assert decontaminate.find_leaks(odd_docs, nothing).count() == 0
    assert decontaminate.drop_leaks(odd_docs, nothing).count() == len(odd_rows)
