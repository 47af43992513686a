from __future__ import annotations

from collections import Counter

import numpy as np

from demandgrid.llm import neardup
from demandgrid.llm.components import connected_components
from tests.llm.conftest import words


def similarity(a: str, b: str) -> float:
    x, y = (Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (neardup.WORDS.findall(t.lower()) for t in (a, b)))
    return sum((x & y).values()) / sum((x | y).values())


def plain(rows) -> dict:
    """Classes and links by comparing all pairs of distinct texts."""
    low = {}
    for i, t in rows:
        low[t] = min(i, low.get(t, i))
    texts = [t for t in low if neardup.WORDS.search(t)]
    root = {n: n for n in low.values()}
    links = Counter()

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for k, a in enumerate(texts):
        for b in texts[:k]:
            if similarity(a, b) >= 0.8:
                links[low[a]] += 1
                links[low[b]] += 1
                x, y = find(low[a]), find(low[b])
                root[max(x, y)] = min(x, y)
    return {i: (find(low[t]), links[low[t]]) for i, t in rows}


def corpus() -> list[tuple[int, str]]:
    rows = [(i, " ".join(words(i, 30 + i))) for i in range(60)]
    base = words(500, 120)
    for k in range(60):  # around the limit: one to four words of 120 replaced
        other = list(base)
        for j in range(1 + k % 4):
            other[(k * 29 + j * 31) % 120] = f"new{k}x{j}"
        rows.append((100 + k, " ".join(other)))
    rows += [(300 + i, " ".join(base)) for i in range(30)] + [(400, " ".join(base).upper() + "!")]
    rows += [(410, "one"), (411, "One."), (412, "one two"), (413, "two one"), (414, "..."), (415, "...")]
    rows += [(420, "again and again and again and again and again"), (421, "again and again and again and again")]
    return rows


def test_against_all_pairs(docs_frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)  # clusters in several blocks
    rows = corpus()
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in neardup.near_classes(docs_frame(rows)).collect()}
    assert got == plain(rows)


def test_signatures_estimate_weighted_similarity():
    base = words(7, 400) + ["again", "and"] * 40
    other = base[:300] + words(8, 60) + base[360:]
    cell, counts = neardup.cells([" ".join(base), " ".join(other), " ".join(base[::-1]), ""])
    sign = neardup.dart_signatures(cell, counts)
    agree = (sign[0] == sign[1]).mean()
    assert abs(agree - similarity(" ".join(base), " ".join(other))) < 0.15
    assert (sign[0] == sign[2]).mean() < 0.1 and not sign[3].any() and sign[:3].all()
    alone = neardup.cells([" ".join(other)])
    assert (neardup.dart_signatures(*alone)[0] == sign[1]).all()


def test_one_of_each_class_stays(docs_frame):
    rows = corpus()
    kept = [r["doc_id"] for r in neardup.drop_near(docs_frame(rows)).collect()]
    assert sorted(kept) == sorted({c for c, _ in plain(rows).values()})


def test_an_id_with_two_texts_keeps_all_links(docs_frame):
    a, b = words(1, 60), words(2, 60)
    near = lambda t: " ".join(t[:-1] + ["changed"])
    docs = docs_frame([(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (1, " ".join(a)), (4, " ".join(words(3, 60)))])
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in neardup.near_classes(docs).collect())
    assert got == [(1, 1, 1)] * 3 + [(2, 1, 1), (3, 1, 1), (4, 4, 0)]
    assert sorted((r.doc_id, r.text) for r in neardup.drop_near(docs).collect()) == sorted([(1, " ".join(a)), (1, " ".join(b)), (4, " ".join(words(3, 60)))])


def chained(n):
    """Each text is like the next one, far ones are not alike, and the buckets' smallest reach a part of them only."""
    text, out = words(9, 100), []
    for k in range(n):
        out.append((k, " ".join(text)))
        text[(7 * k) % 100] = f"step{k}"
    return out


def test_clusters_that_stars_leave_in_parts(docs_frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 3_000)
    rows = chained(70)
    want = sorted({c for c, _ in plain(rows).values()})
    assert sorted(r["doc_id"] for r in neardup.drop_near(docs_frame(rows)).collect()) == want


def test_a_growing_cluster_moves_in_proportion(spark, docs_frame, monkeypatch):
    """Rows that are sent to be compared, when a group of near copies doubles."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    base, sent = words(500, 120), []
    for n in (60, 120):
        rows = [(k, " ".join(base[:k] + [f"new{k}"] + base[k + 1 :])) for k in range(n)]
        _, nodes = neardup._nodes(docs_frame(rows))
        stars = neardup._stars(nodes)
        links = neardup._star_links(docs_frame(rows), nodes, stars, 0.8)
        sent.append(links.count() / stars.count())  # about one row for each end of a star
        assert [r["doc_id"] for r in neardup.drop_near(docs_frame(rows)).collect()] == [0]
    assert sent[1] <= 1.3 * sent[0] and sent[1] < 1.5


def test_components(spark):
    chain = [(i, i + 1) for i in range(100)] + [(200, 201), (201, 202), (202, 200), (300, 300)] + [(400, k) for k in range(401, 450)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    want = dict.fromkeys(range(101), 0) | dict.fromkeys((200, 201, 202), 200) | dict.fromkeys(range(400, 450), 400)
    assert got == want
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_roots():
    root = neardup._roots(7, np.array([5, 3, 1]), np.array([3, 1, 4]))
    assert root.tolist() == [0, 1, 2, 1, 1, 1, 6]


def test_odd_rows(odd_docs, odd_rows, no_docs):
    got = neardup.near_classes(odd_docs).collect()
    assert len(got) == len(odd_rows)
    of = {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None}
    assert of[4] == of[6] == 4 and of[7] == of[8] == 7 and of[1] == 1 and of[10] == 10
    kept = neardup.drop_near(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 9, 10, 11, None, None]))
    assert neardup.near_classes(no_docs).count() == 0 and neardup.drop_near(no_docs).count() == 0
