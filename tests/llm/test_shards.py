from __future__ import annotations

import zlib
from collections import defaultdict

from demandgrid.llm.shards import shard_plan, shard_rows
from tests.llm.conftest import words


def check(plan, rows, n):
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in plan), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in plan:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(n))
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_balanced_and_gapless(docs_frame):
    rows = [(i, " ".join(words(i, 5 + i % 40))) for i in range(2_000)]
    sizes = check(shard_plan(docs_frame(rows), 7).collect(), rows, 7)
    mean = sum(sizes.values()) / 7
    assert len(sizes) == 7 and max(abs(v - mean) for v in sizes.values()) < 0.02 * mean


def plain(rows, n, whole=0.05):
    """Larger groups that fit go where most room is, the rest by prefix sums over all rows at once, in the order of CRC-32, hash
    (there are no two texts of one CRC-32 here) and id."""
    order = sorted((zlib.crc32(t.encode()), t, i) for i, t in rows)
    groups = defaultdict(list)
    for k, (_, t, _) in enumerate(order):
        groups[t].append(k)
    assert len(groups) == len({c for c, *_ in order})
    size = [len(t.encode()) + 8 for _, t, _ in order]
    total, used, shard, seen, out = sum(size), [0] * n, {}, defaultdict(int), {}
    held = {t: sum(size[k] for k in g) for t, g in groups.items()}
    large = [t for t in groups if len(groups[t]) > 1 and held[t] > whole * total / n]
    own = {}
    for t in sorted(large, key=lambda t: (-held[t], zlib.crc32(t.encode()))):
        s = used.index(min(used))
        if used[s] + held[t] <= total / n:
            used[s] += held[t]
            own[t] = s
    for t in sorted(own, key=lambda t: zlib.crc32(t.encode())):
        for k in groups[t]:
            out[order[k][2]] = (own[t], seen[own[t]])
            seen[own[t]] += 1
    cuts = [(s + 1) * total // n - sum(used[: s + 1]) for s in range(n - 1)]
    at = 0
    for t, g in groups.items():
        if t in own:
            continue
        for k in g:
            shard[k] = sum(2 * c <= 2 * at + (held[t] if t not in large else size[k]) for c in cuts) if t in large or k == g[0] else shard[g[0]]
            at += size[k] if t in large else 0
        at += held[t] if t not in large else 0
    for k in sorted(shard):
        out[order[k][2]] = (shard[k], seen[shard[k]])
        seen[shard[k]] += 1
    return sorted((i, *v) for i, v in out.items())


def test_against_prefix_sums(docs_frame):
    rows = [(i, " ".join(words(i % 250, 1 + i % 60))) for i in range(700)] + [(1_000 + i, "copied very often") for i in range(400)]
    rows += [(2_000 + i, "a group that one shard can hold " * 2) for i in range(40)] + [(3_000 + i, "and so can one hold this") for i in range(50)]
    got = shard_plan(docs_frame(rows), 24).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == plain(rows, 24)
    where = defaultdict(set)
    for r in got:
        where[dict(rows)[r["doc_id"]]].add(r["shard"])
    assert {t for t, s in where.items() if len(s) > 1} == {"copied very often"}


def test_groups_of_half_a_shard_stay_whole_and_shards_equal(docs_frame):
    rows = [(100 * g + i, " ".join(words(g, 40))) for g in range(7) for i in range(60)]
    rows += [(10_000 + i, " ".join(words(100 + i, 20))) for i in range(1_500)]
    plan = shard_plan(docs_frame(rows), 8).collect()
    sizes = check(plan, rows, 8)
    text, where = dict(rows), defaultdict(set)
    for r in plan:
        where[text[r["doc_id"]]].add(r["shard"])
    assert max(map(len, where.values())) == 1
    mean = sum(sizes.values()) / 8
    assert max(abs(v - mean) for v in sizes.values()) < 0.02 * mean


def test_copies_stay_together_unless_too_many(docs_frame):
    rows = [(i, " ".join(words(i % 300, 20))) for i in range(900)]
    plan = shard_plan(docs_frame(rows), 5).collect()
    check(plan, rows, 5)
    text = dict(rows)
    where = defaultdict(set)
    for r in plan:
        where[text[r["doc_id"]]].add(r["shard"])
    assert max(map(len, where.values())) == 1
    rows = [(i, "one and the same text") for i in range(600)] + [(1_000 + i, " ".join(words(i, 5))) for i in range(300)]
    sizes = check(shard_plan(docs_frame(rows), 6).collect(), rows, 6)
    mean = sum(sizes.values()) / 6
    assert max(abs(v - mean) for v in sizes.values()) < 0.05 * mean


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(shard_plan(odd_docs, 24).collect(), [(r[0], r[1]) for r in odd_rows], 24)
    whole = shard_rows(odd_docs, 24)
    assert sorted(whole.columns) == sorted(odd_docs.columns)  # its own shard and slot take the place of the given ones
    assert whole.count() == len(odd_rows) and dict(whole.dtypes)["shard"] == "int"
    assert shard_plan(no_docs, 24).count() == 0 and shard_rows(no_docs, 24).count() == 0
