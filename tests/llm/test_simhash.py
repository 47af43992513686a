from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from demandgrid.llm import simhash
from demandgrid.llm.components import connected_components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius=3):
    """Smallest fingerprint that each is connected to, by all pairs."""
    left, out = set(prints), {}
    while left:
        reached, todo = set(), [min(left)]
        while todo:
            u = todo.pop()
            if u not in reached:
                reached.add(u)
                todo += [v for v in left if (u ^ v).bit_count() <= radius]
        out |= dict.fromkeys(reached, min(reached))
        left -= reached
    return out


def near_prints(seed, centres=25, each=12):
    """Random fingerprints, chains and balls around them, and some of few bits."""
    r, out = random.Random(seed), {0, 1, 3, 2**64 - 1, 2**63}
    for _ in range(centres):
        x = r.getrandbits(64)
        for _ in range(r.randrange(each) + 1):
            out.add(x)
            for _ in range(r.randrange(1, 6)):
                x ^= 1 << r.randrange(64)
    return sorted(out)


@pytest.mark.parametrize(("leaf", "fan_bits"), [(1024, 6), (2, 1), (1, 2)])
def test_links_against_all_pairs(spark, leaf, fan_bits):
    # A ball in one block of every rotation, so that blocks have many leaves and levels.
    r = random.Random(1)
    ball = {sum(1 << b for b in r.sample((1, 2, 17, 18, 33, 34, 49, 50, 51), r.randrange(6))) << 1 for _ in range(120)}
    prints = sorted(set(near_prints(leaf)) | ball)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(p),) for p in prints], "bits bigint").repartition(3)
    links = simhash.link_fingerprints(frame, 3, leaf, fan_bits)
    got = {x.node: x.component for x in connected_components(links).collect()}
    groups = {}
    for p, c in plain_components(prints).items():
        groups.setdefault(c, set()).add(signed(p))
    want = {s: min(g) for g in groups.values() if len(g) > 1 for s in g}
    assert got == want


def test_patterns_prune(spark):
    """Two far groups in one leading block meet as nodes and go."""
    far = [(1 << 40) + i for i in range(4)] + [((1 << 32) - 1) + (i << 33) for i in range(4)]
    nodes = [(0, 0, i, int(np.bitwise_and.reduce(far[4 * i : 4 * i + 4])), int(np.bitwise_or.reduce(far[4 * i : 4 * i + 4])), []) for i in (0, 1)]
    leaves = spark.createDataFrame(nodes, "turn int, head int, node bigint, ones bigint, any bigint, prints array<bigint>")
    assert simhash.leaf_pairs(leaves, 3, 6).count() == 0
    assert simhash.leaf_pairs(leaves, 64, 6).count() == 1


def test_gray_order_and_turns(spark):
    rows = [(0b110,), (0b111,), (0b101,), (0b100,), (-1,)]
    df = spark.createDataFrame(rows, "b bigint")
    assert [r[0] for r in df.select(simhash.gray_rank(F.col("b"))).collect()][:4] == [4, 5, 6, 7]
    turned = df.select(*[simhash.rotated(F.col("b"), F.lit(t)) for t in range(4)]).first()
    assert list(turned) == [0b110 << 16 * t for t in range(4)]


def test_documents_against_plain_code(spark, docs_frame, odd_rows):
    r = random.Random(2)
    rows = list(odd_rows)
    for k in range(30):
        text = [f"w{r.randrange(900)}" for _ in range(r.randrange(1, 150))]
        for j in range(4):
            rows.append((1000 + 10 * k + j, " ".join(text)))
            text[r.randrange(len(text))] = "Changed" if j % 2 else "ÄNDERN"
    got = simhash.simhash_components(docs_frame(rows).repartition(3)).collect()
    prints = {}
    for i, text, *_ in rows:
        prints.setdefault(plain_fingerprint(text), []).append(i)
    root = plain_components(list(prints))
    low = {}
    for p, c in root.items():
        low[c] = min([i for i in prints[p] if i is not None] + [low.get(c, 10**9)])
    want = [(i, f"{p:016x}", low[root[p]] if low[root[p]] < 10**9 else None) for p, ids in prints.items() for i in ids]
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in got)
    assert len({x.component_id for x in got}) < len(prints)


def test_pieces_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 77}" for i in range(500)) + " \t end"
    whole = simhash.fingerprint(text)
    assert whole == plain_fingerprint(text)
    for size in (1, 10, 100):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.fingerprint(text) == whole
        assert simhash.fingerprint("One") == plain_fingerprint("one")
        assert simhash.fingerprint("One two") == plain_fingerprint("one two")


@pytest.mark.parametrize("name", ["odd_docs", "no_docs"])
def test_other_columns_and_empty_tables(request, name):
    docs = request.getfixturevalue(name)
    assert simhash.simhash_components(docs).count() == docs.count()
