"""Near-duplicate classes by weighted MinHash with darts, banded joining and exact verification.

A text is its multiset of five-word shingles (lower-cased word characters): an element of weight w is the region of w unit
cells. Every cell has a fixed random sequence of darts (a unit-rate Poisson process over ranks); a dart also has one of
``COORDINATES`` places. The earliest dart of each place is the signature, so two texts agree in a place with the
probability of their weighted Jaccard similarity. A text throws only the darts up to a rank that makes about
``k (ln k + 4)`` of them, and twice as far as long as a place is empty.

1. Equal texts become one node, numbered by itself: a text, not an id, is what is compared.
2. Bands of ``ROWS`` places are joined: each node is linked to the smallest node of its bucket. With 32 bands of 4 places a pair
   at 0.8 is missed with a probability of 5e-8. Components of these links are the candidate clusters.
3. Inside a cluster every pair is compared exactly; a large cluster in blocks against blocks (of about ``BLOCK`` texts or
   ``BLOCK_BYTES``), so a task holds two blocks at most. A block pair returns, for each text, its number of links and one link to the
   smallest text it is connected to there: all links count, but no list of pairs is made.
4. Components of those links are the classes.

``drop_near`` needs classes, not numbers of links. It first compares each text with the smallest of its buckets alone, which
moves it once for each of those; only clusters that this leaves in several parts are compared in full.

Defined cases: a null text is a class of its own; texts without any word are equal only to the same text; fewer than five words
make one shingle; rows that share an id and text are one document; an id with several texts has each of them in its own class, and names
each of these classes if it is their smallest; a class without ids is named by a hash of a text; a very long text is a block of its
own, in memory as a whole with about 50 bytes a word; an empty table gives an empty result. Other columns are ignored by
``near_classes`` and kept by ``drop_near``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import chunks_of, map_texts, materialize
from demandgrid.llm.components import connected_components

WORDS = re.compile(r"\w+")
SHINGLE, SIMILARITY = 5, 0.8
COORDINATES, ROWS = 128, 4
BLOCK, BLOCK_BYTES = 2048, 8_000_000
SUB_BATCH = 2_000_000


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of the weighted shingles of all texts, and how many each text has."""
    ids: dict[str, int] = {}
    codes, counts = [], []
    for text in texts:
        words = WORDS.findall(text.lower())
        codes += [ids.setdefault(w, len(ids)) for w in words]
        counts.append(len(words))
    n = np.array(counts, np.int64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in ids], np.uint64)
    words = hashes[np.array(codes, np.int64)] if codes else np.zeros(0, np.uint64)
    ends = np.cumsum(n)
    whose = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(words)) - (ends - n)[whose]
    shingle = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):  # a text of fewer words is one shingle with the rest left out
        there = place + k < n[whose]
        at = np.minimum(np.arange(len(words)) + k, max(0, len(words) - 1))
        shingle = shingle * np.uint64(0x9E3779B97F4A7C15) + np.where(there, words[at], np.uint64(0))
    first = (place == 0) | (place + SHINGLE <= n[whose])
    shingle, whose = mix64(shingle[first]), whose[first]
    # The j-th time that a shingle comes in its text is cell j of its region.
    order = np.lexsort((shingle, whose))
    s, d = shingle[order], whose[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    at = np.arange(len(s))
    repeat = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return mix64(s + repeat.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.bincount(d, minlength=len(n))


def dart_signatures(cell: np.ndarray, counts: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """(texts, k): the earliest dart of each place; 0 for texts without cells."""
    out = np.zeros((len(counts), k), np.uint64)
    todo, darts = np.flatnonzero(counts), k * (np.log(k) + 4)
    starts = np.cumsum(counts) - counts
    while len(todo):
        n = counts[todo]
        rows = np.repeat(starts[todo] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        mine, text = cell[rows], np.repeat(np.arange(len(todo)), n)
        limit = (darts / n)[text]
        rank, best, value = np.zeros(len(mine)), np.full(len(todo) * k, np.inf), np.zeros(len(todo) * k, np.uint64)
        thrown, width = 0, 2
        while len(mine):
            turn = (np.arange(thrown, thrown + width, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            dart = mix64(mine[:, None] + turn[None, :])
            ranks = rank[:, None] + np.cumsum(-np.log(((dart >> np.uint64(11)) + np.uint64(1)) * 2.0**-53), axis=1)
            hit = ranks <= limit[:, None]
            r, d = ranks[hit], dart[hit]
            place = np.broadcast_to(text[:, None], hit.shape)[hit] * k + (d & np.uint64(k - 1)).astype(np.int64)
            np.minimum.at(best, place, r)
            won = r == best[place]
            value[place[won]] = d[won]
            go_on = hit[:, -1]
            mine, text, limit, rank = mine[go_on], text[go_on], limit[go_on], ranks[go_on, -1]
            thrown, width = thrown + width, min(64, width * 2)
        full = np.isfinite(best.reshape(-1, k)).all(1)
        out[todo[full]] = value.reshape(-1, k)[full]
        todo, darts = todo[~full], darts * 2
    return out


def band_keys(texts: list[str]) -> list[np.ndarray | list]:
    """One key per band of each text; none for texts without words."""
    found: list = []
    for lo, hi in chunks_of(texts, SUB_BATCH):
        cell, counts = cells(texts[lo:hi])
        sign = dart_signatures(cell, counts).reshape(hi - lo, -1, ROWS)
        key = np.zeros(sign.shape[:2], np.uint64) + np.arange(sign.shape[1], dtype=np.uint64)
        for r in range(ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + sign[:, :, r])
        found += [k if n else [] for k, n in zip(key.view(np.int64), counts, strict=True)]
    return found


def _similar(texts: list[str], left: np.ndarray, right: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one index in ``left``, one in ``right``) whose weighted Jaccard similarity reaches ``limit``."""
    cell, counts = cells(texts)
    whose = np.repeat(np.arange(len(texts)), counts)
    _, code, seen = np.unique(cell, return_inverse=True, return_counts=True)
    shared = seen[code] > 1
    _, code = np.unique(code[shared], return_inverse=True)
    whose = whose[shared]
    both = np.zeros((len(left), len(right)), np.float32)
    spot_l, spot_r = np.full(len(texts), -1), np.full(len(texts), -1)
    spot_l[left], spot_r[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(code, kind="stable")
    code, whose = code[order], whose[order]
    width = max(256, 8_000_000 // max(1, len(left) + len(right)))
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [lo, lo + width])
        column, doc = code[a:b] - lo, whose[a:b]
        used = int(column[-1]) + 1
        x, y = np.zeros((len(left), used), np.float32), np.zeros((len(right), used), np.float32)
        for spot, m in ((spot_l, x), (spot_r, y)):
            there = spot[doc] >= 0
            m[spot[doc[there]], column[there]] = 1
        both += x @ y.T
    total = counts[left][:, None] + counts[right][None, :] - both
    i, j = np.nonzero((both >= limit * total - 1e-6) & (both > 0))
    i, j = left[i], right[j]
    return i[i != j], j[i != j]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each index is connected to."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _verify(limit: float):
    """Batches sorted by (cluster, a, b) to ``node, root, links`` for each text of each block pair."""

    def judge(rows: list[tuple]) -> list[tuple]:
        _, a, b = rows[0][:3]
        rows = list({r[4]: r for r in sorted(rows, key=lambda r: r[4])}.values())
        texts, block = [r[5] for r in rows], np.array([r[3] for r in rows])
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        i, j = _similar(texts, left, right, limit)
        root = _roots(len(rows), i, j)
        links = np.bincount(i, minlength=len(rows))
        if a != b:
            links += np.bincount(j, minlength=len(rows))
        return [(rows[k][4], rows[root[k]][4], int(links[k])) for k in range(len(rows))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        done: list[tuple] = []

        def out():
            columns = list(zip(*done, strict=True)) if done else [[], [], []]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "root", "links"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("cluster", "a", "b", "block", "node", "text")), strict=True):
                if held and held[0][:3] != row[:3]:
                    done += judge(held)
                    held = []
                held.append(row)
            if len(done) > 10_000:
                yield out()
        if held:
            done += judge(held)
        yield out()

    return run


def _keys(text: str = "text"):
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), F.col(text), F.length(text)).alias("k2")


def _id(doc_id: str = "doc_id"):
    return F.coalesce(doc_id, "k1")


def _nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as ``doc_id, k1, k2, bands, bytes`` (written once) and their distinct texts as ``k1, k2, node, id, bands, bytes``.

    ``id`` is the smallest of a text's documents, which is the one whose text is read.
    """
    keyed = docs.where(F.col("text").isNotNull()).select("doc_id", *_keys(), F.octet_length("text").cast("bigint").alias("bytes"), "text")
    signed = materialize(map_texts(keyed, lambda: lambda texts: [band_keys(texts)], "bands array<bigint>"), "dart-signatures")
    nodes = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes"))
    nodes = nodes.select("k1", "k2", F.monotonically_increasing_id().alias("node"), _id("low").alias("id"), "bands", "bytes")
    return signed, materialize(nodes, "dart-nodes")  # written, so the numbers stay what they are


def _stars(nodes: DataFrame) -> DataFrame:
    """``u, v``: each node with the smallest of each of its buckets."""
    members = nodes.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    found = members.join(buckets, "band").where("node <> low").select(F.col("node").alias("u"), F.col("low").alias("v"))
    return materialize(found.distinct(), "dart-stars")


def _dealt(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """``cluster, node`` with the node's block, the number of blocks in the cluster, and what its text is found by."""
    sized = groups.join(nodes.select("node", "k1", "k2", "id", "bytes"), "node")
    sizes = sized.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    return sized.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("bytes")


def _compared(docs: DataFrame, placed: DataFrame, limit: float, label: str) -> DataFrame:
    """``node, root, links`` of the texts in ``placed`` (``cluster, node, block, pairs`` and keys): of each pair of blocks."""
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", *_keys(), "text").select(_id().alias("id"), "k1", "k2", "text")
    # The row that a node is named after, once however often it is repeated.
    rows = texts.join(placed, ["id", "k1", "k2"]).groupBy("id", "k1", "k2", "cluster", "block", "node").agg(
        F.first("text").alias("text"), F.first("pairs").alias("pairs")
    )
    rows = rows.withColumn("pair", F.explode("pairs")).select("cluster", "pair.a", "pair.b", "block", "node", "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "cluster", "a", "b").sortWithinPartitions("cluster", "a", "b")
    return materialize(dealt.mapInArrow(_verify(limit), "node bigint, root bigint, links bigint"), label)


def _links(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, limit: float) -> DataFrame:
    """``node, root, links`` within the clusters (``cluster, node``), every pair compared."""
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct(F.least(b, F.col("block")).alias("a"), F.greatest(b, F.col("block")).alias("b")),
    )
    return _compared(docs, _dealt(clusters, nodes).withColumn("pairs", others).drop("blocks"), limit, "dart-links")


def _star_links(docs: DataFrame, nodes: DataFrame, stars: DataFrame, limit: float) -> DataFrame:
    """``node, root, links`` where only the links between a star's middle and its ends are compared."""
    ends = _dealt(stars.select(F.col("v").alias("cluster"), F.col("u").alias("node")), nodes)
    ends = ends.withColumn("pairs", F.array(F.struct(F.lit(-1).alias("a"), F.col("block").alias("b"))))
    blocks = ends.groupBy("cluster").agg(F.max("blocks").alias("blocks"))
    middles = nodes.select("node", "k1", "k2", "id", F.col("node").alias("cluster")).join(blocks, "cluster").withColumn("block", F.lit(-1))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.lit(-1).alias("a"), b.alias("b")))
    return _compared(docs, ends.unionByName(middles.withColumn("pairs", pairs)).drop("blocks"), limit, "dart-star-links")


def _edges(links: DataFrame) -> DataFrame:
    return links.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))


def _clusters(stars: DataFrame) -> DataFrame:
    return materialize(connected_components(stars).select(F.col("component").alias("cluster"), "node"), "dart-clusters")


def near_classes(docs: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, n_links`` for every document: links go to other texts with a similarity of ``limit`` or more. A class is
    named by its smallest id."""
    null = docs.where(F.col("text").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")
    )
    signed, nodes = _nodes(docs)
    links = _links(docs, nodes, _clusters(_stars(nodes)), limit)
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    named = nodes.drop("bands").join(connected_components(_edges(links)), "node", "left").join(counts, "node", "left")
    named = materialize(
        named.select("k1", "k2", "id", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")),
        "dart-classes",
    )
    lowest = named.groupBy("component").agg(F.min("id").alias("class_id"))
    texts = named.join(lowest, "component").select("k1", "k2", "class_id", "n_links")
    return signed.select("doc_id", "k1", "k2").join(texts, ["k1", "k2"]).select("doc_id", "class_id", "n_links").unionByName(null)


def drop_near(docs: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the smallest id, with its own columns; all documents without a text."""
    _, nodes = _nodes(docs)
    stars = _stars(nodes)
    found = _edges(_star_links(docs, nodes, stars, limit))
    clusters = _clusters(stars)
    parts = clusters.join(connected_components(found), "node", "left").withColumn("part", F.coalesce("component", "node"))
    torn = parts.groupBy("cluster").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("cluster")
    rest = _links(docs, nodes, clusters.join(torn, "cluster"), limit)
    components = connected_components(found.unionByName(_edges(rest)))
    named = nodes.join(components, "node", "left").select("id", "k1", "k2", F.coalesce("component", "node").alias("component"))
    first = named.groupBy("component").agg(F.min(F.struct("id", "k1", "k2")).alias("first")).select("first.*")
    whole = docs.where(F.col("text").isNotNull()).select(F.struct("*").alias("whole_row"), "doc_id", *_keys())
    whole = whole.select("whole_row", _id().alias("id"), "k1", "k2")
    kept = whole.dropDuplicates(["id", "k1", "k2"]).join(first, ["id", "k1", "k2"], "left_semi")
    return kept.select("whole_row.*").unionByName(docs.where(F.col("text").isNull()))
