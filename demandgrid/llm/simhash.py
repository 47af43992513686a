"""SimHash near-duplicates through a hierarchical index of fingerprints in Gray order.

A fingerprint has 64 bits: the majority of the hash bits of a text's three-word shingles. Two fingerprints link when they differ in
at most ``RADIUS`` bits; documents are joined to the components of these links.

1. Equal fingerprints become one; only distinct ones enter the index.
2. The index holds each fingerprint ``ROTATIONS`` times, turned by 16 bits each time. Within the radius of 3 two fingerprints agree in
   one of four blocks of 16 bits, so it is enough to compare, in each rotation, those with the same leading block. This block is
   the topmost masked pattern of the index.
3. Rotated fingerprints are sorted by Gray rank: neighbours in this order differ in few bits, and a run of them shares many. Runs
   of up to ``LEAF`` with one leading block are the leaves. A node keeps its masked pattern, that is the bits on which all below it
   agree. ``FAN`` neighbouring nodes of a leading block have one parent, with the pattern that their patterns share, until a
   leading block has no more than ``FAN`` nodes.
4. Search goes down from pairs of topmost nodes. The differences between two masked patterns, at places that both fix, are
   a lower bound for all pairs below: the differences accumulated on the way down only grow, and once they pass the radius
   the whole group goes. Pairs of nodes are rows, so a hot block is searched by many tasks.
5. Pairs of leaves that are left, and each leaf with itself, are compared bit by bit. Each returns a link for each fingerprint that
   has one, to the smallest it is connected to in there: connections are kept whole without a list of pairs.

Defined cases: a null or empty text has no shingle and the fingerprint 0, linked like any other; one or two words are one shingle;
a repeated row is linked to itself; rows without an id get the component of their fingerprint, and a component without any id
is null; an empty table gives an empty result; other columns are ignored. A very long text is hashed in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import clean_text, map_texts, materialize
from demandgrid.llm.components import connected_components

SHINGLE, SEED, BITS = 3, 42, 64
RADIUS, ROTATIONS, BLOCK = 3, 4, 16
LEAF, FAN_BITS = 1024, 6
PIECE = 1_000_000
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end before a blank."""
    at = 0
    while at < len(raw):
        blank = BLANK.search(raw, at + PIECE)
        end = blank.start() if blank else len(raw)
        yield raw[at:end]
        at = end


def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit."""
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: str) -> int:
    """Unsigned; 0 for a text without words."""
    ones, n, last = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces(text.encode()):
        words = last + piece.lower().split()  # of bytes: A-Z and ASCII blanks
        line, starts = b" ".join(words), list(accumulate((len(w) + 1 for w in words), initial=0))
        hashes = [xxhash.xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(starts, starts[SHINGLE:], strict=False)]
        if hashes:
            ones += _ones(hashes)
            n += len(hashes)
        last = words[-(SHINGLE - 1) :]
    if not n and last:
        ones, n = _ones([xxhash.xxh64_intdigest(b" ".join(last), SEED)]), 1
    return int((np.uint64(1) << np.flatnonzero(2 * ones > n).astype(np.uint64)).sum(dtype=np.uint64))


def _fingerprints(texts: list[str]) -> list[np.ndarray]:
    return [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]


def rotated(bits: Column, turn: Column) -> Column:
    """``bits`` turned left by ``turn`` blocks."""
    by = turn * BLOCK
    return F.call_function("shiftleft", bits, by).bitwiseOR(F.when(turn == 0, 0).otherwise(F.call_function("shiftrightunsigned", bits, BITS - by)))


def gray_rank(bits: Column) -> Column:
    """Place of ``bits`` in the Gray order; the leading bits of rank and code determine each other."""
    for k in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, k))
    return bits


def _cut_leaves(size: int):
    """Sorted rows to leaves: runs of up to ``size`` neighbours with one rotation and leading block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def leaf() -> tuple:
            return (*key, int(np.bitwise_and.reduce(held)), int(np.bitwise_or.reduce(held)), list(held))

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 5
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["turn", "head", "ones", "any", "prints"])

        for batch in batches:
            done = []
            for turn, head, bits in zip(*(batch.column(c).to_pylist() for c in ("turn", "head", "bits")), strict=True):
                if held and ((turn, head) != key or len(held) == size):
                    done.append(leaf())
                    held = []
                key = (turn, head)
                held.append(bits)
            yield out(done)
        yield out([leaf()] if held else [])

    return run


def local_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint of two leaves that has a link between them: itself, and the smallest it is connected to there."""
    i, j = np.nonzero(np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= radius)  # of signed ones it counts |x|
    values, code = np.unique(np.concatenate([left[i], right[j]]), return_inverse=True)
    a, b = code[: len(i)], code[len(i) :]
    root = np.arange(len(values))  # labels fall until all linked ones are equal
    while True:
        low = np.minimum(root[a], root[b])
        if (low == root[a]).all() and (low == root[b]).all():
            break
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
    return values, values[root]


def _compare(radius: int):
    """Rows of two leaves to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                u, v = local_links(left.values.to_numpy(), right.values.to_numpy(), radius)
                us.append(u[u != v])
                vs.append(v[u != v])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return run


def _bound(a: str, b: str) -> Column:
    """Differences between the masked patterns of two nodes, at the places that both fix."""
    free = F.col(f"{a}_any").bitwiseXOR(F.col(f"{a}_ones")).bitwiseOR(F.col(f"{b}_any").bitwiseXOR(F.col(f"{b}_ones")))
    return F.bit_count(F.col(f"{a}_ones").bitwiseXOR(F.col(f"{b}_ones")).bitwiseAND(F.bitwise_not(free)))


def _side(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select("turn", "head", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "ones", "any")])


def leaf_pairs(leaves: DataFrame, radius: int, fan_bits: int) -> DataFrame:
    """``turn, head, a_node, b_node`` (a before b) of different leaves that may hold fingerprints within the radius."""
    levels = [leaves.select("turn", "head", "node", "ones", "any")]
    shared = levels[0].groupBy("turn", "head").agg(F.count("*").alias("n")).where("n > 1").select("turn", "head")
    levels[0] = materialize(levels[0].join(shared, ["turn", "head"]), "gray-nodes")
    while True:
        most = levels[-1].groupBy("turn", "head").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0  # one row
        if most <= 1 << fan_bits:
            break
        parent = F.shiftright("node", fan_bits).alias("node")
        levels.append(
            materialize(levels[-1].groupBy("turn", "head", parent).agg(F.bit_and("ones").alias("ones"), F.bit_or("any").alias("any")), "gray-nodes")
        )
    key = ["turn", "head"]
    a, b = _side(levels[-1], "a"), _side(levels[-1], "b")  # no more than 2^fan_bits a key
    pairs = a.join(b, key).where("a_node <= b_node")
    for below in levels[-2::-1]:
        pairs = materialize(pairs.where(_bound("a", "b") <= radius).select(*key, "a_node", "b_node"), "gray-pairs")
        a, b = (_side(below, s).withColumn("parent", F.shiftright(f"{s}_node", fan_bits)) for s in ("a", "b"))
        pairs = (
            pairs.select(*key, F.col("a_node").alias("parent"), F.col("b_node").alias("other")).join(a, [*key, "parent"]).drop("parent")
            .withColumnRenamed("other", "parent").join(b, [*key, "parent"]).drop("parent").where("a_node <= b_node")
        )
    return pairs.where("a_node < b_node").where(_bound("a", "b") <= radius).select(*key, "a_node", "b_node")


def link_fingerprints(prints: DataFrame, radius: int = RADIUS, leaf: int = LEAF, fan_bits: int = FAN_BITS) -> DataFrame:
    """``u, v``: links whose components are those of all pairs of ``bits`` (distinct, bigint) within ``radius``."""
    if radius >= ROTATIONS:
        raise ValueError(f"{ROTATIONS} blocks guarantee a radius below {ROTATIONS}")
    turns = prints.select("bits", F.explode(F.array(*[F.lit(t) for t in range(ROTATIONS)])).alias("turn"))
    turns = turns.withColumn("turned", rotated(F.col("bits"), F.col("turn")))
    ranked = turns.select("turn", F.shiftrightunsigned("turned", BITS - BLOCK).cast("int").alias("head"), gray_rank(F.col("turned")).alias("rank"), "bits")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ranked.repartitionByRange(parts, "turn", "rank").sortWithinPartitions("turn", "rank").select("turn", "head", "bits")
    leaves = ordered.mapInArrow(_cut_leaves(leaf), "turn int, head int, ones bigint, any bigint, prints array<bigint>")
    # Numbers rise in Gray order within a partition and stay what they are, as the leaves are written.
    leaves = materialize(leaves.withColumn("node", F.monotonically_increasing_id()), "gray-leaves")
    alone = leaves.where(F.size("prints") > 1).select(F.col("prints").alias("left"), F.col("prints").alias("right"))
    pairs = leaf_pairs(leaves, radius, fan_bits)
    key = ["turn", "head"]
    side = lambda node, name: leaves.select(*key, F.col("node").alias(node), F.col("prints").alias(name))
    between = pairs.join(side("a_node", "left"), [*key, "a_node"]).join(side("b_node", "right"), [*key, "b_node"])
    # Comparing takes far longer than reading: deal the pairs evenly.
    between = between.select("left", "right").repartition(parts)
    return alone.unionByName(between).mapInArrow(_compare(radius), "u bigint, v bigint").distinct()


def simhash_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document: 16 hexadecimal digits, and the smallest id that links lead to."""
    signed = materialize(map_texts(docs.select("doc_id", clean_text().alias("text")), lambda: _fingerprints, "bits bigint"), "simhashes")
    prints = signed.groupBy("bits").agg(F.min("doc_id").alias("low"))
    named = connected_components(link_fingerprints(prints.select("bits"), radius)).withColumnRenamed("node", "bits")
    prints = materialize(prints.join(named, "bits", "left").select("bits", "low", F.coalesce("component", "bits").alias("component")), "simhash-prints")
    lowest = prints.groupBy("component").agg(F.min("low").alias("component_id"))
    whole = prints.join(lowest, "component").select("bits", "component_id")
    return signed.join(whole, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
