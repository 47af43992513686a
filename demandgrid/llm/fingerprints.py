"""Document fingerprints by locally consistent parsing.

A text is a sequence of code points. On each level runs of one symbol become one symbol, deterministic coin tossing gives
each symbol a small label from itself and its left neighbour (position and value of the lowest bit in which their names
differ; four rounds leave six labels, and neighbours never share one), and a phrase begins at each local maximum of the
labels. A phrase is named by a hash of its symbols, and the names are the next level's sequence, until one is left: the root.
Where a phrase begins depends on a few neighbours only, so equal substrings are parsed alike inside, at whatever offset.

The fingerprint is the root's name and a sketch of the phrases of level two and up: of the names that fall in each of
``BINS`` bins, 16 bits of the smallest. The likeness of two fingerprints is the Dice coefficient that their bins estimate.

Defined cases: a null text is empty; the empty text has a fingerprint of its own; equal fingerprints have likeness 1; texts
without a phrase in common 0. In ``fingerprint_edits`` rows are ordered by descending id, nulls last, equal ids by a hash of the
text; a table of one row is its own next; a very long text is parsed by itself, with about 50 bytes for each of its own; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import chunks_of, clean_text

BINS = 64
SUB_BATCH = 400_000
#: Of the bytes 0 to 255 the place of the lowest set bit; 0 for none.
LOWEST = np.array([(v & -v).bit_length() - 1 if v else 0 for v in range(256)], np.uint8)
ODD = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(64, ODD, np.uint64), dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tossed(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5; the first symbol of a text counts as differing from nothing in bit 0."""
    differ = names.copy()
    differ[1:] ^= names[:-1]
    differ[first] = 1
    low = differ & (~differ + np.uint64(1))
    place = ((low.astype(np.float64).view(np.uint64) >> np.uint64(52)) - np.uint64(1023)) & np.uint64(63)
    label = (place * np.uint64(2) + ((names >> place) & np.uint64(1))).astype(np.uint8)
    for _ in range(3):
        differ8 = label.copy()
        differ8[1:] ^= label[:-1]
        differ8[first] = 1
        place8 = LOWEST[differ8]
        label = place8 * np.uint8(2) + ((label >> place8) & np.uint8(1))
    return label


def phrases(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next level: names of the phrases, and where a text's first phrase is."""
    fresh = first.copy()
    fresh[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(names))).astype(np.uint64)
    names, first = names[at], first[at]
    names = np.where(runs > 1, mix64(names + runs * ODD), names)
    label = _tossed(names, first)
    top = np.zeros(len(names), bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    last = np.append(first[1:], True)
    begins = np.flatnonzero((top & ~last) | first)
    length = np.diff(np.append(begins, len(names)))
    inside = np.arange(len(names)) - np.repeat(begins, length)
    sums = np.add.reduceat(mix64(names) * POWERS[inside & 63], begins)
    return mix64(sums + length.astype(np.uint64)), first[begins]


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Root names, and sketches (texts, BINS) with 0 for an empty bin."""
    roots = np.zeros(len(texts), np.uint64)
    sketch = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, np.uint64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    whose = np.flatnonzero(lengths)  # texts that are still parsed
    lengths = lengths[whose]
    names = points.astype(np.uint64) + np.uint64(1)
    level = 0
    while len(names):
        first = np.zeros(len(names), bool)
        first[np.cumsum(lengths) - lengths] = True
        names, first = phrases(names, first)
        level += 1
        begins = np.flatnonzero(first)
        lengths = np.diff(np.append(begins, len(names)))
        done = lengths == 1
        roots[whose[done]] = names[begins[done]]
        # Phrases of level two and up, and every root, go to the sketch.
        text = np.repeat(np.arange(len(whose)), lengths)
        used = done[text] if level < 2 else np.ones(len(names), bool)
        value = mix64(names[used] + np.uint64(level * int(ODD) % (1 << 64)))
        np.minimum.at(sketch, whose[text[used]] * BINS + (value & np.uint64(BINS - 1)).astype(np.int64), value >> np.uint64(6))
        go_on = ~done[text]
        names, whose, lengths = names[go_on], whose[~done], lengths[~done]
    found = (sketch % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    found[sketch == np.iinfo(np.uint64).max] = 0
    return roots, found.reshape(-1, BINS)


def as_strings(roots: np.ndarray, sketch: np.ndarray) -> list[str]:
    width = BINS * 4
    whole = sketch.astype(">u2").tobytes().hex()
    return [f"{r:016x}{whole[i * width : (i + 1) * width]}" for i, r in enumerate(roots.tolist())]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Dice coefficient of the phrases, estimated from the bins; 1 for equal fingerprints."""
    same = ((a[1] == b[1]) & (a[1] > 0)).sum(1)
    used = ((a[1] > 0) | (b[1] > 0)).sum(1)
    jaccard = same / np.maximum(used, 1)
    equal = (a[0] == b[0]) & (a[1] == b[1]).all(1)
    return np.where(equal, 1.0, 2 * jaccard / (1 + jaccard))


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many code points from the start of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they are shuffled whole, and a codec over rows of a shuffle compresses less."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = [pack(t.encode()) for t in batch.column("text").to_pylist()]
        columns = [batch.column("doc_id"), batch.column("tie"), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "packed"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each followed by the one it is compared with; guards are only followers."""

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        own = [i for i, r in enumerate(rows[:-1]) if r[1] == 0]
        texts = [r[3] for r in rows]
        changed = [edited(texts[i], texts[i + 1]) for i in own]
        all_roots, all_sketches = fingerprints(texts)
        now, after = (all_roots[own], all_sketches[own]), ([i + 1 for i in own])
        after = (all_roots[after], all_sketches[after])
        new = fingerprints(changed)
        columns = [
            [rows[i][2] for i in own], [len(texts[i]) for i in own], [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            as_strings(*now), as_strings(*new), likeness(now, new), likeness(now, after),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, RESULT.values(), strict=True)], list(RESULT))

    held: list[tuple] = []
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = [unpack(t).decode() for t in batch.column("packed").to_pylist()]
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("range", "guard", "doc_id")), texts, strict=True))
        for lo, hi in chunks_of([r[3] for r in rows], SUB_BATCH):
            held += rows[lo:hi]
            if len(held) > 1:
                yield judge(held)
                held = held[-1:]


def fingerprint_edits(docs: DataFrame, ranges_per_partition: int = 4) -> DataFrame:
    """Fingerprints of every text and of its edited text, which borrows from the next document by descending id.

    Ids are cut into ranges at quantiles (values that occur). A range is read in order as a stream, by one task; the document
    at a cut is sent along to the range above as well, and the largest id to the lowest range, so texts are shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), clean_text().alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = parts * ranges_per_partition
    shares = [i / n for i in range(1, n)]
    found = rows.agg(
        F.percentile_approx("doc_id", F.lit(shares), F.lit(max(10_000, 20 * n))).alias("cuts"), F.max("doc_id").alias("top")
    ).first()  # one row of n ids
    cuts = sorted({c for c in found["cuts"] or [] if c != found["top"]})
    # How many cuts lie below an id: first among every step-th cut, then in the step that follows.
    step = max(1, isqrt(len(cuts)))
    below = lambda some: F.size(F.filter(some, lambda c: c < F.col("doc_id")))
    fine, coarse = (F.lit(x).cast("array<bigint>") if x else F.array().cast("array<bigint>") for x in (cuts, cuts[step - 1 :: step]))
    whole_steps = below(coarse) * step
    spot = F.when(F.col("doc_id").isNull(), 0).otherwise(whole_steps + below(F.slice(fine, whole_steps + 1, step)))
    places = F.array_compact(F.array(
        F.struct(F.col("spot").alias("range"), F.lit(0).alias("guard")),
        F.when(F.get(fine, F.col("spot")) == F.col("doc_id"), F.struct((F.col("spot") + 1).alias("range"), F.lit(1).alias("guard"))),
        F.when(F.col("doc_id").eqNullSafe(F.lit(found["top"])), F.struct(F.lit(0).alias("range"), F.lit(2).alias("guard"))),
    ))
    order = ["range", "guard", F.col("doc_id").desc_nulls_last(), "tie"]
    packed = rows.withColumn("tie", F.xxhash64("text")).mapInArrow(_pack, "doc_id bigint, tie bigint, packed binary")
    dealt = (
        packed.withColumn("spot", spot).select("doc_id", "tie", "packed", F.explode(places).alias("place"))
        .select("place.range", "place.guard", "doc_id", "tie", "packed")
        .repartition(parts, "range").sortWithinPartitions(*order)
    )
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_pairs, schema)
