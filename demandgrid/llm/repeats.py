"""Exact repeats of ``WINDOW`` bytes anywhere in the corpus, by a depth-limited radix sort of suffixes.

Only the order of suffixes through their first ``WINDOW`` bytes matters: suffixes that are equal so far are the repeated
windows. The sort goes by most-significant digits. A pass lays the rows out in ranges of (what they have in common so far, next
digit), sorts each range and finds the runs of equal digits; a run of one is finished and leaves. Runs may go over the ends of ranges (the
neighbours' first and last digits, a row a range, tell), so however many suffixes are equal, they are spread over tasks.

Suffixes are carried in sheaves. In each window one place is the anchor: the place, among the first ``REACH``, of the 8 bytes
with the smallest hash (the first such place in a tie). Equal windows have their anchors at the same place. The windows of
one document that follow each other and share an anchor are a sheaf (about ``REACH / 2`` windows), and are sorted as one row by the
suffix from the anchor. Its first ``WINDOW - REACH + 1`` bytes (the core) are in all windows of the sheaf.

1. First digit: the first ``HEAD`` bytes of the core, in the order of the bytes. More than half of the suffixes leave here.
2. Second digit: the whole core. If no other sheaf has the same, no window of the sheaf is repeated. This and the following digits
   have hundreds of bytes; they are ordered by their 64-bit hashes (as bytes they would be moved and written at their full length).
3. Third digit: all bytes of the sheaf, to both sides of the core. If another sheaf is the same, all windows of both are repeated.
4. Of the kinds of sheaf that a core has, if one stands alone: windows whose anchor is at a distance of ``BIN * b`` to
   ``BIN * (b + 1) - 1`` share all but ``BIN - 1`` of their bytes; those bytes are the fourth digit. (A repeated kind takes
   part once, as something to be equal to.) Bins that are the same as a whole are repeated.
5. Last digit: each window of the bins that are left, one of each kind, in full. A window with an equal in another is
   repeated.

Repeated windows that follow each other make spans of bytes; a document's spans are merged and cut out.

Defined cases: a null text is empty; a text shorter than ``WINDOW`` bytes keeps all; a window may equal one that overlaps
it; rows are counted one by one, so a repeated row loses every byte that lies in a window; bytes that are left may end inside a
character; a very long text is anchored in segments of ``SEGMENT`` bytes, and held as a whole where its digits are cut; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.llm.common import clean_text, materialize

WINDOW, REACH = 400, 257
GRAM, BIN, HEAD = 8, 32, 24
SEGMENT = 4_000_000
SHIFT, MASK = 12, (1 << 12) - 1


def anchors(data: np.ndarray, window: int, reach: int) -> np.ndarray:
    """The anchor of the window that starts at each place."""
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    m = n + reach - 1
    grams = np.ndarray((m,), "<u8", np.ascontiguousarray(data[: m + GRAM - 1]), strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    best = ((grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) & np.uint64(0xFFFFFFFF00000000)
    best |= np.arange(m, dtype=np.uint64)
    width = 1  # best[i] is the smallest of width places from i
    while width * 2 <= reach:
        best = np.minimum(best[: len(best) - width], best[width:])
        width *= 2
    best = np.minimum(best[:n], best[reach - width : reach - width + n])
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def heads(data: np.ndarray, at: np.ndarray, core: int) -> np.ndarray:
    """The first ``HEAD`` bytes of the core at each place as numbers in the order of the bytes, (places, 3)."""
    if not len(at):
        return np.zeros((0, HEAD // 8), np.int64)
    place = np.arange(HEAD)
    block = np.where(place < core, data[np.minimum(at[:, None] + place, len(data) - 1)], 0).astype(np.uint8)
    return (block.view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def sheaves(raw: bytes, window: int, reach: int) -> Iterator[tuple[int, int, int, int]]:
    """Place (first window, windows after it, distance of the anchor, packed) and the head of each sheaf; long texts in segments."""
    core = window - reach + 1
    for base in range(0, max(0, len(raw) - window + 1), SEGMENT):
        data = np.frombuffer(raw[base : base + SEGMENT + window - 1], np.uint8)
        at = anchors(data, window, reach)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.append(first[1:], len(at)) - 1
        place = (((base + first) << SHIFT | (last - first)) << SHIFT) | (at[first] - first)
        yield from zip(place.tolist(), *heads(data, at[first], core).T.tolist(), strict=True)


def _unpacked(place: int) -> tuple[int, int, int]:
    """First window, last window, anchor."""
    first = place >> 2 * SHIFT
    return first, first + (place >> SHIFT & MASK), first + (place & MASK)


def _emit(make_rows, kinds: dict[str, pa.DataType]):
    """A function over batches from one that turns a row (as a dictionary) into rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out():
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            arrays = [
                # Hashes are unsigned here and signed in Spark.
                pa.array(np.array(c, np.uint64).view(np.int64)) if k == "hash" else pa.array(c, k)
                for c, k in zip(columns, kinds.values(), strict=True)
            ]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, list(kinds))

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns, strict=True):
                rows.extend(make_rows(dict(zip(batch.schema.names, row, strict=True))))
                if len(rows) > 50_000:
                    yield out()
        yield out()

    return run


def _sheaf_rows(window: int, reach: int):
    def rows(r: dict) -> Iterator[tuple]:
        for sheaf in sheaves(r["text"].encode(), window, reach):
            yield r["k1"], r["k2"], *sheaf

    return _emit(rows, dict.fromkeys(("k1", "k2", "place", "d0", "d1", "d2"), pa.int64()))


def _core_rows(window: int, reach: int):
    """Of each sheaf listed for a text: its core and all of it, hashed."""
    core = window - reach + 1

    def rows(r: dict) -> Iterator[tuple]:
        raw, digest = r["text"].encode(), xxhash.xxh3_64_intdigest
        for s in r["sheaves"]:
            first, last, a = _unpacked(s["place"])
            yield digest(raw[a : a + core]), digest(raw[first : last + window]), r["k1"], r["k2"], s["place"], s["n"]

    return _emit(rows, {"core": "hash", "whole": "hash", "k1": pa.int64(), "k2": pa.int64(), "place": pa.int64(), "n": pa.int64()})


def _mark(digits: list[str], kept: list[str], drop: bool):
    """Of sorted rows the ``kept`` columns with ``again`` (equal to a neighbour), ``fresh`` (the first of its run), the number of the run in
    this range, the range, and ``key``: the digits, where the run may go on in other ranges. With ``drop``, other runs of one leave."""

    def marked(batch: pa.RecordBatch, before: np.ndarray, after: np.ndarray, run: np.ndarray, ends: bool) -> pa.RecordBatch:
        again = before | after
        if "n" in batch.schema.names:
            again = again | (batch.column("n").to_numpy() > 1)
        open_ = (run == 0) | (run == run[-1])
        keys = pa.StructArray.from_arrays([batch.column(d) for d in digits], digits, mask=pa.array(~open_))
        part = np.full(len(run), TaskContext.get().partitionId(), np.int32)
        columns = [*(batch.column(c) for c in kept), pa.array(again), pa.array(~before), pa.array(run), pa.array(part), keys]
        out = pa.RecordBatch.from_arrays(columns, [*kept, "again", "fresh", "run", "part", "key"])
        keep = again | (run == 0)
        if ends:
            keep[-1] = True
        return out.filter(pa.array(keep)) if drop else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, number = None, None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(d) for d in digits]
            before = np.ones(batch.num_rows, bool)
            for k in keys:
                before[1:] &= pc.equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
            before[0] = last is not None and all(k[0].as_py() == v for k, v in zip(keys, last, strict=True))
            runs = number + np.cumsum(~before)
            if held is not None:
                held[2][-1] = before[0]
                yield marked(*held, False)
            held = (batch, before, np.append(before[1:], False), runs)
            last, number = [k[-1].as_py() for k in keys], int(runs[-1])
        if held is not None:
            yield marked(*held, True)

    return run


def radix_pass(rows: DataFrame, digits: list[str], ties: list[str], kept: list[str], label: str, drop: bool = True) -> DataFrame:
    """The ``kept`` columns of the rows whose ``digits`` another row has as well; without ``drop`` of all rows, with ``repeated`` and
    ``leader`` (the first of equals).

    Rows with a number ``n`` above 1 count as several. ``ties`` part equal digits, so that many of them don't meet in one task.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = {f.name: f for f in rows.schema}
    extra = "again boolean, fresh boolean, run bigint, part int"
    schema = T.StructType([kinds[c] for c in kept] + list(T.StructType.fromDDL(extra)) + [T.StructField("key", T.StructType([kinds[d] for d in digits]))])
    laid = rows.repartitionByRange(parts, *digits, *ties).sortWithinPartitions(*digits, *ties)
    laid = materialize(laid.mapInArrow(_mark(digits, kept, drop), schema), label)
    key = F.struct("run", "key")
    ends = laid.where(F.col("key").isNotNull()).groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    order = Window.orderBy("part")  # a row a range
    ends = ends.select(
        F.col("part").alias("_part"), F.col("last.run").alias("_last"),
        F.lag("last.key").over(order).eqNullSafe(F.col("first.key")).alias("_goes_on"),
        F.lead("first.key").over(order).eqNullSafe(F.col("last.key")).alias("_will_go_on"),
    )
    found = laid.join(F.broadcast(ends), F.col("part") == F.col("_part"))  # a row a range
    begun = (F.col("run") == 0) & F.col("_goes_on")
    found = found.withColumns(
        {"repeated": F.col("again") | begun | ((F.col("run") == F.col("_last")) & F.col("_will_go_on")), "leader": F.col("fresh") & ~begun}
    )
    return found.where("repeated").select(*kept) if drop else found.select(*kept, "repeated", "leader")


def _bin_rows(window: int, width: int):
    """Of each sheaf listed for a text, its windows by the bin of their distance to the anchor."""

    def rows(r: dict) -> Iterator[tuple]:
        raw, digest = r["text"].encode(), xxhash.xxh3_64_intdigest
        for s in r["sheaves"]:
            first, last, a = _unpacked(s["place"])
            for b in range((a - last) // width, (a - first) // width + 1):
                left = a - b * width
                lo, hi = max(first, left - width + 1), min(last, left)
                place = ((lo << SHIFT | (hi - lo)) << SHIFT) | (a - lo)
                yield s["core"], b, digest(raw[left : left - width + 1 + window]), digest(raw[lo : hi + window], a - lo), r["k1"], r["k2"], place, s["alone"]

    kinds = {"core": pa.int64(), "bin": pa.int32(), "shared": "hash", "whole": "hash", "k1": pa.int64(), "k2": pa.int64(), "place": pa.int64(), "alone": pa.bool_()}
    return _emit(rows, kinds)


def _window_rows(window: int):
    """Each window of the bins listed for a text."""

    def rows(r: dict) -> Iterator[tuple]:
        raw = r["text"].encode()
        for s in r["bins"]:
            first, last, a = _unpacked(s["place"])
            for i in range(first, last + 1):
                yield s["core"], a - i, xxhash.xxh3_64_intdigest(raw[i : i + window]), r["k1"], r["k2"], i, s["alone"]

    return _emit(rows, {"core": pa.int64(), "back": pa.int64(), "whole": "hash", "k1": pa.int64(), "k2": pa.int64(), "start": pa.int64(), "alone": pa.bool_()})


def _cut_rows(window: int):
    def rows(r: dict) -> Iterator[tuple]:
        raw = r["text"].encode()
        spans: list[list[int]] = []
        for s in sorted((s["first"], s["last"] + window) for s in r["spans"]):
            if spans and s[0] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], s[1])
            else:
                spans.append(list(s))
        kept, at = hashlib.sha256(), 0
        for lo, hi in spans:
            kept.update(raw[at:lo])
            at = hi
        kept.update(raw[at:])
        yield r["k1"], r["k2"], sum(hi - lo for lo, hi in spans), len(spans), kept.hexdigest(), [{"start": a, "end": b} for a, b in spans]

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return _emit(rows, {"k1": pa.int64(), "k2": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.string(), "spans": span})


def find_repeats(docs: DataFrame, window: int = WINDOW, reach: int = REACH, width: int = BIN) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every document; spans are byte offsets."""
    text = clean_text()
    keyed = docs.select(
        "doc_id", F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text, F.length(text)).alias("k2"), text.alias("text")
    )
    longer = keyed.where(F.octet_length("text") >= window).select("k1", "k2", "text")
    suffixes = materialize(longer.mapInArrow(_sheaf_rows(window, reach), "k1 bigint, k2 bigint, place bigint, d0 bigint, d1 bigint, d2 bigint"), "sheaves")
    suffixes = suffixes.withColumn("row", F.monotonically_increasing_id())  # parts copies of a text
    place = ["k1", "k2", "place"]
    left = radix_pass(suffixes, ["d0", "d1", "d2"], [*place, "row"], place, "radix-head").groupBy(*place).agg(F.count("*").alias("n"))
    listed = materialize(left.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "n")).alias("sheaves")), "repeat-lists")  # a text's own
    texts = materialize(
        keyed.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]).join(listed.select("k1", "k2"), ["k1", "k2"], "left_semi"), "repeat-texts"
    )
    cores = materialize(
        texts.join(listed, ["k1", "k2"]).select("k1", "k2", "text", "sheaves").mapInArrow(
            _core_rows(window, reach), "core bigint, whole bigint, k1 bigint, k2 bigint, place bigint, n bigint"
        ),
        "repeat-cores",
    )
    sharing = radix_pass(cores, ["core"], place, cores.columns, "radix-core")
    sharing = materialize(radix_pass(sharing, ["core", "whole"], place, ["core", *place], "radix-whole", drop=False), "sheaves-sharing")
    kinds = sharing.where("leader").select("core", (~F.col("repeated")).alias("alone"), F.struct(*place).alias("one"))
    by_text = (
        kinds.join(kinds.where("alone").select("core").distinct(), "core", "left_semi")
        .select("one.k1", "one.k2", F.struct("core", "one.place", "alone").alias("sheaf"))
        .groupBy("k1", "k2").agg(F.collect_list("sheaf").alias("sheaves"))  # at most a text's own
    )
    bins = materialize(
        texts.join(by_text, ["k1", "k2"]).select("k1", "k2", "text", "sheaves").mapInArrow(
            _bin_rows(window, width), "core bigint, bin int, shared bigint, whole bigint, k1 bigint, k2 bigint, place bigint, alone boolean"
        ),
        "repeat-bins",
    )
    key = ["core", "bin", "shared"]
    live = bins.groupBy(*key).agg(F.count("*").alias("n"), F.max("alone").alias("any")).where("n > 1 and any").select(*key)
    bin_kinds = materialize(
        bins.join(live, key).groupBy(*key, "whole")
        .agg(F.count("*").alias("n"), F.max("alone").alias("any"), F.min(F.struct("k1", "k2", "place")).alias("one")),
        "repeat-bin-kinds",
    )
    same = bins.where("alone").join(bin_kinds.where("n > 1").select(*key, "whole"), [*key, "whole"]).select("k1", "k2", "place")
    # Of the bins that have a window standing alone, one of each kind.
    open_bins = bin_kinds.where("n = 1 and any").select(*key).distinct()
    by_text = (
        bin_kinds.join(open_bins, key, "left_semi")
        .select("one.k1", "one.k2", F.struct("core", "one.place", ((F.col("n") == 1) & F.col("any")).alias("alone")).alias("part"))
        .groupBy("k1", "k2").agg(F.collect_list("part").alias("bins"))  # at most a text's own
    )
    windows = materialize(
        texts.join(by_text, ["k1", "k2"]).select("k1", "k2", "text", "bins").mapInArrow(
            _window_rows(window), "core bigint, back bigint, whole bigint, k1 bigint, k2 bigint, start bigint, alone boolean"
        ),
        "repeat-windows",
    )
    key = ["core", "back", "whole"]
    equal = windows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    single = windows.where("alone").join(equal, key).select("k1", "k2", F.col("start").alias("first"), F.col("start").alias("last"))
    first = F.shiftright("place", 2 * SHIFT)
    whole = sharing.where("repeated").select("k1", "k2", "place").unionByName(same)
    whole = whole.select("k1", "k2", first.alias("first"), (first + F.shiftright("place", SHIFT).bitwiseAND(MASK)).alias("last"))
    spans = (
        single.unionByName(whole).groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))  # at most a text's windows
    )
    cut = texts.join(spans, ["k1", "k2"]).select("k1", "k2", "text", "spans").mapInArrow(
        _cut_rows(window),
        "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, kept string, spans array<struct<start:bigint,end:bigint>>",
    )
    plain = keyed.select(
        "doc_id", "k1", "k2", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("all")
    )
    return plain.join(cut, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept", "all").alias("kept_sha256"), "spans",
    )
