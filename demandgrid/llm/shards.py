"""Contiguous shards of near equal bytes, cut from global prefix sums.

Rows are dealt into ranges of (CRC-32 of the text, hash of the text, id, row number), sorted inside each range and given
running sums of bytes and rows there. The totals of the ranges (one row per range) give each range its offset, and the
offset plus the running sum is the row's place in the whole order; no task sees more than its range. The order of bytes is
cut at ``n_shards`` targets; a row goes where its middle lies.

Groups of equal texts stay in one shard as long as a shard can hold them:

* Equal texts stand next to each other. A group of at most ``whole_group`` of a shard's target is one unit of the order.
* A larger group stands outside of the order. These are at most ``n_shards / whole_group``, so they can be dealt on the driver:
  the largest first, each to the shard that has most room. The order is then cut at the room that is left, so shards are equal.
* A group that finds no shard with room for it is dealt row by row. That is so for any group larger than a shard, and otherwise only
  where whole groups would make shards unequal.

Defined cases: a null text has no bytes (its row still counts ``overhead``) and groups with the empty text; a null id comes
first in its group; repeated rows keep apart by their row number; a very long text is one row like any other, at most a shard is longer
by it; an empty table gives an empty result; with fewer rows than shards some shards stay empty. Other columns are ignored by
``shard_plan`` and kept by ``shard_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.llm.common import clean_text, materialize

OVERHEAD = 8
PLACE = "part int, before_bytes bigint, before_rows bigint, before_every bigint"


def _keys(overhead: int) -> list[Column]:
    text = clean_text()
    return [
        (F.octet_length(text) + overhead).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.monotonically_increasing_id().alias("row_number"),
    ]


def _groups(rows: DataFrame, n_shards: int, whole_group: float) -> tuple[dict[tuple[int, int], tuple[int, int]], list[int]]:
    """Shard and number of rows for each larger group that stays whole, by its key, and the places at which the rest is cut.

    Groups are summed before the shuffle; at most ``n_shards / whole_group`` larger ones reach the driver.
    """
    keys = ["text_crc32", "text_hash"]
    total = rows.agg(F.sum("size").alias("total")).first()["total"] or 0  # one row
    sums = rows.groupBy(*keys).agg(F.sum("size").alias("held"), F.count("*").alias("copies"))
    large = sums.where((F.col("copies") > 1) & (F.col("held") > whole_group * total / n_shards) & (F.col("held") <= total / n_shards))
    used, shard_of = [0] * n_shards, {}
    for r in sorted(large.collect(), key=lambda r: (-r["held"], r["text_crc32"], r["text_hash"])):
        s = min(range(n_shards), key=lambda k: (used[k], k))
        if (used[s] + r["held"]) * n_shards <= total:
            used[s] += r["held"]
            shard_of[r["text_crc32"], r["text_hash"]] = (s, r["copies"])
    cuts, before = [], 0
    for s in range(n_shards - 1):
        before += used[s]
        cuts.append((s + 1) * total // n_shards - before)
    return shard_of, cuts


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes and rows of the range that stand before each row, those of whole groups left out, and all rows before it."""
    part, held, rows, every = TaskContext.get().partitionId(), 0, 0, 0
    for batch in batches:
        ordered = batch["own_shard"].isna().to_numpy()
        size = np.where(ordered, batch["size"].to_numpy(np.int64), 0)
        sums, counts = held + np.cumsum(size), rows + np.cumsum(ordered)
        batch["part"] = np.int32(part)
        batch["before_bytes"] = sums - size
        batch["before_rows"] = counts - ordered
        batch["before_every"] = every + np.arange(len(batch), dtype=np.int64)
        if len(batch):
            held, rows, every = int(sums[-1]), int(counts[-1]), every + len(batch)
        batch["own_shard"] = batch["own_shard"].astype("Int32")
        yield batch


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows in ranges, each with its place in its range; written once, so that the ranges stay what they are."""
    order = ["text_crc32", "text_hash", "doc_id", "row_number"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", " + PLACE
    return materialize(ranged.mapInPandas(_running, schema), "shard-order")


def _placed(ordered: DataFrame) -> DataFrame:
    """With ``start`` and ``rank`` (bytes and rows before the row in the order), and ``every`` (rows before it at all)."""
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    in_order = F.col("own_shard").isNull()
    offset = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint").alias(f"off_{c}")
    offsets = materialize(
        ordered.groupBy(F.col("part").alias("p"))
        .agg(F.sum(F.when(in_order, F.col("size"))).alias("bytes"), F.count_if(in_order).alias("rows"), F.count("*").alias("every"))
        .select("p", offset("bytes"), offset("rows"), offset("every")),
        "shard-offsets",
    )
    return (  # one row per range
        ordered.join(F.broadcast(offsets), F.col("part") == F.col("p"))
        .withColumn("start", F.col("before_bytes") + F.col("off_bytes"))
        .withColumn("rank", F.col("before_rows") + F.col("off_rows"))
        .withColumn("every", F.col("before_every") + F.col("off_every"))
    )


def _first_ranks(placed: DataFrame, cuts: list[int], n_shards: int, whole_group: float, total: int) -> list[tuple[int, int]]:
    """The rank of the first row of the order in each shard that has any, with the shard."""
    in_order = placed.where(F.col("own_shard").isNull())
    keys = ["text_crc32", "text_hash"]
    groups = in_order.groupBy(*keys).agg(
        F.min("start").alias("at"), F.sum("size").alias("held"), F.min("rank").alias("first"), F.count("*").alias("copies")
    )
    cut_up = (F.col("copies") > 1) & (F.col("held") > whole_group * total / n_shards)
    groups = materialize(groups.withColumn("cut_up", cut_up), "shard-groups")
    torn = groups.where("cut_up").select(*keys)  # at most n_shards / whole_group
    rows = in_order.join(F.broadcast(torn), keys).select(F.col("start").alias("at"), F.col("size").alias("held"), F.col("rank").alias("first"))
    units = groups.where("not cut_up").select("at", "held", "first").unionByName(rows)
    middle = 2 * F.col("at") + F.col("held")
    shard = F.size(F.filter(F.lit([2 * c for c in cuts]).cast("array<bigint>"), lambda c: c <= middle))
    return sorted((r["first"], r["shard"]) for r in units.groupBy(shard.alias("shard")).agg(F.min("first").alias("first")).collect())


def _assigned(rows: DataFrame, n_shards: int, whole_group: float) -> DataFrame:
    narrow = materialize(rows.select("size", "text_crc32", "text_hash"), "shard-sizes")
    shard_of, cuts = _groups(narrow, n_shards, whole_group)
    kind = "text_crc32 bigint, text_hash bigint, own_shard int"
    whole = rows.sparkSession.createDataFrame([(*k, s) for k, (s, _) in shard_of.items()], kind)  # n_shards / whole_group at most
    placed = _placed(_ordered(rows.join(F.broadcast(whole), ["text_crc32", "text_hash"], "left")))
    total = narrow.agg(F.sum("size").alias("total")).first()["total"] or 0
    ranks = _first_ranks(placed, cuts, n_shards, whole_group, total)
    # In a shard come its whole groups, then its part of the order.
    begins, taken = [], [0] * n_shards
    for key, (s, copies) in sorted(shard_of.items()):
        begins.append((*key, taken[s]))
        taken[s] += copies
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    if ranks:
        firsts, shards, held = (
            F.lit(list(x)).cast(f"array<{k}>")
            for x, k in (([r for r, _ in ranks], "bigint"), ([s for _, s in ranks], "int"), ([taken[s] for _, s in ranks], "bigint"))
        )
        span = F.size(F.filter(firsts, lambda f: f <= F.col("rank"))) - 1
        shard, slot = F.get(shards, span), F.col("rank") - F.get(firsts, span) + F.get(held, span)
    if not begins:
        return placed.withColumn("shard", shard).withColumn("slot", slot)
    own = placed.where(F.col("own_shard").isNotNull()).groupBy("text_crc32", "text_hash").agg(F.min("every").alias("group_first"))
    own = own.join(rows.sparkSession.createDataFrame(begins, "text_crc32 bigint, text_hash bigint, group_slot bigint"), ["text_crc32", "text_hash"])
    placed = placed.join(F.broadcast(own), ["text_crc32", "text_hash"], "left")  # n_shards / whole_group at most
    slot = F.when(F.col("own_shard").isNull(), slot).otherwise(F.col("every") - F.col("group_first") + F.col("group_slot"))
    return placed.withColumn("shard", F.coalesce("own_shard", shard)).withColumn("slot", slot)


def shard_plan(docs: DataFrame, n_shards: int = 24, whole_group: float = 0.05, overhead: int = OVERHEAD) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every document; slots run from 0 in each shard."""
    rows = docs.select("doc_id", *_keys(overhead))
    return _assigned(rows, n_shards, whole_group).select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_rows(docs: DataFrame, n_shards: int = 24, whole_group: float = 0.05, overhead: int = OVERHEAD) -> DataFrame:
    """The documents with all their columns, and ``shard``, ``slot`` (in place of columns of these names).

    Whole rows are dealt once, by range; the places of the cuts are worked out from the narrow columns of that copy.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select("doc_id", F.struct(*own).alias("whole_row"), *_keys(overhead))
    return _assigned(rows, n_shards, whole_group).select("whole_row.*", "shard", "slot")
