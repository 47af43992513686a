"""Mix sources to target weights with hash thresholds found by nested histograms; nothing is sorted.

Every document has a fixed 60-bit hash. A source whose target is ``r`` times its size and a rest takes each document
``r`` times, and some once more: in the order of the hashes each that still fits the rest. The first document that doesn't is
found with sums of words by source and hash bucket (combined before the shuffle): the bucket in which the running sum
passes the rest is the only one that is split further, 12 bits a pass, until it holds one hash. From there the search goes on
among the smaller documents that fit what is left, until that is at most ``NEAR`` of the target or nothing fits. So a source is
given by a few stretches of hashes with the largest size that each takes, and a document is chosen by comparing.

Defined cases: a null text has no words; documents without words come ``r`` times; a null source is a source of its own, after
all others; rows that share an id (or, without id, a text) share a hash, fit together or not and come or go together; an empty
table gives an empty result. Other columns are ignored by ``mix_plan`` and kept by ``mix_rows``, whatever their names. Texts of
any length are counted in the JVM. Targets are shared on one task, a row a source: tens to some millions of sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.llm.common import WORD, hash60, materialize

HASH_BITS, STEP = 60, 12
NEAR = 0.002


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """One row per source in, with ``source_size``; out with ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn. The sum of all sizes is shared by weight; what exceeds
    ``most`` times a source's size goes to the others by weight. The end of that repeated sharing is a common level: in the
    order of ``most * size / weight`` a source is full as long as its quotient does not exceed the level that is left for it
    and the following. That level rises up to the first source that is not full and falls after it: the highest counts.
    """
    rows = Window.orderBy(F.col("source").isNull(), "source")
    by_quotient = Window.orderBy("quotient", F.col("source").isNull(), "source")
    before = by_quotient.rowsBetween(Window.unboundedPreceding, -1)
    after = by_quotient.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    turn = F.array(*[F.lit(w) for w in weights])
    return (
        sizes.withColumn("weight", F.get(turn, F.pmod(F.row_number().over(rows) - 1, F.lit(len(weights)))))
        .withColumn("full", (most * F.col("source_size")).cast("bigint"))
        .withColumn("quotient", F.col("full") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        .withColumn("target", F.least(F.col("weight") * F.max("level").over(everything), F.col("full").cast("double")))
        .select("source", "source_size", "target")
    )


def _first_misfit(units: DataFrame, state: DataFrame) -> DataFrame:
    """Of each open source the first hash, in order, that doesn't fit: ``key, misfit``, and ``under``, the words before it.

    ``units`` has ``source, hash, held``; only those after ``after`` with at most ``rest`` words count.
    """
    running = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    open_ = state.where("open").select("s", "rest", "after").withColumns({"below": F.lit(0).cast("bigint"), "bucket": F.lit(0).cast("bigint")})
    open_ = materialize(open_, "mix-search")
    for bits in range(STEP, HASH_BITS + 1, STEP):
        inside = (F.shiftright("hash", HASH_BITS - bits + STEP) == F.col("bucket")) & (F.col("hash") > F.col("after")) & (F.col("held") <= F.col("rest"))
        sums = (
            units.join(open_, F.col("source").eqNullSafe(F.col("s")) & inside)
            .groupBy("s", "rest", "after", "below", F.shiftright("hash", HASH_BITS - bits).alias("b"))
            .agg(F.sum("held").alias("held"), F.min("hash").alias("lowest"), F.max("hash").alias("highest"))
        )
        open_ = materialize(
            sums.withColumn("below", F.col("below") + F.coalesce(F.sum("held").over(running), F.lit(0)))
            .where((F.col("below") <= F.col("rest")) & (F.col("below") + F.col("held") > F.col("rest")))
            .select("s", "rest", "after", "below", F.col("b").alias("bucket"), "lowest", "highest"),
            "mix-search",
        )
        if open_.where(F.col("lowest") < F.col("highest")).isEmpty():
            break
    return open_.select(F.col("s").alias("key"), F.col("lowest").alias("misfit"), F.col("below").alias("under"))


def stretches(units: DataFrame, targets: DataFrame) -> DataFrame:
    """``s, source_size, target, repeats`` per source, and ``cuts``: stretches (``after``, ``before``) of hashes that are taken once
    more, each up to a size of ``most`` words."""
    kind = "array<struct<after:bigint,before:bigint,most:double>>"
    state = materialize(
        targets.withColumn("repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size"))
        .withColumns({"after": F.lit(-1).cast("bigint"), "open": F.col("rest") > NEAR * F.col("target"), "cuts": F.array().cast(kind)})
        .withColumnRenamed("source", "s"),
        "mix-state",
    )
    while not state.where("open").isEmpty():
        # Without a misfit everything that is left fits.
        found = state.join(_first_misfit(units, state), F.col("s").eqNullSafe(F.col("key")), "left")
        cut = F.struct("after", F.coalesce("misfit", F.lit(1 << HASH_BITS)).alias("before"), F.col("rest").alias("most"))
        rest = F.col("rest") - F.coalesce("under", F.lit(0))
        state = materialize(
            found.select(
                "s", "source_size", "target", "repeats",
                F.when(F.col("open"), rest).otherwise(F.col("rest")).alias("rest"), F.coalesce("misfit", "after").alias("after"),
                (F.col("misfit").isNotNull() & (rest > NEAR * F.col("target"))).alias("open"),
                F.when(F.col("open"), F.concat("cuts", F.array(cut).cast(kind))).otherwise(F.col("cuts")).alias("cuts"),
            ),
            "mix-state",
        )
    return state.select("s", "source_size", "target", "repeats", "cuts")


def _planned(docs: DataFrame, sized: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``docs`` (with ``source, size, hash``) and ``copies``; ``sized`` has the narrow columns of the same rows."""
    totals = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    units = materialize(sized.where("size > 0").groupBy("source", "hash").agg(F.sum("size").alias("held"), F.count("*").alias("rows")), "mix-units")
    plan = materialize(stretches(units, source_targets(totals, weights, most)), "mix-plan")  # a row per source
    # Rows that share a hash are weighed together; the others need no look at their unit. Written, so that Spark knows its size.
    shared = units.where("rows > 1").select(F.col("source").alias("u"), F.col("hash").alias("h"), F.col("held").alias("together"))
    shared = materialize(shared, "mix-shared")
    whole = docs.join(shared, F.col("source").eqNullSafe(F.col("u")) & (F.col("hash") == F.col("h")), "left")
    size = F.coalesce("together", "size")
    taken = F.exists("cuts", lambda c: (F.col("hash") > c["after"]) & (F.col("hash") < c["before"]) & (size <= c["most"]))
    once = (F.col("size") > 0) & taken
    return whole.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", F.col("repeats") + once.cast("bigint"))


def _sized(docs: DataFrame) -> list[Column]:
    return [
        F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
        hash60(F.col("doc_id"), F.col("text")).alias("hash"),
    ]


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every document."""
    sized = materialize(docs.select(*_sized(docs)), "mix-sized")
    return _planned(sized, sized, weights, most).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_rows(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The mix itself: each document as often as the plan takes it, with its own columns."""
    sized = materialize(docs.select(*_sized(docs)), "mix-sized")
    whole = docs.select(F.struct("*").alias("row"), *_sized(docs)[1:])
    return (
        _planned(whole, sized, weights, most)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row.*")
    )
