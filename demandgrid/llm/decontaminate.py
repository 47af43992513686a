"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

DataFrame operations only. A benchmark item of w words is looked for in windows of w words.

1. Words are runs of letters and digits, lower-cased. A window can be similar to an item only if they share a shingle, so the
   shingles of all documents meet those of the items, and each shared one lines a window up with the item (several for
   a passage with words put in or left out). Windows are kept once per text, and their contents once altogether, each with the
   items it was lined up with.
2. A window's SimHash has ``BITS`` bits: the signs of sums of its shingles' hash bits, weighted by the shingles' letters.
3. The bits are cut into ``RADIUS + 1`` blocks. Two fingerprints within ``RADIUS`` agree in one block at least, so joining the
   lined-up contents and items by (item, block, value) yields every one of these pairs within the radius, and no pair that was not lined
   up; the distance is then checked.
4. Pairs that pass are compared exactly: letters of the shared shingles over letters of all, repeats counted.

``RADIUS`` is far above what ``SIMILARITY`` needs: at 0.8 the expected distance is 10 of 63 bits with a deviation of 2.9.

Defined cases: null and empty texts and items match nothing; an item of fewer than five words is one shingle of its words;
a document shorter than an item is one window; repeated rows are reported once; several items in a document are all
reported; shingles of very long items and windows are rows, grouped and joined, so work grows with their words; the words of one text are
an array in one row; an empty benchmark or corpus gives an empty result. Other columns are ignored, or kept by ``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import materialize

WORDS = r"[\p{L}\p{N}]+"
SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCK_BITS = 20, 3
BLOCKS = RADIUS + 1
BITS = BLOCKS * BLOCK_BITS
#: Shingles of a benchmark up to this many (about 100 MB) are broadcast; more are joined by shuffling.
MOST_BROADCAST = 2_000_000


def _words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORDS), F.lit(0))


def _keys(text: str = "text") -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(2), F.col(text), F.length(text)).alias("k2")


def _shingles(words: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words."""
    places = F.sequence(F.lit(0), F.size(words) - length)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(length)]))
    return F.when(F.size(words) >= length, hashes).otherwise(F.array().cast("array<bigint>"))


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """``key, shingle, letters, count`` of the ``words`` of each row."""
    last = F.greatest(F.size("words") - SHINGLE, F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("words", i + 1, SHINGLE), " "))
    counted = rows.select(key, F.explode(runs).alias("shingle")).groupBy(key, "shingle").agg(F.count("*").alias("count"))
    return counted.withColumn("letters", F.length("shingle"))


def _fingerprints(counted: DataFrame, key: str) -> DataFrame:
    """``key, weight, blocks``: letters of all shingles, and the SimHash as ``BLOCKS`` numbers of ``BLOCK_BITS`` bits."""
    weighed = counted.select(key, F.xxhash64("shingle").alias("id"), (F.col("count") * F.col("letters")).alias("w"))
    sums = [F.sum(F.when(F.getbit("id", F.lit(b)) == 1, F.col("w")).otherwise(-F.col("w"))).alias(f"b{b}") for b in range(BITS)]
    summed = weighed.groupBy(key).agg(F.sum("w").alias("weight"), *sums)
    bit = lambda b: F.when(F.col(f"b{b}") > 0, 1).otherwise(0)
    blocks = [sum((bit(i * BLOCK_BITS + k) * (1 << k) for k in range(BLOCK_BITS)), F.lit(0)) for i in range(BLOCKS)]
    return summed.select(key, "weight", F.array(*blocks).alias("blocks"))


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``k1, k2, start, n_words, item`` of the windows that share a shingle with an item and line up with it."""
    texts = docs.where(F.col("text").isNotNull()).select(*_keys(), _words().alias("words"))
    lengths = [r[0] for r in items.select(F.least("n_words", F.lit(SHINGLE))).distinct().collect()]  # SHINGLE at most
    windows = None
    for length in lengths:
        known = (
            items.where(F.least("n_words", F.lit(SHINGLE)) == length)
            .select("item", "n_words", F.posexplode(_shingles(F.col("words"), length)).alias("offset", "hash"))
        )
        known = materialize(known, "item-shingles")
        if known.count() <= MOST_BROADCAST:
            known = F.broadcast(known)
        held = texts.select("k1", "k2", F.size("words").alias("held"), F.posexplode(_shingles(F.col("words"), length)).alias("place", "hash"))
        start = F.greatest(F.lit(0), F.least(F.col("place") - F.col("offset"), F.col("held") - F.col("n_words")))
        found = held.join(known, "hash").select("k1", "k2", start.alias("start"), "n_words", "item").distinct()
        windows = found if windows is None else windows.unionByName(found)
    return windows


def near_pairs(lined_up: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs ``content, item`` of ``lined_up`` whose fingerprints are within the radius, with their ``distance`` and weights."""
    by_block = lambda df, *columns: df.select(*columns, F.posexplode("blocks").alias("block", "value"))
    differing = F.aggregate(
        F.zip_with("blocks", "item_blocks", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x
    )
    found = by_block(lined_up.join(windows, "content"), "content", "item").join(by_block(items, "item"), ["item", "block", "value"])
    return (
        found.select("content", "item").distinct()
        .join(windows, "content")
        .join(items.select("item", F.col("blocks").alias("item_blocks"), F.col("weight").alias("item_weight")), "item")
        .withColumn("distance", differing).where(F.col("distance") <= RADIUS).drop("blocks", "item_blocks")
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """``doc_id, k1, k2, item_id, start_word, n_words, distance, similarity``: each window that reaches ``limit``."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", _words().alias("words"))
    items = items.withColumns({"n_words": F.size("words"), "item": F.monotonically_increasing_id()}).where("n_words > 0")
    items = materialize(items, "items")  # written, so the numbers stay what they are
    windows = _windows(docs, items)
    if windows is None:
        nothing = "item_id bigint, start_word int, n_words int, distance int, similarity double"
        empty = docs.sparkSession.createDataFrame([], nothing)
        return docs.where(F.lit(False)).select("doc_id", *_keys()).join(empty, F.lit(True)).select("doc_id", "k1", "k2", *empty.columns)
    windows = materialize(windows, "leak-windows")
    texts = docs.where(F.col("text").isNotNull()).select(*_keys(), "text")
    place = ["k1", "k2", "start", "n_words"]
    cut = (
        texts.join(windows.groupBy(*place).agg(F.collect_set("item").alias("items")), ["k1", "k2"])  # a set of lined-up items
        .withColumn("words", F.slice(_words(), F.col("start") + 1, F.col("n_words")))
        .withColumn("content", F.xxhash64("words", "n_words"))
        .groupBy(*place, "content").agg(F.first("words").alias("words"), F.first("items").alias("items"))
    )
    cut = materialize(cut, "leak-contents")
    contents = cut.groupBy("content").agg(F.first("words").alias("words"))
    lined_up = cut.select("content", F.explode("items").alias("item")).distinct()
    window_shingles = materialize(_counted(contents, "content"), "leak-shingles")
    item_shingles = materialize(_counted(items, "item"), "item-counts")
    windows_, items_ = (materialize(_fingerprints(c, k), "simhash") for c, k in ((window_shingles, "content"), (item_shingles, "item")))
    pairs = near_pairs(materialize(lined_up, "lined-up"), windows_, items_)
    both = pairs.join(window_shingles, "content").join(
        item_shingles.select("item", "shingle", F.col("count").alias("item_count")), ["item", "shingle"]
    )
    shared = both.groupBy("content", "item", "distance", "weight", "item_weight").agg(
        F.sum(F.least("count", "item_count") * F.col("letters")).alias("shared")
    )
    similarity = F.col("shared") / (F.col("weight") + F.col("item_weight") - F.col("shared"))
    matches = shared.select("content", "item", "distance", similarity.alias("similarity")).where(F.col("similarity") >= limit)
    matches = matches.join(items.select("item", "item_id", "n_words"), "item")
    leaks = cut.select("k1", "k2", "content", "n_words", F.col("start").alias("start_word")).join(matches.drop("item"), ["content", "n_words"])
    leaks = materialize(leaks.drop("content"), "leaks")
    ids = docs.where(F.col("text").isNotNull()).select("doc_id", *_keys())
    return ids.join(leaks, ["k1", "k2"]).select(
        "doc_id", "k1", "k2", "item_id", "start_word", "n_words", "distance", "similarity"
    ).distinct()


def drop_leaks(docs: DataFrame, benchmark: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """The documents, with their own columns, in which no item was found."""
    leaks = find_leaks(docs.select("doc_id", "text"), benchmark, limit).select("k1", "k2").distinct()
    whole = docs.select(F.struct("*").alias("whole_row"), *_keys())
    return whole.join(leaks, ["k1", "k2"], "left_anti").select("whole_row.*")
