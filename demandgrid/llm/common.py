"""What the corpus operators share: reading tables, hold-out rows, words, sampling of labelled rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from demandgrid.session import materialize, scratch_path

__all__ = [
    "WORD", "chunks_of", "clean_text", "fit_in_a_task", "hash60", "held_out", "labelled_sample", "map_texts", "materialize", "rate_below", "scratch_path", "table",
    "with_row",
]

#: A word: a run of anything but the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_text(text: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def hash60(*columns: Column) -> Column:
    """60 bits of the MD5 of the first non-null column as text: the same number in any engine that has MD5."""
    key = F.coalesce(*[c.cast("string") for c in columns], F.lit(""))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint")


def rate_below(key: Column, rate: Column) -> Column:
    """A repeatable sample: the rows whose hash, as a share of all hashes, is below ``rate``."""
    return hash60(key) < F.least(rate, F.lit(1.0)) * float(1 << 60)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, wanted: dict[int, int], most_bytes: int = 24_000_000
) -> tuple[DataFrame, dict[int, int]]:
    """``text, label`` of a sample, and how many ids have each label.

    Bounded in rows and in bytes: texts longer than a hundredth of ``most_bytes`` don't teach, and of each label whole texts are
    taken in the order of a hash of their ids until ``most_bytes`` are reached. A repeatable sample with about ``wanted[y]`` ids of label ``y``. It is drawn from the narrow label table, so its ids (as many as
    wanted) can be broadcast and no text but the sample's is moved. Other and null labels are left out; equal rows come once.
    """
    known = labels.where(F.col(label).isin(*wanted)).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row per label
    rate = F.lit(0.0)
    for y, n in counts.items():
        rate = F.when(F.col("label") == y, wanted[y] / n).otherwise(rate)
    chosen = known.where(rate_below(F.col("doc_id"), rate))
    rows = docs.select("doc_id", clean_text().alias("text")).where(F.octet_length("text") <= most_bytes // 100)
    rows = rows.join(F.broadcast(chosen), "doc_id").groupBy("text", "label").agg(F.min(hash60(F.col("doc_id"))).alias("place"))
    first = Window.partitionBy("label").orderBy("place", "text")  # as many rows as wanted
    rows = rows.withColumn("end", F.sum(F.octet_length("text")).over(first)).where(F.col("end") <= most_bytes).select("text", "label")
    return rows, counts


def fit_in_a_task(sample: DataFrame, train: Callable[[list[str], list[int]], object]) -> dict:
    """The fields of what ``train`` makes of the texts and labels of a bounded sample, in order of the texts.

    One task holds the sample and fits; the driver only gets the fields. A task that is lost is run again, with the same result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int]] = []
        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("text", "label")), strict=True)
        rows.sort()
        model = train([t for t, _ in rows], [y for _, y in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(dict(vars(model)))], pa.binary())], ["fields"])

    found = sample.select("text", "label").repartition(1).mapInArrow(run, "fields binary").first()
    return pickle.loads(found["fields"]) if found else dict(vars(train([], [])))  # without rows there is no task


def chunks_of(texts: Sequence[str], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts with about ``most`` characters together, one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def with_row(docs: DataFrame) -> DataFrame:
    """All columns in one struct, so that added columns can't clash with them."""
    return docs.select(F.struct("*").alias("whole_row"))


def map_texts(
    df: DataFrame, make: Callable[[], Callable[[list[str]], list]], added: str, text: str = "text"
) -> DataFrame:
    """Add columns worked out from texts, Arrow batch by Arrow batch.

    ``make`` runs once in each task and returns a function from texts (nulls as empty) to one list or array per added column.
    ``text`` is dropped; with ``whole_row.text`` it is read from the struct and the struct is kept as it is. Columns that have
    the name of an added one are dropped.
    """
    new = T.StructType.fromDDL(added)
    kinds = [to_arrow_type(f.dataType) for f in new]
    outer, _, inner = text.partition(".")
    names = [f.name for f in df.schema if (inner or f.name != outer) and f.name not in new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            column = batch.column(outer)
            texts = [t or "" for t in (pc.struct_field(column, inner) if inner else column).to_pylist()]
            columns = work(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names + [f.name for f in new],
            )

    return df.mapInArrow(run, T.StructType([f for f in df.schema if f.name in names] + list(new)))
