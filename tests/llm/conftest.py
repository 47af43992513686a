from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside.
CLASHING = (
    "size", "hash", "score", "node", "band", "key", "k1", "k2", "words", "whole_row", "row", "copies", "start", "n", "range",
    "label", "spans", "part", "bucket", "class_id", "item_id", "predicted", "shard", "slot", "held_out",
)


def words(seed: int, n: int, pool: int = 5_000) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(2 + r.randrange(pool) % 7)) for _ in range(n)]


@pytest.fixture
def docs_frame(spark):
    """Rows of (doc_id, text, lang, source) to a documents frame."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def odd_rows():
    """Nulls everywhere, empty and blank texts, ties, a repeated row, a very long text, many code points."""
    long = " ".join(words(1, 40_000))
    near = words(2, 60)
    return [
        (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "word", "en", "b"), (5, long, "de", "b"),
        (6, "word", None, "b"), (7, " ".join(near), "en", "c"), (8, " ".join(near[:-1] + ["changed"]), "en", "c"),
        (9, "x" * 3_000, "en", "c"), (10, "ÄÖ 🙂 ñ " * 30, "de", "a"), (10, "ÄÖ 🙂 ñ " * 30, "de", "a"),
        (None, "a text without id", "en", None), (None, None, None, None), (11, "...!!!", "en", "b"),
    ]


@pytest.fixture
def odd_docs(docs_frame, odd_rows):
    from pyspark.sql import functions as F

    return docs_frame(odd_rows).withColumns({c: F.lit("extra") for c in CLASHING})


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
