"""Language by compression: the text is encoded against a raw-content zstandard dictionary per language.

Learning takes a bounded, repeatable sample of labelled rows: of each language, whole texts in the order of a hash of their ids, as
many as fit into ``dictionary_bytes`` (250 kB, which is 100 to 200 texts of the given tables); texts longer than a twentieth of that
don't teach. Texts are lower-cased and what isn't a letter (Unicode category L) becomes a blank. A text is cut into pieces of
``PIECE`` characters, each piece is compressed with every dictionary, and the language with the smallest sum wins; so the
whole text counts and a long text's own history doesn't drown the dictionary. ``margin`` is the share of bytes that the
second language needs more; below ``min_margin`` the row is marked ``rejected`` (the prediction stays).

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled row every text is ``und``;
equal sums go to the language that comes first; rows without a label or text teach nothing; repeated rows are predicted
each; a very long text is compressed piece by piece; columns that have the names of the added ones give way to them. The
dictionaries are broadcast: ``dictionary_bytes`` for each language.
"""

from __future__ import annotations

import numpy as np
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.llm.common import hash60, map_texts

UNKNOWN = "und"
PIECE = 1500
ADDED = "lang_pred string, score double, margin double, rejected boolean"
OTHER = regex.compile(r"\P{L}+")
#: The sample is drawn so that it is this many times the dictionary on average; what doesn't fit is left out on the executors.
DRAWN = 3


def letters(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def learn_dictionaries(labelled: DataFrame, dictionary_bytes: int = 250_000) -> dict[str, bytes]:
    """One dictionary per language from ``doc_id, text, lang``; languages in order."""
    size, longest = F.octet_length("text"), dictionary_bytes // 20
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(size.between(1, longest))
    held = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.sum(size).alias("n")).collect()}  # one row a language
    if not held:
        return {}
    rate = F.create_map(*[F.lit(x) for lang, n in held.items() for x in (lang, min(1.0, DRAWN * dictionary_bytes / n))])[F.col("lang")]
    drawn = known.select("lang", "doc_id", "text", hash60(F.col("doc_id")).alias("place")).where(F.col("place") < rate * float(1 << 60))
    drawn = drawn.groupBy("lang", "text").agg(F.min("place").alias("place"))
    first = Window.partitionBy("lang").orderBy("place", "text")  # about DRAWN dictionaries
    rows = drawn.withColumn("end", F.sum(size + 1).over(first)).where(F.col("end") <= dictionary_bytes).collect()
    found = {}
    for lang in sorted(held):
        texts = [letters(r["text"]) for r in sorted(rows, key=lambda r: (r["place"], r["text"])) if r["lang"] == lang]
        found[lang] = "\n".join(texts).encode()[:dictionary_bytes]  # lower case may be longer by a few bytes
    return {k: v for k, v in found.items() if len(v) >= 8}


def _predictor(dictionaries: dict[str, bytes], min_margin: float):
    langs = list(dictionaries)

    def make():
        tools = []
        for lang in langs:
            raw = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=3)
            options = {"dict_data": raw, "write_content_size": False, "write_dict_id": False}
            tools.append(zstandard.ZstdCompressor(level=3, **options).compress)

        def one(text: str) -> tuple[str, float, float, bool]:
            text = letters(text)
            if not tools or not text:
                return UNKNOWN, 0.0, 0.0, True
            pieces = [text[i : i + PIECE].encode() for i in range(0, len(text), PIECE)]
            sizes = np.array([sum(len(f(p)) for p in pieces) for f in tools], dtype=float)
            best = int(sizes.argmin())
            second = np.partition(sizes, 1)[1] if len(sizes) > 1 else sizes[0] * 2
            margin = float((second - sizes[best]) / second)
            odds = np.exp2(-np.minimum(sizes - sizes[best], 60.0))
            return langs[best], float(1.0 / odds.sum()), margin, margin < min_margin

        return lambda texts: list(zip(*map(one, texts), strict=True)) if texts else [[]] * 4

    return make


def predict_language(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01, text: str = "text"
) -> DataFrame:
    """The other columns of ``docs`` with ``lang_pred, score, margin, rejected``."""
    return map_texts(docs, _predictor(dictionaries, min_margin), ADDED, text)
