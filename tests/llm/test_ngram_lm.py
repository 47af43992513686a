from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from demandgrid.llm import ngram_lm
from demandgrid.llm.elias_fano import EliasFano, load, save
from demandgrid.llm.queries import op3_language_model


def tokens(text: str) -> list[bytes]:
    return [*(text or "").encode().lower().split(), b"\n"]


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts: list[str], order: int, least: int):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for t in map(tokens, texts):
            for n in range(1, order + 1):
                if n == 1:
                    self.counts[1].update((w,) for w in t)
                    continue
                padded = [b"<s>", *t]
                self.counts[n].update(tuple(padded[i : i + n]) for i in range(len(padded) - n + 1))
        self.total, self.vocabulary = sum(self.counts[1].values()), len(self.counts[1])
        self.texts = len(texts)
        for n in range(2, order + 1):
            kept = {g: c for g, c in self.counts[n].items() if c >= least}
            if n > 2:
                kept = {g: c for g, c in kept.items() if g[:-1] in self.counts[n - 1]}
            self.counts[n] = kept
        once = sum(c == 1 for c in self.counts[1].values())
        self.d = min(0.9, max(0.01, once / self.vocabulary))
        self.after = [defaultdict(list) for _ in range(order + 1)]
        for n in range(2, order + 1):
            for g, c in self.counts[n].items():
                self.after[n][g[:-1]].append(c)

    def p(self, context: tuple, word: bytes) -> float:
        if not context:
            c = self.counts[1].get((word,), 0)
            return (c - self.d) / self.total if c else self.d * self.vocabulary / self.total
        n = len(context) + 1
        kept = self.after[n].get(context)
        if not kept:
            return self.p(context[1:], word)
        times = self.texts if context == (b"<s>",) else self.counts[n - 1][context]
        own = self.counts[n].get((*context, word), 0)
        gamma = (times - sum(kept) + ngram_lm.DISCOUNT * len(kept)) / times
        lower = self.p(context[1:] if context != (b"<s>",) else (), word)
        if len(context) > 1 and context[1:] == (b"<s>",):
            lower = self.p((), word)
        return max(0, own - ngram_lm.DISCOUNT) / times + gamma * lower

    def score(self, text: str) -> float:
        padded, s = [b"<s>", *tokens(text)], 0.0
        for i in range(1, len(padded)):
            s += math.log10(self.p(tuple(padded[max(0, i - self.order + 1) : i]), padded[i]))
        return s


def corpus(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "dog", "cat", "saw", "ran", "É", *(f"w{i}" for i in range(60))]
    return [" ".join(r.choices(vocabulary, k=r.randrange(25))) + "  \x0b" * (i % 2) for i, _ in enumerate(range(n))]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_dictionaries(docs_frame, order):
    train, test = corpus(1, 120), [*corpus(2, 30), "unknown words only", "", "the", "the the the of unknown the dog"]
    model = ngram_lm.train(docs_frame(list(enumerate(train))), order=order)
    want = Plain(train, order, 2)
    rows = ngram_lm.score_texts(docs_frame(list(enumerate(test))).select("doc_id", "text"), model).collect()
    assert model.tokens == want.total and model.words == want.vocabulary
    for r in rows:
        t = tokens(test[r["doc_id"]])
        count = [want.counts[1].get((w,), 0) for w in t]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c > 0 for c in count), want.total)
        base = sum(math.log10((c + 0.5) / (want.total + 0.5 * (want.vocabulary + 1))) for c in count)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] == pytest.approx(want.score(test[r["doc_id"]]), rel=2e-3)


def test_query_counts_ngrams_seen_once(spark, docs_frame, tmp_path):
    texts = corpus(4, 60)
    docs_frame(list(enumerate(texts))).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op3_language_model(spark, str(tmp_path)).collect()
    whole, pruned = (Plain([texts[r["doc_id"]] for r in rows if not r["held_out"]], 3, least) for least in (1, 2))
    assert {r["held_out"] for r in rows} == {True, False} and len(rows) == len(texts)
    for r in rows:
        assert r["score"] == pytest.approx(whole.score(texts[r["doc_id"]]), rel=2e-3)
    assert any(abs(whole.score(t) / pruned.score(t) - 1) > 1e-2 for t in texts)


def test_too_many_contexts_raise(docs_frame):
    numbered = docs_frame([(1, "a")]).selectExpr("cast(text as binary) AS ids")
    model = ngram_lm.Model(levels=[[ngram_lm.Part("", 0, 0, 0, 1 << 31, 1)]], words=1)
    with pytest.raises(ValueError, match="do not fit"):
        ngram_lm.train_levels(numbered, model)


def test_probabilities_add_up(docs_frame):
    train = corpus(3, 80)
    want = Plain(train, 3, 2)
    known = [w for (w,) in want.counts[1]]
    for context in [(), (b"the",), (b"<s>",), (b"<s>", b"the"), (b"of", b"the")]:
        total = sum(want.p(context, w) for w in known) + want.p(context, b"never seen")
        assert total == pytest.approx(1)


def test_tokens_are_ascii_words():
    texts = ["", None, "  Ab cÉ\x0bx\x0c\n ", " ", "a\x1c b\x85 ÀB"]
    t = ngram_lm.tokenize(pa.array(texts, pa.string()))
    assert t.counts.tolist() == [len(tokens(x)) for x in texts]
    words = sorted({w for x in texts for w in tokens(x)})
    assert len(t.hashes) == len(words) and (np.diff(t.hashes) > 0).all()


def test_elias_fano_round_trip(tmp_path):
    rng = np.random.default_rng(1)
    for most, n in ((2**63, 4), (10**7, 3_000), (900, 800), (1, 1), (10, 0)):
        values = np.unique(rng.integers(0, most, n, dtype=np.uint64))
        save(str(tmp_path / "x"), s=EliasFano.of(values), book=np.arange(3.0))
        s = load(str(tmp_path / "x"))["s"]
        assert (s.get(np.arange(len(values))) == values).all()
        asked = np.concatenate((values, rng.integers(0, most + 9, 500, dtype=np.uint64)))
        place = {int(v): i for i, v in enumerate(values)}
        assert s.find(asked).tolist() == [place.get(int(v), -1) for v in asked]
    steps = np.cumsum(rng.integers(0, 3, 500))
    assert (EliasFano.of(steps).get(np.arange(500)) == steps).all()


def test_given_columns_give_way_to_added_ones(odd_docs):
    names = ["score", "ids", "n_tokens", "n_known", "base_score", "train_tokens"]
    docs = odd_docs.select("doc_id", "text").withColumns({c: F.lit("extra") for c in [*names, "kept"]})
    model = ngram_lm.train(odd_docs)
    got = ngram_lm.score_texts(docs, model)
    assert sorted(got.columns) == sorted(["doc_id", "kept", *[n for n in names if n != "ids"]]) and dict(got.dtypes)["score"] == "double"
    plain = {(r.doc_id, r.score) for r in ngram_lm.score_texts(odd_docs.select("doc_id", "text"), model).collect()}
    assert {(r.doc_id, r.score) for r in got.collect()} == plain


def test_odd_rows(odd_docs, odd_rows, no_docs):
    model = ngram_lm.train(odd_docs)
    got = ngram_lm.score_texts(odd_docs.select("doc_id", "text"), model).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(tokens(r[1])) for r in odd_rows)
    assert all(math.isfinite(r["score"]) for r in got)
    empty = ngram_lm.train(no_docs)
    assert {(r["n_known"], r["score"]) for r in ngram_lm.score_texts(odd_docs.select("doc_id", "text"), empty).collect()} == {(0, 0.0)}
    assert ngram_lm.score_texts(no_docs.select("doc_id", "text"), model).count() == 0
