"""Language, toxicity and quality: held-out accuracy, odd rows, and the parts against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.llm import langid, quality, toxicity
from tests.llm.conftest import words

PARTS = {"aa": "ka lo mi tun ser".split(), "bb": "zu rra fe gno piq".split(), "cc": "sch wör ßen äug tz".split()}


def prose(lang: str, seed: int, n: int = 60) -> str:
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(PARTS[lang], k=1 + r.randrange(3))) for _ in range(n)).capitalize() + "."


def test_language_on_new_texts(docs_frame):
    known = [(i, prose(lang, i), lang) for i, lang in enumerate(list(PARTS) * 40)]
    model = langid.learn_dictionaries(docs_frame(known))
    new = [(i, prose(lang, 1_000 + i, 3 + i), lang) for i, lang in enumerate(list(PARTS) * 10)]
    got = {r["doc_id"]: r for r in langid.predict_language(docs_frame(new).select("doc_id", "text"), model).collect()}
    assert all(got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1 for i, _, lang in new)
    mixed = [(1, prose("aa", 1, 50) + " " + prose("bb", 2, 51))]
    assert langid.predict_language(docs_frame(mixed).select("doc_id", "text"), model, min_margin=0.2).first()["rejected"]


def test_language_odd_rows(odd_docs, odd_rows, no_docs):
    model = langid.learn_dictionaries(odd_docs)
    got = langid.predict_language(odd_docs.select("doc_id", "text"), model).collect()
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert len(got) == len(odd_rows) and und == {1, 2, 3, 11, None}
    assert langid.learn_dictionaries(no_docs) == {}
    assert {r["lang_pred"] for r in langid.predict_language(odd_docs.select("doc_id", "text"), {}).collect()} == {"und"}
    assert langid.predict_language(no_docs.select("doc_id", "text"), model).count() == 0


def test_language_against_plain_compression(docs_frame):
    """Each piece compressed with each dictionary, one at a time."""
    import zstandard

    model = langid.learn_dictionaries(docs_frame([(i, prose(lang, i), lang) for i, lang in enumerate(list(PARTS) * 40)]))
    texts = [prose(lang, 2_000 + i, 2 + 37 * i) for i, lang in enumerate(list(PARTS) * 5)] + ["x", "Ärger, 12 mal!"]
    got = {r.doc_id: r for r in langid.predict_language(docs_frame(list(enumerate(texts))).select("doc_id", "text"), model).collect()}
    for i, text in enumerate(texts):
        plain = "".join(c if c.isalpha() else " " for c in text.lower())
        plain = " ".join(plain.split())
        sizes = {}
        for lang, held in model.items():
            tool = zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(held, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False
            )
            sizes[lang] = sum(len(tool.compress(plain[k : k + 1500].encode())) for k in range(0, len(plain), 1500))
        best, second = sorted(sizes.values())[:2]
        assert sizes[got[i].lang_pred] == best and got[i].margin == pytest.approx((second - best) / second)
        assert got[i].score == pytest.approx(1 / sum(2.0 ** -min(n - best, 60) for n in sizes.values()))


def test_dictionaries_hold_whole_texts_in_hash_order(docs_frame):
    rows = [(i, prose("aa", i, 20), "aa") for i in range(200)] + [(900, prose("aa", 900, 5_000), "aa"), (901, prose("bb", 1, 30), "bb")]
    model = langid.learn_dictionaries(docs_frame(rows), 6_000)
    known = {langid.letters(t) for _, t, _ in rows}
    taught = model["aa"].decode().split("\n")
    assert set(taught) <= known and 3_000 < len(model["aa"]) <= 6_000 and len(model["bb"]) < 300
    assert model == langid.learn_dictionaries(docs_frame(rows[::-1]).repartition(3), 6_000)


def test_numbers_are_no_letters(docs_frame):
    model = langid.learn_dictionaries(docs_frame([(i, prose(lang, i), lang) for i, lang in enumerate(list(PARTS) * 9)]))
    rows = list(enumerate(["½", "²³", "①Ⅷ", "١٢", "_", "é", "中"]))
    docs = docs_frame(rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "margin")
    got = langid.predict_language(docs.select("doc_id", "text", "score", "margin"), model)
    assert got.columns == ["doc_id", "lang_pred", "score", "margin", "rejected"]
    assert {r.doc_id for r in got.collect() if r.lang_pred == "und"} == {0, 1, 2, 3, 4}


BAD = ["vilest", "rotter", "dunce"]


def comment(seed: int, toxic: bool) -> str:
    r, text = random.Random(seed), words(seed, 20 + seed % 50)
    for _ in range(2 * toxic):
        text.insert(r.randrange(len(text)), r.choice(BAD))
    return " ".join(text[:10]) + ". " + " ".join(text[10:])


def test_toxic_scores_and_spans(spark, docs_frame):
    rows = [(i, comment(i, i % 5 == 0)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 600, 2)] + [(601, 1), (2, None)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs_frame(rows), labels)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs_frame(rows).select("doc_id", "text"), model, spans=True).collect()}
    assert all((got[i]["score"] >= 0.5) == (i % 5 == 0) for i, _ in rows)
    for i, text in rows:
        found = [text[s["start"] : s["end"]].split() for s in got[i]["spans"]]
        assert set(itertools.chain(*found)) == {w for w in text.replace(".", "").split() if w in BAD}
    kept = toxicity.drop_toxic(docs_frame(rows), model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows if i % 5}


def word_list(texts, labels, new):
    """Toxic if a word is there that is seen three times in toxic texts and never in clean ones."""
    seen = {0: Counter(), 1: Counter()}
    for t, y in zip(texts, labels, strict=True):
        seen[y].update(set(t.replace(".", "").split()))
    bad = {w for w, n in seen[1].items() if n >= 3 and not seen[0][w]}
    return [bool(bad & set(t.replace(".", "").split())) for t in new]


def scores(model, texts):
    return np.array(toxicity._scorer(model, False)()(texts)[0]) >= 0.5


def test_a_word_is_toxic_in_one_context_only():
    """"bull fool" is toxic; "bull" and "fool" come in clean texts, too, and next to other words."""

    def text(seed, toxic):
        r, t = random.Random(seed), words(seed, 30)
        t[r.randrange(5, 12) : 1] = ["bull", "fool"] if toxic else ["fool", "bull"] if seed % 2 else ["bull", r.choice(t), "fool"]
        return " ".join(t)

    texts, labels = [text(i, i % 3 == 0) for i in range(900)], [int(i % 3 == 0) for i in range(900)]
    new, truth = [text(5_000 + i, i % 2 == 0) for i in range(200)], np.array([i % 2 == 0 for i in range(200)])
    field_right = (scores(toxicity.train(texts, labels), new) == truth).mean()
    list_right = (np.array(word_list(texts, labels, new)) == truth).mean()
    assert field_right > 0.95 and field_right > list_right + 0.2


def test_spellings_that_were_not_seen():
    def text(seed, toxic, ends):
        r, t = random.Random(seed), words(seed, 30)
        if toxic:
            t[r.randrange(len(t))] = "grubblork" + "".join(r.choice(ends) for _ in range(4))
        return " ".join(t)

    texts, labels = [text(i, i % 3 == 0, "abcdefgh") for i in range(600)], [int(i % 3 == 0) for i in range(600)]
    new, truth = [text(5_000 + i, i % 2 == 0, "ijklmnop") for i in range(200)], np.array([i % 2 == 0 for i in range(200)])
    field_right = (scores(toxicity.train(texts, labels), new) == truth).mean()
    assert field_right > 0.95 and field_right > (np.array(word_list(texts, labels, new)) == truth).mean() + 0.3


def test_targets_against_all_taggings():
    """Probabilities of tokens and transitions given that something in the document is toxic, less the plain ones."""
    rng = np.random.default_rng(3)
    score, moves, first = rng.normal(-1, 1, 6), rng.normal(0, 1, (2, 2)), np.array([1, 0, 0, 1, 0, 0], bool)
    p, joint, factor = toxicity.forward_backward(score, first, moves)
    inner = np.flatnonzero(~first)
    for toxic in (True, False):
        total, mass, steps = 0.0, np.zeros(6), np.zeros((4, len(inner)))
        for tags in itertools.product((0, 1), repeat=6):
            if (sum(tags) > 0) == toxic:
                value = sum(score[i] * t for i, t in enumerate(tags)) + sum(moves[tags[i - 1], tags[i]] for i in inner)
                total += np.exp(value)
                mass += np.exp(value) * np.array(tags)
                for k, i in enumerate(inner):
                    steps[2 * tags[i - 1] + tags[i], k] += np.exp(value)
        more, moved = toxicity.latent_targets(p, joint, factor, first, np.zeros(6, int), np.array([toxic]), moves[0, 0])
        assert more == pytest.approx(mass / total - p)
        assert moved == pytest.approx(steps / total - joint)


def test_long_chains_are_cut():
    first = np.zeros(250, bool)
    first[[0, 30, 245]] = True
    assert np.flatnonzero(toxicity.cut_chains(first)).tolist() == [0, 30, 130, 230, 245]
    assert toxicity.cut_chains(first[:0]).tolist() == []


def test_field_is_fitted_to_all_tokens():
    """A toxic word in texts behind the first 300,000 tokens of the toxic ones gets its weight."""
    long = " ".join(words(1, 1_000))
    texts = [f"a{i} {long}" for i in range(310)] + [f"b{i} vilest " + comment(i, False) for i in range(60)] + [comment(i, False) for i in range(200)]
    model = toxicity.train(texts, [1] * 370 + [0] * 200, steps=5)
    assert model.own[model.words["vilest"]] > 1


def test_marginals_against_all_taggings():
    rng = np.random.default_rng(2)
    score, moves = rng.normal(0, 2, 9), rng.normal(0, 1, (2, 2))
    first = np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], bool)
    p, pairs = toxicity.marginals(score, first, moves)
    total, mass, steps = 0.0, np.zeros(9), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=9):
        value = sum(score[i] * t for i, t in enumerate(tags)) + sum(moves[tags[i - 1], tags[i]] for i in range(9) if not first[i])
        weight = np.exp(value)
        total += weight
        mass += weight * np.array(tags)
        for i in range(9):
            if not first[i]:
                steps[tags[i - 1], tags[i]] += weight
    assert p == pytest.approx(mass / total)
    assert pairs == pytest.approx(steps / total)


def test_offsets_are_those_of_the_text():
    texts = ["İİ dunce x", "DUNCE! dunce\ndunce"]
    _, first, docs, at = toxicity.tokens_of(texts, {"dunce": 1}, spans=True)
    assert [texts[d][a:b].lower() for d, (a, b) in zip(docs, at, strict=True)][-4:] == ["x", "dunce", "dunce", "dunce"]
    ids, *_ = toxicity.tokens_of(["DUNCE! dunce\ndunce"], {"dunce": 1})
    assert ids.tolist() == [1, 1, 1] and first[-3:].all()


def page(seed: int, good: bool) -> str:
    text = " ".join(words(seed, 15 + seed % 300))
    return text if good else text.upper().replace(" ", "!! ") if seed % 4 else text.replace(" ", " | ")


def test_quality_on_new_texts(spark, docs_frame):
    rows = [(i, page(i, i % 3 > 0)) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 900, 2)] + [(3, None)], "doc_id bigint, quality int")
    model = quality.learn(docs_frame(rows), labels)
    got = quality.score_quality(docs_frame(rows).select("doc_id", "text"), model).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in got]) > 0.98


def test_quality_score_of_a_text_stands_alone():
    texts = [page(i, i % 2 > 0) * (1 + i % 5) for i in range(60)]
    model = quality.train(texts, [i % 2 for i in range(60)], epochs=1)
    together = quality.score_texts(model, [*texts, "", "x"])
    alone = [quality.score_texts(model, [t])[0] for t in [*texts, "", "x"]]
    assert together == pytest.approx(alone, abs=1e-5)


def test_quality_against_a_plain_loop():
    """Each chunk by itself, each place and filter by itself."""
    texts = [page(i, i % 2 > 0) * (1 + i % 3) for i in range(40)] + ["", "ä", "x" * 300]
    m = quality.train(texts, [i % 2 for i in range(len(texts))], epochs=1)
    width = quality.STRIDE * quality.EMBED
    for text, score in zip(texts, quality.score_texts(m, texts), strict=True):
        raw = text.encode()
        n = max(2, -(-len(raw) // quality.HALF))
        raw = raw.ljust(n * quality.HALF, b"\0")
        pooled = []
        for k in range(n - 1):
            chunk = raw[k * quality.HALF : (k + 2) * quality.HALF]
            parts = [np.concatenate([m.embed[b] for b in chunk[i : i + quality.STRIDE]]) for i in range(0, len(chunk), quality.STRIDE)]
            assert len(parts[0]) == width
            best = [max(max(0.0, float(x @ m.left[:, f] + y @ m.right[:, f] + m.bias[f])) for x, y in zip(parts, parts[1:], strict=False)) for f in range(quality.FILTERS)]
            pooled.append(best)
        z = float(np.concatenate((np.mean(pooled, 0), np.max(pooled, 0))) @ m.out + m.out_bias[0])
        assert score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_one_label_in_the_sample_gives_the_share():
    assert quality.train(["a", "b"], [1, 1], share=0.75).base_rate == 0.75
    assert quality.train(["a", "b"], [1, 1]).base_rate == 1.0


def test_every_byte_is_read():
    """A pattern anywhere in a long text moves the score."""
    texts = [page(i, i % 2 > 0) for i in range(200)]
    model = quality.train(texts, [i % 2 for i in range(200)])
    good = " ".join(words(77, 2_000))
    plain = quality.score_texts(model, [good])[0]
    for at in (0, len(good) // 2 + 1, len(good) - 200):
        assert quality.score_texts(model, [good[:at] + "BAD!! WORDS!! " * 14 + good[at + 196 :]])[0] < plain


@pytest.mark.parametrize("learn, score, column", [
    (toxicity.learn, toxicity.score_toxicity, "toxic"), (quality.learn, quality.score_quality, "quality"),
])
def test_odd_rows(spark, odd_docs, odd_rows, no_docs, learn, score, column):
    labels = spark.createDataFrame([(1, 0), (4, 1), (5, 1), (5, 1), (9, None), (None, 1), (99, 0)], f"doc_id bigint, {column} int")
    for some in (labels, labels.where(f"{column} = 1"), labels.limit(0)):
        model = learn(odd_docs, some)
        got = score(odd_docs.select("doc_id", "text"), model).collect()
        assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
        assert score(no_docs.select("doc_id", "text"), model).count() == 0
    kept = toxicity.drop_toxic(odd_docs, toxicity.ToxicModel())
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows)


@pytest.mark.parametrize("learn, score, column", [
    (toxicity.learn, toxicity.score_toxicity, "toxic"), (quality.learn, quality.score_quality, "quality"),
])
def test_given_columns_give_way_to_added_ones(spark, docs_frame, learn, score, column):
    docs = docs_frame([(i, " ".join(words(i, 20)) + " vilest" * (i % 2)) for i in range(40)])
    model = learn(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], f"doc_id bigint, {column} int"))
    given = docs.select("doc_id", "text").withColumns({c: F.lit("extra") for c in ("score", "top_marginal", "kept")})
    got = score(given, model)
    assert len(set(got.columns)) == len(got.columns) and dict(got.dtypes)["score"] == "double" and "kept" in got.columns
    assert {r.doc_id: r.score for r in got.collect()} == {r.doc_id: r.score for r in score(docs.select("doc_id", "text"), model).collect()}
