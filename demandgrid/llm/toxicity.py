"""Toxic spans by a linear-chain conditional random field over tokens.

Two states per token (clean, toxic) in chains that end with a sentence, or after ``CHAIN`` tokens. A token's score for the toxic state is
the sum of a bias and of weights for its word, the words before and after it, its runs of four and six letters (hashed) and
its shape (small, capitalised, capitals, with digits); the transitions have weights as well.

Labels are given for documents only, so token labels are latent: of a clean document no token is toxic, of a toxic one at least
one is. The field is fitted by ascent on the likelihood of exactly that: forward-backward gives for each document the
probability P that all is clean, and the marginals given that something is toxic are the plain ones over 1 - P. A word that is toxic only
beside certain others, or a spelling that was not seen, gets its score from the neighbours and the runs of letters.

The marginals of a document (largest, and the sum of all) give its score by a logistic fit on the document labels.

Limits: ``sample_docs`` toxic and ``CLEAN_SHARE`` times as many clean rows on average are learned from, ``SAMPLE_BYTES`` of text of either
label at most, all of their tokens; one task fits. Words seen at least ``SEEN`` times have weights of their own, the ``vocabulary`` commonest of
them; others are known by their runs of letters and shape. Scoring reads whole texts.

Defined cases: a null or empty text has no tokens and gets the score of a text without any toxic mass; without toxic or
without clean labelled rows every score is the share of toxic labels (0 without labels); null labels teach nothing;
repeated rows teach once and are scored each; a very long text is scored by itself, with about 60 bytes a token; columns that have the
names of added ones give way to them; spans are character offsets in the text as it is, ``end`` exclusive.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import islice
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import chunks_of, fit_in_a_task, labelled_sample, map_texts, with_row

TOKEN = re.compile(r"\w+|[.!?\n]+")
ENDS = ".!?\n"
SUB_BATCH, FORMS_HELD = 1_000_000, 300_000
CLEAN_SHARE, SAMPLE_BYTES = 3, 24_000_000
SEEN = 3
#: Tokens whose gradient is worked out at once, and the longest chain.
PIECE, CHAIN = 300_000, 100
GRAM_LENGTHS, GRAMS, SHAPES = (4, 6), 1 << 17, 4
#: Steps of the ascent: their size, what keeps those of rare features small, and the pull to zero.
RATE, CALM, PULL = 1.0, 0.5, 0.05
FIRST_BIAS = -6.0


@dataclass
class ToxicModel:
    """Words and their ids (0: any other, the last: a chain's end), weights for the toxic state, transitions, and the document's fit."""

    words: dict[str, int] = field(default_factory=dict)
    own: np.ndarray = field(default_factory=lambda: np.zeros(2))
    before: np.ndarray = field(default_factory=lambda: np.zeros(2))
    after: np.ndarray = field(default_factory=lambda: np.zeros(2))
    grams: np.ndarray = field(default_factory=lambda: np.zeros(GRAMS))
    shapes: np.ndarray = field(default_factory=lambda: np.zeros(SHAPES))
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray | None = None
    base_rate: float = 0.0


class Forms(NamedTuple):
    """Of each distinct token as it is written: its word, its runs of letters (all in a row, and how many it has) and its shape."""

    word: np.ndarray
    grams: np.ndarray
    counts: np.ndarray
    shape: np.ndarray


def coded(texts: list[str], places: dict[str, int], spans: bool = False):
    """Number of each token's form (new forms are added to ``places``), chain starts, tokens of each text, and offsets if asked for."""
    index, first, counts, at = array("i"), bytearray(), [], []
    for text in texts:
        new, before = True, len(index)
        for m in TOKEN.finditer(text) if spans else TOKEN.findall(text):
            word = m[0] if spans else m
            if word[0] in ENDS:
                new = True
                continue
            index.append(places.setdefault(word, len(places)))
            first.append(new)
            new = False
            if spans:
                at.append(m.span())
        counts.append(len(index) - before)
    return np.frombuffer(index, np.int32) if index else np.zeros(0, np.int32), np.frombuffer(first, bool), np.array(counts, np.int64), at


def tokens_of(texts: list[str], words: dict[str, int], spans: bool = False):
    """Word ids, chain starts, document of each token, and character offsets if asked for."""
    places: dict[str, int] = {}
    index, first, counts, at = coded(texts, places, spans)
    ids = np.array([words.get(t.lower(), 0) for t in places], np.int64)
    return ids[index] if len(index) else np.zeros(0, np.int64), first, np.repeat(np.arange(len(texts)), counts), at


class Buckets(dict):
    """Hash bucket of each run of letters."""

    def __missing__(self, gram: str) -> int:
        self[gram] = bucket = xxhash.xxh3_64_intdigest(gram) % GRAMS
        return bucket


def shape_of(token: str, low: str) -> int:
    if token == low and low.isalpha():
        return 0
    return 3 if any(c.isdigit() for c in low) else 2 if len(low) > 1 and token.isupper() else 1


def forms_of(tokens: list[str], words: dict[str, int]) -> Forms:
    bucket, word, shape, counts, grams = Buckets(), [], [], [], []
    for token in tokens:
        low = token.lower()
        word.append(words.get(low, 0))
        shape.append(shape_of(token, low))
        padded = f"^{low}$"
        own = [bucket[padded[i : i + n]] for n in GRAM_LENGTHS for i in range(max(1, len(padded) - n + 1))]
        counts.append(len(own))
        grams += own
    return Forms(np.array(word, np.int32), np.array(grams, np.int32), np.array(counts, np.int32), np.array(shape, np.uint8))


def cut_chains(first: np.ndarray) -> np.ndarray:
    """Chain starts, with more of them where a chain is longer than ``CHAIN``."""
    at = np.arange(len(first))
    return first | ((at - np.maximum.accumulate(np.where(first, at, 0))) % CHAIN == 0) if len(first) else first


def form_scores(model: ToxicModel, forms: Forms) -> np.ndarray:
    """What a form adds to the score by itself."""
    if not len(forms.word):
        return np.zeros(0)
    ends = np.cumsum(forms.counts)
    grams = np.add.reduceat(model.grams[forms.grams], ends - forms.counts) / np.sqrt(forms.counts)
    return model.own[forms.word] + model.shapes[forms.shape] + grams


def neighbours(word: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Words before and after each token; ``end`` where its chain begins or ends."""
    before, after = np.full(len(word), end, word.dtype), np.full(len(word), end, word.dtype)
    inner = np.flatnonzero(~first)
    before[inner], after[inner - 1] = word[inner - 1], word[inner]
    return before, after


def emissions(model: ToxicModel, own: np.ndarray, word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Toxic-state score of each token, the clean state's being 0."""
    before, after = neighbours(word, first, len(model.own) - 1)
    return model.bias + own + model.before[before] + model.after[after]


def _by_place(first: np.ndarray) -> Iterator[np.ndarray]:
    """Token indexes at place 0, 1, 2 … of their chains, all chains at once, longest chain first."""
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(first)))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    for place, n in enumerate(alive):
        yield starts[:n] + place


def forward_backward(score: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability that each token is toxic; of each token that is not a chain's first, the probability of the transitions
    (clean-clean, clean-toxic, toxic-clean, toxic-toxic) to it; and the logarithm of each token's factor in the chain's sum.

    Scaled forward-backward. ``a``: probability of the toxic state given the tokens up to here; ``b``: what the tokens after
    it say, normalised over the two states.
    """
    e, t = np.exp(np.clip(score, -30, 30)), np.exp(moves)
    a, b, factor = np.empty(len(score)), np.full(len(score), 0.5), np.empty(len(score))
    places = list(_by_place(first))
    for k, at in enumerate(places):
        if k == 0:
            clean, toxic = 1.0, e[at]
        else:
            p = a[at - 1]
            clean, toxic = t[0, 0] * (1 - p) + t[1, 0] * p, e[at] * (t[0, 1] * (1 - p) + t[1, 1] * p)
        factor[at] = clean + toxic
        a[at] = toxic / factor[at]
    for at in reversed(places[1:]):
        clean, toxic = 1 - b[at], e[at] * b[at]
        back = (t[1, 0] * clean + t[1, 1] * toxic) / ((t[0, 0] + t[1, 0]) * clean + (t[0, 1] + t[1, 1]) * toxic)
        b[at - 1] = back
    odds = a * b / np.maximum((1 - a) * (1 - b), 1e-300)
    p = odds / (1 + odds)
    inner = np.flatnonzero(~first)
    pa, eb, bb = a[inner - 1], e[inner], b[inner]
    joint = np.stack([
        (1 - pa) * t[0, 0] * (1 - bb), (1 - pa) * t[0, 1] * eb * bb, pa * t[1, 0] * (1 - bb), pa * t[1, 1] * eb * bb
    ])
    return p, joint / joint.sum(0), np.log(factor)


def marginals(score: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each token is toxic; and the expected transitions, (2, 2) summed over all neighbours."""
    p, joint, _ = forward_backward(score, first, moves)
    return p, joint.sum(1).reshape(2, 2)


def summaries(p: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Of each document: bias, largest marginal, log of one plus the sum of the marginals."""
    top, total = np.zeros(n), np.zeros(n)
    np.maximum.at(top, docs, p)
    np.add.at(total, docs, p)
    return np.stack([np.ones(n), top, np.log1p(total)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _vocabulary(places: dict[str, int], seen: np.ndarray, size: int) -> dict[str, int]:
    """Ids, from 1, of the commonest words that are seen often enough."""
    counts: dict[str, int] = {}
    for token, n in zip(places, seen.tolist(), strict=True):
        low = token.lower()
        counts[low] = counts.get(low, 0) + n
    common = sorted((-n, w) for w, n in counts.items() if n >= SEEN)[:size]
    return {w: i + 1 for i, (_, w) in enumerate(common)}


def latent_targets(p: np.ndarray, joint: np.ndarray, factor: np.ndarray, first: np.ndarray, docs: np.ndarray, toxic: np.ndarray, stay: float):
    """What the labels add to the probabilities of tokens and transitions, given the plain ones.

    ``docs`` numbers each token's document from 0, ``toxic`` says which of them are; ``stay`` is the weight of clean-clean. In a clean
    document all is clean. In a toxic one that is the one thing ruled out: with the probability P of it, the others grow by
    P / (1 - P) of theirs.
    """
    inner = np.flatnonzero(~first)
    all_clean = stay * np.bincount(docs[inner], minlength=len(toxic)) - np.bincount(docs, factor, len(toxic))
    grow = np.where(toxic, np.exp(all_clean) / np.maximum(-np.expm1(all_clean), 1e-6), -1.0)
    moved = joint.copy()
    moved[0] -= 1.0
    return grow[docs] * p, moved * grow[docs[inner]]


def _fit_documents(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Newton's steps of a logistic fit with a ridge."""
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        q = _sigmoid(x @ weights)
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        weights += np.linalg.solve(hessian, x.T @ (label - q) - 0.05 * weights)
    return weights


def train(texts: list[str], labels: list[int], vocabulary: int = 50_000, steps: int = 40) -> ToxicModel:
    """Fit the field and the document score to all tokens of texts with labels 0 and 1."""
    label = np.array(labels, np.int64)
    if not len(label) or label.min() == label.max():
        return ToxicModel(base_rate=float(label.mean()) if len(label) else 0.0)
    places: dict[str, int] = {}
    index, first, counts, _ = coded(texts, places)
    words = _vocabulary(places, np.bincount(index, minlength=len(places)), vocabulary)
    forms, size = forms_of(list(places), words), len(words) + 2
    model = ToxicModel(words, np.zeros(size), np.zeros(size), np.zeros(size), bias=FIRST_BIAS, base_rate=float(label.mean()))
    del places
    first = cut_chains(first)
    ends = np.cumsum(counts)
    cuts = [0]  # documents whose tokens make a piece
    while cuts[-1] < len(label):
        done = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + PIECE, "right"))))
    pieces = [(a, b, slice(ends[a - 1] if a else 0, ends[b - 1])) for a, b in zip(cuts, cuts[1:], strict=False)]
    names = ("own", "before", "after", "grams", "shapes", "bias", "moves")
    power: dict[str, float | np.ndarray] = dict.fromkeys(names, 0.0)

    def scored(at: slice, own: np.ndarray) -> np.ndarray:
        return emissions(model, own[index[at]], forms.word[index[at]], first[at])

    for _ in range(steps):  # Adagrad on the log likelihood, with a small pull to zero
        own, of_form = form_scores(model, forms), np.zeros(len(forms.word))
        up: dict[str, float | np.ndarray] = {"before": np.zeros(size), "after": np.zeros(size), "bias": 0.0, "moves": np.zeros((2, 2))}
        for a, b, at in pieces:
            p, joint, factor = forward_backward(scored(at, own), first[at], model.moves)
            docs = np.repeat(np.arange(b - a), counts[a:b])
            more, moved = latent_targets(p, joint, factor, first[at], docs, label[a:b] == 1, model.moves[0, 0])
            before, after = neighbours(forms.word[index[at]], first[at], size - 1)
            of_form += np.bincount(index[at], more, len(of_form))
            up["before"] += np.bincount(before, more, size)
            up["after"] += np.bincount(after, more, size)
            up["bias"] += more.sum()
            up["moves"] += moved.sum(1).reshape(2, 2)
        up["own"] = np.bincount(forms.word, of_form, size)
        up["shapes"] = np.bincount(forms.shape, of_form, SHAPES)
        up["grams"] = np.bincount(forms.grams, np.repeat(of_form / np.sqrt(forms.counts), forms.counts), GRAMS)
        for name in names:
            g = up[name] - PULL * getattr(model, name) * (name != "bias")
            power[name] = power[name] + g * g
            setattr(model, name, getattr(model, name) + RATE * g / np.sqrt(power[name] + CALM))
    own, parts = form_scores(model, forms), []
    for a, b, at in pieces:
        p = forward_backward(scored(at, own), first[at], model.moves)[0]
        parts.append(summaries(p, np.repeat(np.arange(b - a), counts[a:b]), b - a))
    model.document = _fit_documents(np.concatenate(parts), label)
    return model


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = 1_200, **options) -> ToxicModel:
    """From ``doc_id, text`` and ``doc_id, toxic``: a repeatable sample of rows, about ``sample_docs`` of them toxic."""
    rows, _ = labelled_sample(docs, labels, "toxic", {0: sample_docs * CLEAN_SHARE, 1: sample_docs}, SAMPLE_BYTES)
    return ToxicModel(**fit_in_a_task(rows, partial(train, **options)))


def _spans(p: np.ndarray, first: np.ndarray, docs: np.ndarray, at: list[tuple[int, int]], n: int) -> list[list[dict]]:
    """Runs of tokens that are rather toxic than not, as offsets, for each of ``n`` texts."""
    hits: list[list[dict]] = [[] for _ in range(n)]
    last = -2
    for i in np.flatnonzero(p >= 0.5):
        if i == last + 1 and not first[i]:
            hits[docs[i]][-1]["end"] = at[i][1]
        else:
            hits[docs[i]].append({"start": at[i][0], "end": at[i][1]})
        last = i
    return hits


class KnownForms:
    """Words and scores of the forms that a task has met; begun anew when there are more than ``FORMS_HELD``."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.word, self.score = np.zeros(0, np.int32), np.zeros(0)

    def learn(self) -> None:
        """Work out the forms that were added to ``places``."""
        new = forms_of(list(islice(self.places, len(self.word), None)), self.model.words)
        self.word = np.concatenate((self.word, new.word))
        self.score = np.concatenate((self.score, form_scores(self.model, new)))


def _scorer(model: ToxicModel, spans: bool):
    def make():
        known = KnownForms(model)

        def work(texts: list[str]) -> list:
            scores, top, found = np.full(len(texts), model.base_rate), np.zeros(len(texts)), []
            if model.document is None:
                return [scores, top] + [[[]] * len(texts)] * spans
            for lo, hi in chunks_of(texts, SUB_BATCH):
                index, sentences, counts, at = coded(texts[lo:hi], known.places, spans)
                known.learn()
                first, docs = cut_chains(sentences), np.repeat(np.arange(hi - lo), counts)
                p = forward_backward(emissions(model, known.score[index], known.word[index], first), first, model.moves)[0]
                x = summaries(p, docs, hi - lo)
                scores[lo:hi], top[lo:hi] = _sigmoid(x @ model.document), x[:, 1]
                if spans:
                    found += _spans(p, sentences, docs, at, hi - lo)
                if len(known.places) > FORMS_HELD:
                    known.clear()
            return [scores, top] + [found] * spans

        return work

    return make


def score_toxicity(docs: DataFrame, model: ToxicModel, spans: bool = False, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ``score``, ``top_marginal`` and, if asked for, the toxic ``spans``."""
    added = "score double, top_marginal double" + ", spans array<struct<start:int,end:int>>" * spans
    return map_texts(docs, _scorer(model, spans), added, text)


def drop_toxic(docs: DataFrame, model: ToxicModel, limit: float = 0.5) -> DataFrame:
    """The documents, with their own columns, whose score is below ``limit``."""
    scored = score_toxicity(with_row(docs), model, text="whole_row.text")
    return scored.where(F.col("score") < limit).select("whole_row.*")
