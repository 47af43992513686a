"""Text quality by a byte-level convolutional network, written and trained in numpy.

Bytes are embedded, learned filters of ``2 * STRIDE`` bytes run over them with a stride of ``STRIDE``, and each filter's
largest response is kept for every chunk of ``2 * HALF`` bytes; chunks overlap by half and cover the whole text. A
document is the mean and the maximum over its chunks, and a logistic layer turns them into one probability.

Training: Adam on the logistic loss over a bounded, repeatable sample of labelled rows (``sample_docs`` of either label on
average, ``SAMPLE_BYTES`` of text of either label at most), all chunks of each text, in one task. Scoring reads every byte.

Defined cases: a null or empty text is one chunk of padding; without any labelled row, or with one label only in the sample, every score
is the share of label 1 (0.5 without labels); null labels teach nothing; repeated rows teach once and are scored each; a very
long text is scored by itself, with about 50 bytes for each of its own; columns that have the names of added ones give way to them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from demandgrid.llm.common import chunks_of, fit_in_a_task, labelled_sample, map_texts

STRIDE, HALF = 4, 128
PLACES = HALF // STRIDE
EMBED, FILTERS = 4, 16
SUB_BATCH = 500_000
SAMPLE_BYTES = 24_000_000


@dataclass
class QualityModel:
    """Embedding (256, e), filters in two halves (STRIDE * e, f), their bias, and the logistic layer (2 f) with bias."""

    embed: np.ndarray | None = None
    left: np.ndarray | None = None
    right: np.ndarray | None = None
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    out_bias: np.ndarray | None = None
    base_rate: float = 0.5


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each filled with zeros to two halves at least and whole halves; halves of each."""
    raw = [t.encode() for t in texts]
    halves = np.array([max(2, -(-len(r) // HALF)) for r in raw], np.int64)
    return np.frombuffer(b"".join(r.ljust(h * HALF, b"\0") for r, h in zip(raw, halves.tolist(), strict=True)), np.uint8), halves


def responses(model: QualityModel, data: np.ndarray) -> np.ndarray:
    """Filter responses at every place of every half, (halves, places, filters); the last place of a half looks into the next."""
    blocks = model.embed[data].reshape(-1, STRIDE * EMBED)
    out = blocks @ model.left
    out[:-1] += (blocks @ model.right)[1:]
    out += model.bias
    return np.maximum(out, 0, out=out).reshape(-1, PLACES, FILTERS)


def score_texts(model: QualityModel, texts: list[str]) -> np.ndarray:
    data, halves = padded(texts)
    found = responses(model, data)
    # The last place of a chunk's second half would look out of the chunk.
    second = found[:, :-1].max(1)
    first = np.maximum(second, found[:, -1])
    ends = np.cumsum(halves)
    starts = ends - halves
    chunk = np.maximum(first, np.concatenate((second[1:], second[-1:])))
    chunk[ends - 1] = 0  # no chunk begins with a text's last half
    mean = np.add.reduceat(chunk, starts, axis=0) / (halves - 1)[:, None]
    most = np.maximum.reduceat(chunk, starts, axis=0)
    z = np.concatenate((mean, most), axis=1) @ model.out + model.out_bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Halves of all texts, the first half of each chunk, and the text of each chunk."""
    data, halves = padded(texts)
    ends = np.cumsum(halves)
    at = np.delete(np.arange(int(ends[-1])), ends - 1)  # no chunk begins with a text's last half
    return data.reshape(-1, HALF), at, np.repeat(np.arange(len(texts)), halves - 1)


def train(
    texts: list[str], labels: list[int], share: float | None = None, epochs: int = 12, seed: int = 7
) -> QualityModel:
    """Fit the network to texts with labels 0 and 1. Both labels weigh the same in fitting; ``share`` of label 1 (by default
    that of the sample) then moves the score."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return QualityModel(base_rate=share if share is not None else float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    shape = {
        "embed": (256, EMBED), "left": (STRIDE * EMBED, FILTERS), "right": (STRIDE * EMBED, FILTERS), "bias": (FILTERS,),
        "out": (2 * FILTERS,), "out_bias": (1,),
    }
    w = {k: (rng.normal(0, 0.3, s) if len(s) == 2 else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    w["out"] = rng.normal(0, 0.1, shape["out"]).astype(np.float32)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    halves, at, whose = _chunks(texts)
    begin = np.searchsorted(whose, np.arange(len(y) + 1))
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    batch, step = 64, 0
    for _ in range(max(epochs, -(-400 // -(-len(y) // batch)))):  # 400 steps at least
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            docs = order[lo : lo + batch]
            rows = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in docs])
            counts = begin[docs + 1] - begin[docs]
            starts = np.cumsum(counts) - counts
            x = np.concatenate((halves[at[rows]], halves[at[rows] + 1]), axis=1)
            blocks = w["embed"][x].reshape(len(rows), -1, STRIDE * EMBED)
            a = blocks @ w["left"]
            a[:, :-1] += (blocks @ w["right"])[:, 1:]
            a = a[:, :-1] + w["bias"]
            best = a.argmax(1)
            top = np.take_along_axis(a, best[:, None], 1)[:, 0]
            pooled = np.maximum(top, 0)
            mean = np.add.reduceat(pooled, starts, axis=0) / counts[:, None]
            most = np.maximum.reduceat(pooled, starts, axis=0)
            h = np.concatenate((mean, most), axis=1)
            p = 1 / (1 + np.exp(-np.clip(h @ w["out"] + w["out_bias"], -30, 30)))
            dz = ((p - y[docs]) * weight[docs] / len(docs)).astype(np.float32)
            g = {"out": h.T @ dz + 1e-4 * w["out"], "out_bias": dz.sum(keepdims=True)}
            dh = dz[:, None] * w["out"]
            whose_row = np.repeat(np.arange(len(docs)), counts)
            is_most = pooled >= most[whose_row]
            dp = dh[whose_row, :FILTERS] / counts[whose_row, None] + dh[whose_row, FILTERS:] * is_most
            dp = np.where(top > 0, dp, 0).astype(np.float32)
            g["bias"] = dp.sum(0)
            r, f = np.indices(best.shape)
            here, there = blocks[r, best], blocks[r, best + 1]
            g["left"] = np.einsum("nfd,nf->df", here, dp)
            g["right"] = np.einsum("nfd,nf->df", there, dp)
            de = np.zeros_like(blocks)
            np.add.at(de, (r, best), dp[..., None] * w["left"].T[f])
            np.add.at(de, (r, best + 1), dp[..., None] * w["right"].T[f])
            used = np.flatnonzero(np.abs(de.reshape(-1, EMBED)).any(1))
            g["embed"] = np.zeros_like(w["embed"])
            np.add.at(g["embed"], x.reshape(-1)[used], de.reshape(-1, EMBED)[used])
            step += 1
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    share = float(y.mean()) if share is None else share
    w["out_bias"] = w["out_bias"] + np.log(share / (1 - share))
    return QualityModel(**{k: v.astype(np.float32) for k, v in w.items()}, base_rate=share)


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = 2_500, **options) -> QualityModel:
    """From ``doc_id, text`` and ``doc_id, quality``: a repeatable sample of about ``sample_docs`` rows of either label."""
    rows, counts = labelled_sample(docs, labels, "quality", {0: sample_docs, 1: sample_docs}, SAMPLE_BYTES)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return QualityModel(base_rate=share if counts else 0.5)
    return QualityModel(**fit_in_a_task(rows, partial(train, share=share, **options)))


def _scorer(model: QualityModel):
    def work(texts: list[str]) -> list:
        scores = np.full(len(texts), model.base_rate)
        if model.embed is not None:
            for lo, hi in chunks_of(texts, SUB_BATCH):
                scores[lo:hi] = score_texts(model, texts[lo:hi])
        return [scores]

    return lambda: work


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with ``score``, the probability of label 1."""
    return map_texts(docs, _scorer(model), "score double", text)
