"""An n-gram language model in a trie of Elias-Fano levels, built from the corpus by Spark and read by memory-mapping.

Tokens are the words of a text with A-Z lowered, then one end. Level one is the sorted sequence of word hashes; a word's id is
its place. Level n is sorted by (context, word), where a context is a node of level n - 1 (a context of level two is a word
id, or the number of words for the start of a text). It is cut into parts, each a file with: a monotone
pointer per context to its first successor, and the successors' ids made monotone by counting each context's from the last
of the one before. A word after a context is found by a successor search from the context's base. Counts are kept as
monotone sums, probabilities and back-off weights as 8-bit codes.

Smoothing: absolute discounting, interpolated, with counts before pruning: of an n-gram with count c after a context seen t
times, (c - d) / t; the rest of the context's mass goes to the shorter context. N-grams of two words and more with a count
below ``min_count`` are not kept (their mass is part of that rest). Words with unknown hash share the mass of words seen once.

Building: n-grams are counted per slice of a batch and dealt by ranges of (context, word), cut at quantiles of a sample that grows
with the corpus (the cuts only balance the parts; all n-grams are counted). The task that gets a range sums it over all batches and writes
its part, so a level is moved once and copied nowhere, and a hot context is spread over parts; the driver gets one row per part. Files go to the shared scratch folder, which must be reachable as a
path on all machines; a part is written under another name and moved, so a repeated task does no harm.

Defined cases: a null text is empty and has the end token only; without training texts every token is unknown and the score is 0; a
null id counts as training; repeated rows train and are scored each; a very long text is a slice of its own, with about 100 bytes a
token in memory. Other columns are kept by scoring; those that have
the names of added ones give way to them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import clean_text, materialize, scratch_path
from demandgrid.llm.elias_fano import EliasFano, load, save

END = "\n"
DISCOUNT = 0.75
ID_BITS = 31
WORD_MASK = (1 << ID_BITS) - 1
SLICE_CHARS, SLICE_TOKENS = 6_000_000, 1_000_000
PART_ROWS = 500_000
#: Tokens whose n-grams are looked at to cut the ranges: so many at least, and for each part.
SAMPLE_TOKENS, SAMPLE_PER_PART = 2_000_000, 200


# Tokens


@dataclass
class Tokens:
    """Tokens of some texts: place of each in ``hashes`` (distinct words, increasing), and each text's number of tokens."""

    code: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray


def tokenize(texts: pa.Array) -> Tokens:
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat = words.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(real).dictionary_encode()
    whose = pc.list_parent_indices(words).filter(real).to_numpy(zero_copy_only=False)
    n = np.bincount(whose, minlength=len(texts)) + 1
    ends = np.cumsum(n) - 1
    code = np.empty(int(n.sum()), np.int64)
    is_end = np.zeros(len(code), bool)
    is_end[ends] = True
    code[is_end] = len(coded.dictionary)
    code[~is_end] = coded.indices.to_numpy(zero_copy_only=False)
    # Hashes as signed numbers, as Spark orders them.
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in [*coded.dictionary.to_pylist(), END]], np.uint64).view(np.int64)
    order = np.argsort(hashes)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return Tokens(back[code], hashes[order], n)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``SLICE_CHARS`` bytes together."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_CHARS, side="right")))
        yield start, stop
        start = stop


# The trie


@dataclass
class Part:
    """One file: where its keys begin, its first node, and what the driver corrects for contexts cut between parts."""

    path: str
    first_context: int
    first_word: int
    base: int
    n: int
    contexts: int
    gammas: dict[int, float] = field(default_factory=dict)


@dataclass
class Model:
    folder: str = ""
    levels: list[list[Part]] = field(default_factory=list)
    tokens: int = 0
    words: int = 0
    texts: int = 0
    unknown: float = 1.0

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """Look-ups for many keys at once; keys are best given in order. Files are mapped when first needed."""

    def __init__(self, model: Model):
        self.model = model
        self.open: dict[str, dict] = {}

    def _file(self, part: Part) -> dict:
        if part.path not in self.open:
            self.open[part.path] = load(part.path)
        return self.open[part.path]

    def _routed(self, level: int, keys: np.ndarray, firsts: list[int]) -> Iterator[tuple[Part, slice]]:
        """The parts that increasing keys belong to, with the stretch of keys of each."""
        if level > len(self.model.levels) or not len(keys):
            return
        cuts = [*np.searchsorted(keys, np.array(firsts, np.int64)).tolist(), len(keys)]
        for part, lo, hi in zip(self.model.levels[level - 1], cuts, cuts[1:], strict=False):
            if lo < hi:
                yield part, slice(lo, hi)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each word hash (increasing), -1 if unknown."""
        ids = np.full(len(hashes), -1, np.int64)
        for part, rows in self._routed(1, hashes, [q.first_word for q in self.model.levels[0]] if self.model.levels else []):
            at = self._file(part)["keys"].find((hashes[rows] - np.int64(part.first_word)).view(np.uint64))
            ids[rows] = np.where(at >= 0, part.base + at, -1)
        return ids

    def by_number(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability and count of words by id (increasing); those of unknown words for -1."""
        p, counts = np.full(len(ids), self.model.unknown), np.zeros(len(ids), np.int64)
        for part, rows in self._routed(1, ids, [q.base for q in self.model.levels[0]] if self.model.levels else []):
            f, at = self._file(part), ids[rows] - part.base
            p[rows] = f["book"][f["codes"][at]]
            counts[rows] = (f["sums"].get(at + 1) - f["sums"].get(at)).astype(np.int64)
        return p, counts

    def count(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Counts of nodes of a level, in increasing order."""
        found = np.zeros(len(nodes), np.int64)
        for part, rows in self._routed(level, nodes, [q.base for q in self.model.levels[level - 1]]):
            sums, at = self._file(part)["sums"], nodes[rows] - part.base
            found[rows] = (sums.get(at + 1) - sums.get(at)).astype(np.int64)
        return found

    def successors(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node (-1 if there is none) and discounted probability of each (context, word), keys in increasing order."""
        nodes, p = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
        firsts = [q.first_context << ID_BITS | q.first_word for q in self.model.levels[level - 1]]
        for part, rows in self._routed(level, keys, firsts):
            f = self._file(part)
            context, word = (keys[rows] >> ID_BITS) - part.first_context, keys[rows] & WORD_MASK
            inside = int(np.searchsorted(context, part.contexts))
            context, word = context[:inside], word[:inside]
            if not inside:
                continue
            new = np.concatenate(([True], context[1:] != context[:-1]))
            distinct, which = context[new], np.cumsum(new) - 1
            begin, stop = f["pointers"].get(distinct).astype(np.int64), f["pointers"].get(distinct + 1).astype(np.int64)
            base = np.where(begin > 0, f["successors"].get(np.maximum(begin - 1, 0)).astype(np.int64) + 1, 0)
            # Beyond a context's last successor the numbers belong to the next context.
            last = np.where(stop > begin, f["successors"].get(np.maximum(stop - 1, 0)).astype(np.int64), -1)
            target = base[which] + word
            there = np.flatnonzero(target <= last[which])
            spot = f["successors"].find(target[there].view(np.uint64))
            there, spot = there[spot >= 0] + rows.start, spot[spot >= 0]
            nodes[there] = part.base + spot
            p[there] = f["book"][f["codes"][spot]]
        return nodes, p

    def back_off(self, level: int, contexts: np.ndarray) -> np.ndarray:
        """Weight of the shorter context, for increasing contexts; 1 for one without successors."""
        gamma = np.ones(len(contexts))
        firsts = [q.first_context << ID_BITS | q.first_word for q in self.model.levels[level - 1]] if level <= len(self.model.levels) else []
        for part, rows in self._routed(level, contexts << ID_BITS | WORD_MASK, firsts):
            f = self._file(part)
            at = contexts[rows] - part.first_context
            at = at[: int(np.searchsorted(at, part.contexts))]
            gamma[rows.start : rows.start + len(at)] = f["gamma_book"][f["gamma_codes"][at]]
            for context, value in part.gammas.items():
                lo, hi = np.searchsorted(at, [context - part.first_context, context - part.first_context + 1])
                gamma[rows.start + lo : rows.start + hi] = value
        return gamma


def _weights(reader: Reader, level: int, nodes: np.ndarray) -> np.ndarray:
    """Back-off weights of nodes as contexts of a level; nodes increase but for -1 in between, which weigh 1."""
    gamma, real = np.ones(len(nodes)), np.flatnonzero(nodes >= 0)
    gamma[real] = reader.back_off(level, nodes[real])
    return gamma


def _distinct(numbers: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse of numbers from -1 to ``words - 1``; without a sort where there are enough of them."""
    if words > 2 * len(numbers):
        return np.unique(numbers, return_inverse=True)
    there = np.zeros(words + 1, bool)
    there[numbers + 1] = True
    some = np.flatnonzero(there) - 1
    return some.astype(numbers.dtype), (np.cumsum(there) - 1)[numbers + 1]


def walk(reader: Reader, numbers: np.ndarray, first: np.ndarray, top: int):
    """Level by level, for each token: its node (-1 for none) and the probability so far; at level one also counts.

    Look-ups are made for distinct keys in order; ``weight`` is that of a token's node as a context of the next level.
    """
    model = reader.model
    some, which = _distinct(numbers, model.words)
    p, counts = reader.by_number(some)
    word = node = numbers.astype(np.int64)
    prob = p[which]
    yield 1, counts[which], node, prob
    if top == 1:
        return
    weight, kept = _weights(reader, 2, some.astype(np.int64))[which], word >= 0
    start = reader.back_off(2, np.array([model.words]))[0] if model.levels else 1.0
    for n in range(2, top + 1):
        context, gamma = np.empty(len(word), np.int64), np.empty(len(word))
        context[1:], gamma[1:] = node[:-1], weight[:-1]
        context[first], gamma[first] = (model.words, start) if n == 2 else (-1, 1.0)
        node, weight = np.full(len(word), -1, np.int64), np.ones(len(word))
        # An n-gram is kept only if its first and its last n - 1 words are.
        known = np.flatnonzero(kept & (gamma < 1))
        prob = prob * gamma
        if n <= len(model.levels) and len(known):
            keys, back = np.unique(context[known] << ID_BITS | word[known], return_inverse=True)
            found, alpha = reader.successors(n, keys)
            node[known] = found[back]
            prob[known] += alpha[back]
            if n < top:
                weight[known] = _weights(reader, n + 1, found)[back]
        yield n, context, node, prob
        kept = node >= 0


# Building


def _book(values: np.ndarray, most: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` means of equally many neighbouring values, and each value's code."""
    distinct = np.unique(values)
    if len(distinct) <= most:
        return distinct, np.searchsorted(distinct, values).astype(np.uint8)
    logs = np.log(np.sort(values))
    book = np.unique(np.exp([c.mean() for c in np.array_split(logs, most) if len(c)]))
    return book, np.searchsorted((book[1:] + book[:-1]) / 2, values).astype(np.uint8)


def _gathered(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*held, strict=True)]


MANIFEST = {
    "path": pa.string(), "first_context": pa.int64(), "first_word": pa.int64(), "last_context": pa.int64(), "n": pa.int64(),
    "head_kept": pa.int64(), "head_n": pa.int64(), "head_times": pa.int64(), "tail_kept": pa.int64(), "tail_n": pa.int64(), "tail_times": pa.int64(),
}
MANIFEST_DDL = (
    "path string, first_context bigint, first_word bigint, last_context bigint, n bigint, head_kept bigint, head_n bigint, "
    "head_times bigint, tail_kept bigint, tail_n bigint, tail_times bigint"
)


def _manifest(*row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, MANIFEST.values(), strict=True)], list(MANIFEST))


def _write_words(folder: str, total: int, discount: float):
    """Rows ``hash, n`` in order to a part of level one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _gathered(batches)
        if not columns:
            return
        keys, n = columns
        book, codes = _book((n - discount) / total)
        path = os.path.join(folder, f"words{int(keys[0]) + (1 << 63):020d}")
        sums = EliasFano.of(np.concatenate(([0], np.cumsum(n))))
        save(path, keys=EliasFano.of((keys - keys[0]).view(np.uint64)), sums=sums, book=book, codes=codes)
        yield _manifest(path, 0, int(keys[0]), 0, len(keys), 0, 0, 0, 0, 0, 0)

    return run


def _write_level(folder: str, model: Model, level: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Increasing keys (context and word) and their counts to a part of a higher level."""
    context, word = keys >> ID_BITS, keys & WORD_MASK
    begins = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
    some, ends = context[begins], np.append(begins[1:], len(keys))
    times = np.full(len(some), model.texts, np.int64)
    real = some != model.words if level == 2 else np.ones(len(some), bool)
    times[real] = model.reader().count(level - 1, some[real])
    sizes = ends - begins
    kept = np.add.reduceat(n, begins)
    alpha = (n - DISCOUNT) / np.repeat(times, sizes)
    gamma = (times - kept + DISCOUNT * sizes) / times
    lasts = word[ends - 1] + 1
    base = np.repeat(np.cumsum(lasts) - lasts, sizes)
    book, codes = _book(alpha)
    # Pointers and weights for all contexts from the first to the last; code 0 is that of a context without successors.
    spots = some - some[0]
    held, gamma_codes = np.zeros(int(spots[-1]) + 1, np.int64), np.zeros(int(spots[-1]) + 1, np.uint8)
    held[spots] = sizes
    gamma_book, used = _book(gamma, 255)
    gamma_codes[spots] = used + 1
    path = os.path.join(folder, f"level{level}-{int(keys[0]):020d}")
    save(
        path, pointers=EliasFano.of(np.concatenate(([0], np.cumsum(held)))), successors=EliasFano.of((base + word).view(np.uint64)),
        sums=EliasFano.of(np.concatenate(([0], np.cumsum(n)))), book=book, codes=codes,
        gamma_book=np.concatenate(([1.0], gamma_book)), gamma_codes=gamma_codes,
    )
    edge = [int(v) for k in (0, -1) for v in (kept[k], sizes[k], times[k])]
    return _manifest(path, int(some[0]), int(word[0]), int(some[-1]), len(keys), *edge)


def _parts(rows: list) -> list[Part]:
    """Parts in order, with their first nodes; contexts at the edges get the weight of all their parts together."""
    rows = sorted(rows, key=lambda r: (r["first_context"], r["first_word"]))
    parts, base, shared = [], 0, {}
    for r in rows:
        parts.append(Part(r["path"], r["first_context"], r["first_word"], base, r["n"], r["last_context"] - r["first_context"] + 1))
        base += r["n"]
        edges = {(r["first_context"], "head"), (r["last_context"], "tail")}
        if r["first_context"] == r["last_context"]:
            edges = {(r["first_context"], "head")}
        for context, side in edges:
            kept, n, times = shared.get(context, (0, 0, 0))
            shared[context] = (kept + r[f"{side}_kept"], n + r[f"{side}_n"], r[f"{side}_times"])
    for part, r in zip(parts, rows, strict=True):
        for context in (r["first_context"], r["last_context"]):
            kept, n, times = shared[context]
            if times:
                part.gammas[context] = (times - kept + DISCOUNT * n) / times
    return parts


BLOB = "bucket int, keys binary, counts binary"
BUCKETS = 4  # to a partition


def _dealt(keys: np.ndarray, many: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Increasing keys and their counts, a row per bucket of hashed keys: bytes of their steps, and of the counts."""
    mixed = (keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    keys, many = keys[order], many[order].astype("<i8")
    rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)) if lo < hi]
    steps = [np.diff(keys[lo:hi], prepend=0).astype("<i8").tobytes() for _, lo, hi in rows]
    counts = [many[lo:hi].tobytes() if many[lo:hi].max() > 255 else many[lo:hi].astype("u1").tobytes() for _, lo, hi in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "keys", "counts"])


def _summed(keys: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, many
    order = np.argsort(keys, kind="stable")
    keys, many = keys[order], many[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[new], np.add.reduceat(many, new)


def _ranged(keys: np.ndarray, many: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
    """Increasing keys and their counts, a row per range: steps as planes of bytes (the high ones are mostly 0), and counts."""
    ends = [0, *np.searchsorted(keys, cuts).tolist(), len(keys)]
    rows = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)) if lo < hi]
    steps = [np.diff(keys[lo:hi], prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for _, lo, hi in rows]
    many = many.astype("<i8")
    counts = [many[lo:hi].tobytes() if many[lo:hi].max() > 255 else many[lo:hi].astype("u1").tobytes() for _, lo, hi in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "keys", "counts"])


def _merge_ranges(least: int, write):
    """Sums each range over all batches (rows come range by range) and writes those with at least ``least`` places."""

    def part(held: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        keys, many = [], []
        for k, c in held:
            n = len(k) // 8
            keys.append(np.cumsum(np.ascontiguousarray(np.frombuffer(k, np.uint8).reshape(8, n).T).view("<i8").ravel()))
            many.append(np.frombuffer(c, "u1" if len(c) == n else "<i8").astype(np.int64))
        held.clear()
        keys, many = _summed(np.concatenate(keys), np.concatenate(many))
        keys, many = keys[many >= least], many[many >= least]
        if len(keys):
            yield write(keys, many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for bucket, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and bucket != now:
                    yield from part(held)
                now = bucket
                held.append((k, c))
        if held:
            yield from part(held)

    return run


def _merge(least: int, name: str):
    """Sums over all batches, bucket by bucket (rows come in their order): keys with at least ``least`` places."""

    def rows(held: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        keys, many = [], []
        for k, c in held:
            steps = np.frombuffer(k, "<i8")
            keys.append(np.cumsum(steps))
            many.append(np.frombuffer(c, "u1" if len(c) == len(steps) else "<i8").astype(np.int64))
        keys, many = _summed(np.concatenate(keys), np.concatenate(many))
        keys, many = keys[many >= least], many[many >= least]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(many)], [name, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for bucket, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and bucket != now:
                    yield from rows(held)
                    held = []
                now = bucket
                held.append((k, c))
        if held:
            yield from rows(held)

    return run


def _counted(df: DataFrame, count, least: int, name: str) -> DataFrame:
    """``name, n``: keys with their sums. Batches send their sums packed, a few rows each, and a task merges its buckets."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.mapInArrow(count(min(60_000, BUCKETS * parts)), BLOB).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_merge(least, name), f"{name} bigint, n bigint")


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, many = batch.column("text"), [], []
            for lo, hi in slices(texts):
                t = tokenize(texts.slice(lo, hi - lo))
                keys.append(t.hashes)
                many.append(np.bincount(t.code, minlength=len(t.hashes)))
            if keys:
                yield _dealt(*_summed(np.concatenate(keys), np.concatenate(many)), buckets)

    return run


def _numbered(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a batch in slices: from, to, ids of all their tokens, and each text's number of tokens."""
    column = batch.column("ids")
    n = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    ends = np.cumsum(n)
    start = 0
    while start < len(column):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_TOKENS, side="right")))
        yield start, stop, np.frombuffer(b"".join(column.slice(start, stop - start).to_pylist()), "<i4"), n[start:stop]
        start = stop


def _first(counts: np.ndarray) -> np.ndarray:
    mark = np.zeros(int(counts.sum()), bool)
    mark[np.cumsum(counts) - counts] = True
    return mark


def _number(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            texts, blobs = batch.column("text"), []
            for lo, hi in slices(texts):
                t = tokenize(texts.slice(lo, hi - lo))
                ids = reader.numbers(t.hashes)[t.code].astype("<i4")
                ends = np.cumsum(t.counts).tolist()
                blobs += [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(blobs, pa.binary())], [*names, "ids"])

    return run


def _heads(reader: Reader, word: np.ndarray, first: np.ndarray, level: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each token the node of the n-gram of ``level`` words that ends with it (-1 for none), and whether it was kept."""
    node, kept = word, word >= 0
    if least > 1:
        some, which = np.unique(word, return_inverse=True)
        kept = (reader.by_number(some)[1] >= least)[which]
    use = kept
    for n in range(2, level + 1):
        context = np.full(len(word), -1, np.int64)
        context[1:] = node[:-1]
        context[first] = reader.model.words if n == 2 else -1
        at = np.flatnonzero((context >= 0) & use)
        keys, back = np.unique(context[at] << ID_BITS | word[at], return_inverse=True)
        node = np.full(len(word), -1, np.int64)
        node[at] = reader.successors(n, keys)[0][back]
        use = node >= 0
    return node, use


def _level_keys(model: Model, level: int, least: int):
    """Of each slice of a batch the distinct (context, word) of a level with their places. An n-gram can't reach the least count if
    a shorter one in it doesn't: of those with a first or last part that wasn't kept nothing is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        reader = model.reader()
        for batch in batches:
            for _, _, ids, counts in _numbered(batch):
                word, first = ids.astype(np.int64), _first(counts)
                node, kept = _heads(reader, word, first, level - 1, least)
                context = np.full(len(word), -1, np.int64)
                context[1:] = node[:-1]
                context[first] = model.words if level == 2 else -1
                use = (context >= 0) & kept
                if level == 2:
                    use[1:] &= kept[:-1] | first[1:]
                yield np.unique(context[use] << ID_BITS | word[use], return_counts=True)

    return run


def _deal_level(found, cuts: np.ndarray):
    return lambda batches: (_ranged(keys, many, cuts) for keys, many in found(batches))


def _only_keys(found):
    return lambda batches: (pa.RecordBatch.from_arrays([pa.array(keys)], ["key"]) for keys, _ in found(batches))


def _cuts(numbered: DataFrame, tokens: int, found, parts: int) -> np.ndarray:
    """Keys at which a level is cut into about ``parts`` ranges, from the n-grams of a sample of rows."""
    if parts < 2:
        return np.zeros(0, np.int64)
    rate = max(SAMPLE_TOKENS, SAMPLE_PER_PART * parts) / max(1, tokens)
    some = numbered.select("ids") if rate >= 1 else numbered.select("ids").where(F.pmod(F.xxhash64("ids"), F.lit(1_000_000)) < int(rate * 1_000_000) + 1)
    shares = F.lit([k / parts for k in range(1, parts)]).cast("array<double>")
    cuts = some.mapInArrow(_only_keys(found), "key bigint").agg(F.percentile_approx("key", shares, F.lit(20 * parts)).alias("cuts")).first()["cuts"]
    return np.unique(np.array(cuts or [], np.int64))


def _folder(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "trie")
    scheme, _, rest = path.partition(":")
    if rest and scheme != "file":
        raise ValueError(f"the trie is memory-mapped: spark.checkpoint.dir must be a shared folder with a path, not {scheme}:")
    path = "/" + rest.lstrip("/") if rest else path
    os.makedirs(path, exist_ok=True)
    return path


def train_words(texts: DataFrame) -> Model:
    """Level one from the column ``text``: all words."""
    texts = texts.select(clean_text().alias("text"))
    folder, parts = _folder(texts), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = materialize(_counted(texts, _count_words, 1, "hash"), "lm-words")
    once = F.sum((F.col("n") == 1).cast("bigint"))
    all_of = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(once, F.lit(0)).alias("once")).first()
    model = Model(folder, [], all_of["tokens"], all_of["words"])
    if not model.words:
        return model
    if model.words >= WORD_MASK:
        raise ValueError(f"{model.words} words do not fit ids of {ID_BITS} bits")
    # Discounting each word by the share of words seen once leaves unknown words the share of tokens that are such words.
    discount = min(0.9, max(0.01, all_of["once"] / model.words))
    model.unknown = discount * model.words / model.tokens
    end = int(np.uint64(xxhash.xxh3_64_intdigest(END)).view(np.int64))
    model.texts = words.where(F.col("hash") == end).first()["n"]
    rows = words.repartitionByRange(parts, "hash").sortWithinPartitions("hash").mapInArrow(_write_words(folder, model.tokens, discount), MANIFEST_DDL)
    model.levels.append(_parts(rows.collect()))  # one row per part, as below
    return model


def number_words(docs: DataFrame, model: Model) -> DataFrame:
    """``text`` becomes ``ids``: the word ids of its tokens (-1 for unknown words), four bytes each. Written, because each level
    and the scoring read it."""
    docs = docs.drop("ids")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    rows = docs.withColumn("text", clean_text()).mapInArrow(_number(model), ", ".join([*kept, "ids binary"]))
    return materialize(rows, "lm-numbered")


def train_levels(numbered: DataFrame, model: Model, order: int = 3, min_count: int = 2) -> Model:
    """Add levels two to ``order`` from the column ``ids``: n-grams with at least ``min_count`` places."""
    shuffled = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A part is held in memory when it is written; no level has more n-grams than there are tokens.
    wide = max(shuffled, -(-model.tokens // PART_ROWS))
    for level in range(2, order + 1):
        if not model.levels:
            break
        if (nodes := sum(p.n for p in model.levels[-1])) >= 1 << (62 - ID_BITS):
            raise ValueError(f"{nodes} n-grams of {level - 1} words do not fit contexts of {62 - ID_BITS} bits")
        found = _level_keys(model, level, min_count)
        cuts = _cuts(numbered, model.tokens, found, wide)
        dealt = numbered.select("ids").mapInArrow(_deal_level(found, cuts), BLOB).repartition(wide, "bucket").sortWithinPartitions("bucket")
        write = partial(_write_level, model.folder, model, level)
        parts_of = _parts(dealt.mapInArrow(_merge_ranges(min_count, write), MANIFEST_DDL).collect())
        if not parts_of:
            break
        model.levels.append(parts_of)
    return model


def train(texts: DataFrame, order: int = 3, min_count: int = 2) -> Model:
    """A model of the column ``text``."""
    model = train_words(texts)
    return train_levels(number_words(texts.select("text"), model), model, order, min_count) if order > 1 and model.levels else model


# Scoring


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        floor = 0.5 / (model.tokens + 0.5 * (model.words + 1))
        for batch in batches:
            out = [[], [], [], []]
            for _, _, ids, n_tokens in _numbered(batch):
                begin = np.cumsum(n_tokens) - n_tokens
                for n, counts, _, prob in walk(reader, ids, _first(n_tokens), max(1, len(model.levels))):
                    if n == 1:
                        base = np.log10((counts + 0.5) * 2 * floor)
                out[0].append(n_tokens)
                out[1].append(np.add.reduceat((ids >= 0).astype(np.int64), begin))
                out[2].append(np.add.reduceat(base, begin))
                out[3].append(np.add.reduceat(np.log10(prob), begin))
            if out[0]:
                columns = [pa.array(np.concatenate(c)) for c in out]
                names = [c for c in batch.schema.names if c != "ids"]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + columns, [*names, "n_tokens", "n_known", "base_score", "score"])

    return run


def score_numbered(numbered: DataFrame, model: Model) -> DataFrame:
    """The other columns with ``n_tokens, n_known, base_score, score`` (log10) and ``train_tokens``."""
    numbered = numbered.drop("n_tokens", "n_known", "base_score", "score", "train_tokens")  # given columns give way to the added ones
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "ids"]
    schema = ", ".join([*kept, "n_tokens bigint, n_known bigint, base_score double, score double"])
    return numbered.mapInArrow(_score(model), schema).withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``score_numbered`` for documents with ``text``."""
    return score_numbered(number_words(docs, model), model)
