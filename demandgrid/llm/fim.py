"""Fill-in-the-middle by displacement scatter.

A text is cut into units (a run of ASCII letters, or any other code point). Two cuts drawn from a hash of the id make prefix,
middle and suffix, which are put in another order behind marks:

* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* plain: the text itself (a tenth of all texts, the empty ones, and those that hold a mark, so that marks are never ambiguous)

Nothing is sliced or joined text by text. The bytes of many texts lie in one array, and so do their outputs; three changes of
displacement a text (at the start of prefix, middle and suffix) go into a difference array, whose cumulative sum is the distance
that each byte moves. One scatter puts the bytes there, another the marks. ``restore`` finds the marks in the outputs, builds
the displacements the other way round and gathers the bytes back; it sees outputs and forms only.

Work goes in pieces of about ``PIECE`` bytes of whole texts; within a piece, displacements are summed ``SEGMENT`` bytes at a time. So
memory is a few bytes for each byte of the longest text, besides 8 for each of its units.

Defined cases: a null text is empty; a null id counts as empty text; repeated rows give equal rows; an empty table gives an
empty result; other columns are ignored by ``fill_in_middle``, and kept by ``restore`` (a column ``restored`` is replaced).
``restore`` gives null where an output does not hold its form's marks, or is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.llm.common import clean_text

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
PLAIN_PERCENT, SPM_PERCENT = 10, 20
PIECE, SEGMENT = 4_000_000, 1_000_000

PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], object)


def pack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its texts."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def unpack(data: np.ndarray, offsets: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    valid = None if null is None or not null.any() else pa.array(~null).buffers()[1]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data), valid)


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``PIECE`` bytes together, one text at least."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        yield at, end
        at = end


def displacements(places: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(first byte, where it and the following go)``: bytes from ``places[i]`` to the next place move by ``shifts[i]``.

    Of several shifts at one place the last counts, as their differences add up.
    """
    change, moved = np.diff(shifts, prepend=0), 0
    for lo in range(0, size, SEGMENT):
        hi = min(lo + SEGMENT, size)
        a, b = np.searchsorted(places, [lo, hi])
        step = np.zeros(hi - lo, np.int64)
        np.add.at(step, places[a:b] - lo, change[a:b])
        step[0] += moved
        shift = np.cumsum(step)
        moved = shift[-1]
        yield lo, np.arange(lo, hi) + shift


def marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the marks that lie within one text, and the texts."""
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & (data[2:] == PREFIX[2])) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[np.isin(data[at + 1], [m[1] for m in (PREFIX, SUFFIX, MIDDLE)])]
    whose = np.searchsorted(offsets, at, "right") - 1
    inside = at + MARK <= offsets[whose + 1]
    return at[inside], whose[inside]


def cut_units(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of units of each text, and the bytes at which its middle and its suffix begin."""
    letter = ((data | 32) - 97) < 26  # bytes beyond ASCII are none
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    at = np.append(np.flatnonzero(begins), len(data))
    first = np.searchsorted(at[:-1], offsets)
    n = np.diff(first)
    chosen = draws[:, :2] % (n + 1)[:, None]
    return n, at[first[:-1] + chosen.min(1)], at[first[:-1] + chosen.max(1)]


def transform(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units, form, code points of prefix and middle, bytes and offsets of the outputs."""
    start, end = offsets[:-1], offsets[1:]
    n, middle, suffix = cut_units(data, offsets, draws)
    plain = (start == end) | (draws[:, 2] % 100 >= 100 - PLAIN_PERCENT)
    plain[marks(data, offsets)[1]] = True
    form = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < SPM_PERCENT, SPM, PSM))

    following = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that begin no code point
    before = np.searchsorted(following, np.stack([start, middle, suffix]))
    prefix_chars = middle - start - (before[1] - before[0])
    middle_chars = suffix - middle - (before[2] - before[1])

    p, m, s = middle - start, suffix - middle, end - suffix
    out_offsets = np.concatenate(([0], np.cumsum(end - start + np.where(plain, 0, 3 * MARK))))
    base, place = out_offsets[:-1] - start, out_offsets[:-1]
    by_form = lambda psm, spm: np.choose(form, [np.zeros_like(start), psm, spm])
    shifts = np.stack(
        [
            base + by_form(MARK + 0 * p, 2 * MARK + s),  # prefix
            base + by_form(3 * MARK + s, 3 * MARK + s),  # middle
            base + by_form(2 * MARK - m, MARK - p - m),  # suffix
        ],
        1,
    ).ravel()
    out = np.empty(out_offsets[-1], np.uint8)
    for lo, goes in displacements(np.stack([start, middle, suffix], 1).ravel(), shifts, len(data)):
        out[goes] = data[lo : lo + len(goes)]
    moved = ~plain
    for mark, where in (
        (PREFIX, by_form(0 * p, MARK + s)),
        (SUFFIX, by_form(MARK + p, 0 * p)),
        (MIDDLE, by_form(2 * MARK + p + s, 2 * MARK + p + s)),
    ):
        at = (place + where)[moved]
        for k in range(MARK):
            out[at + k] = mark[k]
    return n, form, prefix_chars, middle_chars, out, out_offsets


def invert(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts that outputs were made of, and which can't be restored (left empty)."""
    at, whose = marks(data, offsets)
    moved = form != PLAIN
    counted = np.bincount(whose, minlength=len(form))
    good = moved & (counted == 3)
    three = at[good[whose]].reshape(-1, 3)  # marks of a text follow each other
    kinds, wanted = data[three + 1], np.array([[0] * 3, list(b"PSM"), list(b"SPM")])[form[good]]
    good[good] = (kinds == wanted).all(1) & (three[:, 0] == offsets[:-1][good])
    first, second, third = at[good[whose]].reshape(-1, 3).T
    start, end = offsets[:-1], offsets[1:]
    lost = moved & ~good
    out_offsets = np.concatenate(([0], np.cumsum(np.where(lost, 0, end - start - np.where(good, 3 * MARK, 0)))))
    base = out_offsets[:-1]
    # Where prefix, middle and suffix begin in the output; a plain text is all prefix.
    begin = np.stack([start, end, end], 1)
    length = np.stack([np.where(lost, 0, end - start), 0 * start, 0 * start], 1)
    psm = (form[good] == PSM)[:, None]
    parts = np.stack([first + MARK, third + MARK, second + MARK], 1)
    stops = np.stack([second, end[good], third], 1)
    begin[good] = np.where(psm, parts, parts[:, [2, 1, 0]])
    length[good] = np.where(psm, stops, stops[:, [2, 1, 0]]) - begin[good]
    goes_to = base[:, None] + np.cumsum(length, 1) - length
    out = np.empty(out_offsets[-1], np.uint8)
    for lo, source in displacements(goes_to.ravel(), (begin - goes_to).ravel(), len(out)):
        out[lo : lo + len(source)] = data[source]
    return out, out_offsets, lost


def _transform_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = pack(batch.column("text"))
        draws = np.stack([batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)], 1)
        for a, b in pieces(offsets):
            n, form, prefix, middle, out, ends = transform(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], draws[a:b])
            plain = form == PLAIN
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a), pa.array(n), pa.array(FORMS[form]), pa.array(prefix, mask=plain),
                    pa.array(middle, mask=plain), unpack(out, ends).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: units of each text, the form drawn for it, and the output.

    The draws are the first four groups of eight digits of the SHA-256 of ``seed:doc_id``; counts of code points are null in
    plain rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select("doc_id", clean_text().alias("text"), digest.alias("digest")).select("doc_id", "text", *draws)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _transform_batches, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )


def restore(transformed: DataFrame) -> DataFrame:
    """With ``restored``: the text of each row, made of its ``output`` and ``form`` alone."""
    rows = transformed.drop("restored")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {"psm": PSM, "spm": SPM}
        for batch in batches:
            column = batch.column("output")
            absent = column.is_null().to_numpy(zero_copy_only=False)
            data, offsets = pack(column.fill_null(""))
            form = np.array([code.get(f, PLAIN) for f in batch.column("form").to_pylist()], np.int64)
            for a, b in pieces(offsets):
                out, ends, lost = invert(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], form[a:b])
                texts = unpack(out, ends, lost | absent[a:b]).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(a, b - a) for c in names] + [texts], [*names, "restored"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())]))
