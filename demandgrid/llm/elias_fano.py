"""Elias-Fano sequences in numpy arrays that can lie in a memory-mapped file."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

import numpy as np

ONE = np.uint64(1)


# Broadword constants: a byte's worth of each pattern in all eight bytes.
_1, _0F, _33, _55, _80 = (np.uint64(int(x * 8, 16)) for x in ("01", "0f", "33", "55", "80"))
#: Place of the r-th set bit of a byte, at 8 * byte + r.
IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for b in range(256) for r in range(8)], np.uint8)


def _select(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th set bit (from 0) of each word: sums up to each byte name the byte, a table the bit."""
    r = r.astype(np.uint64)
    sums = word - ((word >> ONE) & _55)
    sums = (sums & _33) + ((sums >> np.uint64(2)) & _33)
    sums = ((sums + (sums >> np.uint64(4))) & _0F) * _1
    place = np.bitwise_count((((r * _1) | _80) - sums) & _80).astype(np.uint64) * np.uint64(8)
    before = ((sums << np.uint64(8)) >> place) & np.uint64(255)
    return (place + IN_BYTE[(((word >> place) & np.uint64(255)) * np.uint64(8) + r - before).astype(np.int64)]).astype(np.int64)


@dataclass
class EliasFano:
    """A non-decreasing sequence: ``low`` holds the last ``width`` bits of each value, packed; ``upper`` has, for each value of the
    leading bits, a one per member and then a zero. ``ones`` and ``zeros`` count them before each word of ``upper``."""

    n: int
    width: int
    low: np.ndarray
    upper: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, most = len(values), int(values[-1]) + 1 if len(values) else 1
        width = min(56, max(0, (most // max(n, 1)).bit_length() - 1))
        bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & ONE).astype(np.uint8)
        low = np.concatenate((np.packbits(bits.reshape(-1), bitorder="little"), np.zeros(8, np.uint8)))
        high = (values >> np.uint64(width)).astype(np.int64)
        length = n + (most >> width) + 2
        unary = np.zeros(-(-length // 64) * 64, np.uint8)
        unary[high + np.arange(n)] = 1
        upper = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)))[:-1]
        return cls(n, width, low, upper, ones, np.arange(len(upper), dtype=np.int64) * 64 - ones)

    def _nth(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        word = np.searchsorted(before, k, side="right") - 1
        bits = np.asarray(self.upper[word])
        return word * 64 + _select(~bits if flip else bits, k - before[word])

    def _next_zero(self, at: np.ndarray) -> np.ndarray:
        """Place of the first zero of ``upper`` at or after each place."""
        word = at >> 6
        rest = ~self.upper[word] >> (at & 63).astype(np.uint64)
        found = at + np.bitwise_count(~rest & (rest - ONE))
        todo = np.flatnonzero(rest == 0)
        while len(todo):
            word[todo] += 1
            rest = ~self.upper[word[todo]]
            found[todo] = word[todo] * 64 + np.bitwise_count(~rest & (rest - ONE))
            todo = todo[rest == 0]
        return found

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        eight = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        return (eight[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        high = (self._nth(i, self.ones, False) - i).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._lows(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value in a strictly increasing sequence, -1 if absent: its leading bits name a short run, which is
        searched by halving."""
        found = np.full(len(values), -1, np.int64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        n_zeros = int(len(self.upper)) * 64 - self.n
        inside = np.flatnonzero((high >= 0) & (high < n_zeros - 1)) if self.n else np.zeros(0, np.int64)
        h, low = high[inside], values[inside] & np.uint64((1 << self.width) - 1)
        # The run lies between the zero before it and the next zero.
        at = np.where(h > 0, self._nth(np.maximum(h - 1, 0), self.zeros, True) + 1, 0)
        lo, hi = at - h, self._next_zero(at) - h
        end = hi.copy()
        todo = np.flatnonzero(lo < hi)  # most runs are short: only those still open are halved again
        while len(todo):
            left, right = lo[todo], hi[todo]
            mid = (left + right) >> 1
            less = self._lows(mid) < low[todo]
            left, right = np.where(less, mid + 1, left), np.where(less, right, mid)
            lo[todo], hi[todo] = left, right
            todo = todo[left < right]
        at = np.minimum(lo, self.n - 1)
        found[inside] = np.where((lo < end) & (self._lows(at) == low), lo, -1)
        return found


def save(path: str, **parts: EliasFano | np.ndarray | float) -> None:
    """One file with all parts; complete under its name or not there."""
    head, arrays, at = {}, [], 0
    for name, part in parts.items():
        if isinstance(part, EliasFano):
            fields = {"low": part.low, "upper": part.upper, "ones": part.ones, "zeros": part.zeros}
            head[name] = {"n": part.n, "width": part.width}
        elif isinstance(part, np.ndarray):
            fields = {"": part}
            head[name] = {}
        else:
            head[name] = part
            continue
        for field, array in fields.items():
            array = np.ascontiguousarray(array)
            head[name][f"at_{field}"] = [at, str(array.dtype), len(array)]
            pad = -array.nbytes % 8
            arrays.append(array.tobytes() + b"\0" * pad)
            at += array.nbytes + pad
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    hidden = f"{path}.{uuid.uuid4().hex}"
    with open(hidden, "wb") as f:
        f.write(len(text).to_bytes(8, "little") + text)
        f.writelines(arrays)
    os.replace(hidden, path)


def load(path: str) -> dict:
    """The parts of a file, memory-mapped."""
    data = np.memmap(path, np.uint8, "r")
    size = int(data[:8].view("<u8")[0])
    head = json.loads(data[8 : 8 + size].tobytes())

    def array(spec: list) -> np.ndarray:
        at, kind, n = spec
        start = 8 + size + at
        return np.asarray(data[start : start + n * np.dtype(kind).itemsize]).view(kind)

    found = {}
    for name, spec in head.items():
        if not isinstance(spec, dict):
            found[name] = spec
        elif "n" in spec:
            found[name] = EliasFano(spec["n"], spec["width"], *(array(spec[f"at_{f}"]) for f in ("low", "upper", "ones", "zeros")))
        else:
            found[name] = array(spec["at_"])
    return found
