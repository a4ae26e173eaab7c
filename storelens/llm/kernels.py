"""Numpy kernels over the UTF-8 buffers of Arrow batches.

Tasks get their texts as Arrow batches and work on slices of at most ``SLICE`` bytes (one text at
least) and ``MOST_ROWS`` rows, so what a worker holds is bounded by that or by its longest text. Word and sequence
hashes have 64 bits; equal sequences have equal hashes in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 21
MOST_ROWS = 1 << 15
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=_U)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    if (have := _powers.get(base)) is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=_U)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 1 << 20:
            _powers[base] = have
    return have[:n]


class Texts:
    """Some texts in one buffer. ``bounds`` has where each begins, and the end."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.bounds)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+``: byte spans, and the first word of each text."""

    def __init__(self, texts: Texts, apart: np.ndarray = _SPACE):
        gap = apart[texts.data]
        self.texts = texts
        self.starts, self.ends = spans(~gap, texts.bounds)
        self.first = np.searchsorted(self.starts, texts.bounds)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.texts)), self.count)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.texts.data, self.starts, self.ends)

    def left(self) -> np.ndarray:
        """How many words of its text begin at each word, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self))


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that stay within one text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(bounds))
    edges = bounds[filled]
    begins[edges] = inside[edges]
    edges = bounds[filled + 1] - 1
    ends[edges] = inside[edges]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    out = mix(size.astype(_U) + _U(_BASE))
    todo, at, left = np.arange(len(starts)), starts, size
    while len(todo):
        block = eight[at] & _MASK[np.minimum(left, 8)]
        out[todo] = mix(out[todo] * _U(5) ^ block)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


class Sequences:
    """Hashes of any run of word hashes, from their prefix sums."""

    def __init__(self, hashes: np.ndarray):
        self.sums = np.zeros(len(hashes) + 1, _U)
        np.cumsum(hashes * _power(_BASE, len(hashes)), out=self.sums[1:])
        self.back = _power(_INVERSE, len(hashes) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(raw + (ends - starts).astype(_U))

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k words from each place; the last k - 1 places have none."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, _U)
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n] + _U(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each place."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[: len(out) - have], out[have:]), have * 2
    if have < width:
        rest = width - have
        out = np.minimum(out[: len(out) - rest], out[rest:])
    return out


def ragged(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``firsts[0], firsts[0] + 1, ...`` with ``counts[0]`` numbers, then the next run."""
    counts = np.asarray(counts, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(np.asarray(firsts, np.int64) - before, counts)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch with at most ``limit`` bytes of text, one row at least; nulls read as empty."""
    filled = pc.fill_null(column(batch, name), pa.scalar("", column(batch, name).type)).cast(pa.large_string())
    if not len(filled):
        return
    _, offsets, data = filled.buffers()
    bounds = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(filled):
        end = min(row + MOST_ROWS, max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1))
        yield batch.slice(row, end - row), Texts(every[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


def rows(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema
    )
