"""Which hashes can be frequent: counts in a fixed number of cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storelens.llm import kernels

BLOCK = 1 << 15


def frequent_cells(frame: DataFrame, hashes: Callable[[pa.RecordBatch, kernels.Texts], np.ndarray], bits: int, least: int) -> np.ndarray:
    """For each of ``2 ** bits`` cells, whether the hashes in it occur at least ``least`` times in all of ``frame.text``.

    ``hashes`` gives the 64-bit hashes of a slice of texts, repeats included; a hash's cell is its highest bits. A cell never counts less than any
    hash in it, so a hash that occurs ``least`` times is in a cell marked here; others are there by chance only. What a task sends and what
    reaches the driver depends on the number of cells alone: every task counts into cells of its own, which are packed and added up block by block.
    """
    blocks = max(1, (1 << bits) // BLOCK)
    size = (1 << bits) // blocks
    # counts may stop at the type's end, which is not below ``least``
    kind = np.dtype(np.uint8 if least <= 255 else np.uint32)
    most = np.iinfo(kind).max

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits, kind)
        for batch in batches:
            for part, texts in kernels.slices(batch):
                cell, n = np.unique((hashes(part, texts) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                held[cell] = np.minimum(held[cell].astype(np.int64) + n, most)
        schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
        for b in range(blocks):
            block = held[b * size : (b + 1) * size]
            if block.any():
                yield kernels.rows(schema, [b], [pa.compress(block.tobytes(), "zstd", asbytes=True)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, packed in zip(kernels.column(batch, "block").to_pylist(), kernels.column(batch, "counts"), strict=True):
                counts = np.frombuffer(pa.decompress(packed.as_buffer(), size * kind.itemsize, "zstd"), kind)
                sums[b] = sums.get(b, 0) + counts.astype(np.int64)
        schema = pa.schema([("block", pa.int32()), ("marks", pa.binary())])
        for b, total in sums.items():
            yield kernels.rows(schema, [b], [np.packbits(total >= least).tobytes()])

    marks = frame.mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, marks binary").toArrow()
    out = np.zeros(1 << bits, bool)
    for b, packed in zip(marks.column("block").to_pylist(), marks.column("marks").to_pylist(), strict=True):
        out[b * size : (b + 1) * size] = np.unpackbits(np.frombuffer(packed, np.uint8), count=size)
    return out
