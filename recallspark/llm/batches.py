"""Working through Arrow batches in pieces of bounded text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task holds in decoded form at once (one longer text is a piece by itself).
PIECE_BYTES = 1_000_000


def pieces(batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, cut so that the texts of a piece sum to about ``limit``."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def texts(batch: pa.RecordBatch, text_col: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]


def lists(values, offsets) -> pa.Array:
    """A list column from flat values and row offsets (numpy)."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
