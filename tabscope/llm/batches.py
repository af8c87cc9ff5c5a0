"""Arrow batches cut to bounded text, for operators that run in Python workers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text at most (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column with null read as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]
