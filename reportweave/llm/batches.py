"""Arrow batches in slices of bounded size, for the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

SLICE_BYTES = 4 * 1024 * 1024


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of about ``limit`` bytes; a longer row comes alone."""
    rows = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
