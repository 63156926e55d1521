"""Small helpers that run inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand tasks Arrow batches of bounded bytes, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text each; one long text is a slice of its own."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4) if len(column) else np.zeros(1, np.int32)
        ends = sizes[1:].astype(np.int64) - int(sizes[0])
        at = 0
        while at < len(ends):
            base = int(ends[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, upto - at)
            at = upto
    tidy()


def tidy() -> None:
    """Give freed memory back at the end of a task: Python workers live on and share an executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
