"""What tasks of all operators share: small batches, and memory that is given back between stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROWS = 256
#: A batch on its way to a worker is closed at this size, however few rows it has: some texts are megabytes long.
BATCH_BYTES = 8 << 20

_clear: list[Callable[[], None]] = []
_stage: int | None = None


def on_new_stage(clear: Callable[[], None]) -> None:
    """`clear` empties a memo of this process when it gets a task of another stage. Workers outlive stages."""
    _clear.append(clear)


def _give_back() -> None:
    """What the stage before has freed goes back to the system; the allocator would keep it for this process."""
    gc.collect()
    with suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows, so that only a piece is held as Python objects."""
    global _stage
    context = TaskContext.get()
    if context is not None and context.stageId() != _stage:
        _stage = context.stageId()
        for clear in _clear:
            clear()
        _give_back()
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType | str, rows: int = ROWS) -> DataFrame:
    """mapInArrow that gets `rows` rows at a time: Spark's default of 10,000 whole texts is held by the JVM, outside
    its heap, and by the worker at once. The setting is the session's, and holds for what runs until the next call."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
