"""Memory of Python tasks: texts cross in small batches, and what a task has freed goes back to the machine.

An executor's memory is its heap, what the JVM holds beside it, and its Python workers, which live on from task to
task and from stage to stage. Batches of 10,000 texts are tens of megabytes, held outside the heap on their way and
once more in the worker; and allocators keep what was freed for a next task that may never come.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

# Bytes of a batch that crosses to Python; operators slice texts to this size or less anyway.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Rows cross to Python ``BATCH_BYTES`` at a time (or one longer row), unless the session has a size of its own.

    The setting stays with the session, because what a stage returns runs later. Results do not depend on it.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Returns to the machine what Arrow's pool and the C library hold free."""
    pa.default_memory_pool().release_unused()
    # Only glibc has it, and needs it.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def over_batches(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` for ``mapInArrow``, giving its memory back when it ends."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def over_table(task: Callable[[pa.Table], pa.Table]):
    """``task`` for ``applyInArrow`` of a group, giving its memory back when it ends."""

    @functools.wraps(task)
    def run(table: pa.Table) -> pa.Table:
        try:
            return task(table)
        finally:
            give_back()

    return run
