"""What several operators share: staged tables, batches of texts, row keys."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.session import delete_path, scratch_path

#: A word, as every operator here counts it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handed to a numpy step at once, unless one text has more.
STEP_BYTES = 4_000_000
#: Rows in an Arrow batch.
BATCH_ROWS = 1000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it again: it is computed once, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in tables:
        for path in {str(file).rsplit("/", 1)[0] for file in df.inputFiles()}:
            delete_path(df.sparkSession, path)


def small_batches(df: DataFrame) -> DataFrame:
    """Let at most `BATCH_ROWS` whole texts go to a Python worker at once, unless the session asks for fewer: the default
    of 10,000 rows is a hundred megabytes of ordinary texts, and a gigabyte of long ones."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def release_memory() -> None:
    """Give memory that nothing holds back to the system: workers stay between tasks, and share their executor's limit."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_steps(batches: Iterator[pa.RecordBatch], step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `step_bytes` each (by Arrow's size of the rows, one row at least).

    Before the first and after the last, the worker gives free memory back.
    """
    release_memory()
    for batch in batches:
        rows = max(1, int(batch.num_rows * step_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    release_memory()


def gathered(batches: Iterator[pa.RecordBatch], step_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches put together to about `step_bytes` each, one batch at least; batches without rows go."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > step_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, a null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of an id's text modulo `by`: the fold of a document. NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(by)
