"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.session import drop_written, ship_package, small_batches, work_path, written

__all__ = ["BROADCAST_ROWS", "FEW_ROWS", "WORD", "byte_texts", "documents", "drop_written", "few", "hashes_written", "map_batches", "once", "row_slices", "small", "table",
           "tokenizer_path", "work_path", "written"]

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows (8-byte ids) up to which a list of ids may be broadcast: about 64 MB.
BROADCAST_ROWS = 1_000_000
#: Rows of a few numbers up to which a table may be broadcast instead of shuffled.
FEW_ROWS = BROADCAST_ROWS // 4

#: Bytes of rows from which a Python task collects its garbage at its end.
TIDY_BYTES = 256 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def hashes_written(df: DataFrame, name: str) -> DataFrame:
    """``written`` for tables of hashes and counts: without compression."""
    return written(df, name, "none")


def few(rows: DataFrame, most: int = FEW_ROWS) -> bool:
    """Whether a written table has at most ``most`` rows."""
    return rows.limit(most + 1).count() <= most


def small(ids: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``ids`` marked for broadcast if a count proves it has at most ``rows`` rows.

    Beyond that the join stays a shuffled one. ``ids`` should be a written table.
    """
    return F.broadcast(ids) if few(ids, rows) else ids


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package's modules on the workers.

    A worker that has done its task waits idle beside the executor's heap, so
    it gives freed memory back to the system first. What travels at once is
    bounded, see ``small_batches``.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(partial(_tidied, fn=fn), schema)


def _tidied(batches: Iterator[pa.RecordBatch], fn) -> Iterator[pa.RecordBatch]:
    read = 0

    def counted() -> Iterator[pa.RecordBatch]:
        nonlocal read
        for batch in batches:
            read += batch.nbytes
            yield batch

    try:
        yield from fn(counted())
    finally:
        # The collection costs a task of few rows more than its rows do.
        if read > TIDY_BYTES:
            gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column computed once: an explode() is not copied into the expressions that use it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes objects."""
    return column.cast(pa.large_binary()).to_pylist()


def row_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose text stays near ``max_bytes`` each.

    A slice always holds at least one row, so one longer text makes a slice of
    its own; what a task holds follows the longest text, not the batch size.
    """
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizer file lies; read on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)
