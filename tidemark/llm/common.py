"""Tables, stored intermediates and text conventions shared by the operators."""

from __future__ import annotations

import ctypes
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, remove_stored

# White space and words are ASCII conventions throughout; other characters belong to words.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SCOPE: ContextVar[str] = ContextVar("scope", default="")
_LINES: dict[tuple, str] = {}


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    return materialize(df, f"llm/{_SCOPE.get()}{name}")


@contextmanager
def stage_of(spark: SparkSession, line: str) -> Iterator[None]:
    """What is stored inside belongs to one stage of a line of stages, and is deleted when the line's next stage begins.

    By then the stage's own result has been written. Lines are told apart by their name, the session and the thread.
    """
    key = (spark.sparkContext.applicationId, threading.get_ident(), line)
    if last := _LINES.pop(key, None):
        remove_stored(spark, f"llm/{last}")
    _LINES[key] = uuid.uuid4().hex
    token = _SCOPE.set(f"{_LINES[key]}/")
    try:
        yield
    finally:
        _SCOPE.reset(token)


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The stored rows with a number each, in a new column of the returned name; what is stored keeps its numbers."""
    row = "_row"
    while row in df.columns:
        row += "_"
    return store(df.withColumn(row, F.monotonically_increasing_id()), name), row


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes, without decoding them."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the machine: Python workers live on between tasks, and the JVM beside them needs it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def settled(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that gives freed memory back before its first and after its last batch."""

    def task(batches: Iterator) -> Iterator:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def batches_of(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each, or a single row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)
