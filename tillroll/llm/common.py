"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1_000_000  # text that one numpy pass holds; one longer document is a chunk of its own


ROWS_AT_A_TIME = 1_000  # that Spark hands to a Python worker together


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, handing Python at most ``ROWS_AT_A_TIME`` rows together, as whole texts are long.

    The setting (spark.sql.execution.arrow.maxRecordsPerBatch) stays; a smaller one is left alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_AT_A_TIME:
        spark.conf.set(key, ROWS_AT_A_TIME)
    return spark


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; -1 for a missing id, which is in no fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5, F.lit(-1)).cast("int")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(name: str) -> Column:
    """The column of exactly that name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def aside(names: Iterable[str]) -> Column:
    """The caller's columns in one struct, where they clash with no column that an operator works with."""
    return F.struct(*[column(n).alias(n) for n in names])


def back(packed: str, names: Iterable[str]) -> list[Column]:
    """The caller's columns out of the struct again."""
    return [F.col(packed).getField(n).alias(n) for n in names]


def row_order(docs: DataFrame) -> Column:
    """A hash of the whole row, to choose among rows whatever their order; maps cannot be hashed and take no part."""
    return F.xxhash64(*[column(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()])


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one small aggregate that sizes the partitions of a job."""
    return docs.select(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def parts_for(total_bytes: int, part_bytes: int) -> int:
    """How many parts hold about ``part_bytes`` of text each."""
    return max(1, -(-total_bytes // part_bytes))


def text_key(column: str = "text") -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.xxhash64(F.col(column))


def chunked(batches, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut between rows so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        ends = np.cumsum(np.asarray(pc.binary_length(column).fill_null(0), dtype=np.int64))
        low = 0
        while low < len(column):
            base = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(low, high - low)
            low = high


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each text starts and the last one ends."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(bounds[0]), int(bounds[-1])
    body = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.empty(0, np.uint8)
    return body, bounds - first


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
