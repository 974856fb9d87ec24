"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text handled at once inside a task; a single longer row is handled alone.
PIECE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def pieces(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` in ``column`` (one row at least)."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        total = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + max_bytes, side="right")))
            yield batch.slice(start, end - start)
            start = end


def give_back() -> None:
    """Returns memory that a task has freed to the system: the worker lives on
    beside the next stage's tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slice_bounds(frame: DataFrame, column: str, n: int) -> list[float]:
    """At most ``n - 1`` ascending split points of a numeric column (approximate
    quantiles, computed over all rows; only the points reach the driver)."""
    if n < 2:
        return []
    found = frame.approxQuantile(column, [i / n for i in range(1, n)], 0.2 / n)
    return sorted(set(found))


def slice_of(column: str, bounds: list[float]):
    """Number of split points at or below the value; null goes to slice 0."""
    points = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
    value = F.col(column).cast("double")
    return F.coalesce(F.size(F.filter(points, lambda b: b <= value)), F.lit(0)).cast("int")


def crc_bucket(column: str, n: int):
    """crc32 of the value's decimal text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def with_fields(schema: StructType, ddl: str) -> StructType:
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
