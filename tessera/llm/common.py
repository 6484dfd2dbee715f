"""Shared helpers: table access, scratch tables in shared storage, grouped Arrow iteration."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tessera.storage import discard, drop_scratch, scratch, shared_dir  # noqa: F401

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more.

    Spark does so when the driver's collector finds them; a job of many steps should not wait for that.
    """
    gc.collect()
    spark._jvm.System.gc()


def least_hashed(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` rows of least hash of the given columns (about, if hashes are equal): a sample that does not
    depend on partitions.

    Rows are first thinned out by a limit on the hash that about 2 n pass, so that tasks rank few of them.
    """
    total = df.count()
    h = F.xxhash64(*columns)
    if total > 4 * n:
        df = df.where(h < F.lit(-(1 << 63) + (1 << 64) * 2 * n // total))
    return df.orderBy(h, *columns).limit(n)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(col: str, modulus: int):
    """crc32 of the id written in decimal, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def py_crc_mod(value: int | None, modulus: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def schema_with(df: DataFrame, **added: str) -> StructType:
    """The columns of ``df`` and new ones of the given types."""
    return StructType([*df.schema.fields, *(StructField(name, DataType.fromDDL(kind)) for name, kind in added.items())])


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, with leading underscores where ``docs`` has such a column (in any case)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_room(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` without columns called ``names`` (in any case): those get leading underscores and keep their values."""
    for name in names:
        for column in [c for c in docs.columns if c.lower() == name.lower()]:
            docs = docs.withColumnRenamed(column, *fresh(docs, column))
    return docs


#: Rows of an Arrow batch: texts are large, and a task holds a batch several times.
ARROW_ROWS = 256


def trim() -> None:
    """Gives memory that a worker has freed back to the system; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` over small batches; the worker's memory is trimmed when a task ends."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return df.mapInArrow(lean, schema)


def rows_by_key(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Yields one table per run of equal ``key`` in batches that are sorted by it.

    Only the run in hand is held. Callers bound the size of a run before.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                if held and keys[start] != current:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, i - start))
                current = keys[start]
                start = i
    if held:
        yield pa.Table.from_batches(held)
