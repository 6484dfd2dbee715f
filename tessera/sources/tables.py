"""Tables on storage: header-checked text, manifests, tiled and sharded Parquet, validated writes."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.contracts import Check, DataContractError, row_count

_NO_NULL = "\x01none\x01"  # no text is read as null, so that empty and absent stay apart


def text_table(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, empty_as_null: bool = False) -> DataFrame:
    """Headered tab-separated files as text columns, without inference; several files are one relation.

    With ``columns`` every file's header must be just those, in order.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = spark.read.text(paths).where(F.col("value") != "").select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"))
    if columns is None:
        columns = header.orderBy("n").first()["value"].split("\t")
    else:
        first = header.groupBy("file").agg(F.min_by("value", "n").alias("value"))
        Check("header is " + ",".join(columns), first.where(F.col("value") != "\t".join(columns))).run()
    schema = StructType([StructField(c, StringType()) for c in columns])
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("enforceSchema", False)
    df = reader.option("nullValue", _NO_NULL).option("emptyValue", "").option("mode", "FAILFAST").csv(paths)
    clean = {c: F.coalesce(F.col(c), F.lit("")) for c in columns}
    return df.select(*((F.nullif(v, F.lit("")) if empty_as_null else v).alias(c) for c, v in clean.items()))


def dataset(spark: SparkSession, manifest: str, partitions: Sequence[str] | None = None) -> DataFrame:
    """A dataset by its JSON manifest: {"format", "columns", "partitions": [{"partition_id", "path", "rows"}]}.

    ``partition_id`` is a column; row counts are checked against the manifest.
    """
    text = "\n".join(r["value"] for r in spark.read.text(manifest).collect())
    spec = json.loads(text)
    base = manifest.rsplit("/", 1)[0]
    chosen = [p for p in spec["partitions"] if partitions is None or p["partition_id"] in set(partitions)]
    if partitions is not None and len(chosen) != len(set(partitions)):
        raise DataContractError(f"partitions are missing from {manifest}")
    out = None
    for p in chosen:
        path = f"{base}/{p['path']}"
        df = spark.read.parquet(path) if spec["format"] == "parquet" else text_table(spark, path, spec["columns"])
        df = df.select(*spec["columns"], F.lit(p["partition_id"]).alias("partition_id"))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise DataContractError(f"{manifest} names no partitions")
    counted = out.groupBy("partition_id").agg(F.count("*").alias("rows"))
    want = spark.createDataFrame([(p["partition_id"], int(p["rows"])) for p in chosen], "partition_id string, rows long")
    both = counted.withColumnRenamed("rows", "found").join(want, "partition_id", "full")
    Check("partition rows equal the manifest", both.where(~F.col("found").eqNullSafe(F.col("rows")))).run()
    return out


def union_exact(*frames: DataFrame) -> DataFrame:
    """Concatenates tables of equal columns."""
    first = frames[0]
    for f in frames[1:]:
        if f.columns != first.columns:
            raise DataContractError(f"columns differ: {first.columns} and {f.columns}")
    out = first
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def repaired(base: DataFrame, supplement: DataFrame, on: Sequence[str], columns: Sequence[str], replace: Column) -> DataFrame:
    """Base rows whose columns come from the supplement where it has the key and ``replace`` holds."""
    other = supplement.select(*on, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_there"))
    joined = base.join(other, list(on), "left")
    use = F.coalesce(F.col("_there") & replace, F.lit(False))
    return joined.withColumns({c: F.when(use, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(*base.columns)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Hive-partitioned ZSTD Parquet. One task may hold many partition values, so rows are first dealt
    by them and a spread of the rest, which keeps both hot values and file numbers in hand."""
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    df.repartition(*by, spread).write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_checked(df: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    """Writes, reads back, and compares columns and (if given) the number of rows."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.parquet(path)
    if back.columns != df.columns:
        raise DataContractError(f"columns changed on write: {df.columns}, {back.columns}")
    if rows is not None:
        row_count(path, back, rows).run()
    return back


def write_shards(df: DataFrame, path: str, order: Sequence[str], most: int = 250_000) -> None:
    """Ordered shards of at most ``most`` rows: range partitions, sorted inside, files cut by rows."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", most).parquet(path)


def write_text(df: DataFrame, path: str, order: Sequence[str] | None = None) -> None:
    """Gzip tab-separated text with a header; empty for null."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.write.option("sep", "\t").option("header", True).option("nullValue", "").option("emptyValue", "").option("compression", "gzip").csv(path)


def append_fragments(df: DataFrame, path: str, key: Sequence[str], tile: str) -> int:
    """Appends rows whose key the tiled store lacks; returns how many. Content decides, so a repeat adds nothing."""
    spark = df.sparkSession
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    rows = df.dropDuplicates(list(key))
    if hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        rows = rows.join(spark.read.parquet(path).select(*key), list(key), "left_anti")
    rows = rows.persist()
    n = rows.count()
    if n:
        rows.write.mode("append").partitionBy(tile).option("compression", "zstd").parquet(path)
    rows.unpersist()
    return n


def register(spark: SparkSession, name: str, rows, schema: str) -> DataFrame:
    """In-memory rows as a view."""
    df = spark.createDataFrame(rows, schema)
    df.createOrReplaceTempView(name)
    return df
