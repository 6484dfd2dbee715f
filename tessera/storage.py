"""Intermediate tables in shared storage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, SparkSession] = {}
_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where that is unset, a local session (as in tests) gets a temporary folder; on a cluster that is an error, as
    executors do not share such a folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tessera-scratch-"))
    return _LOCAL[0]


def scratch(df: DataFrame, tag: str) -> DataFrame:
    """Cuts lineage: writes ``df`` as Parquet into shared storage and reads it back.

    A lost executor costs nothing that was written. The files are deleted when the
    driver ends, or before by ``discard`` or ``drop_scratch``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    _WRITTEN[path] = spark
    return out


def _delete(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def discard(*tables: DataFrame | None) -> None:
    """Deletes tables that ``scratch`` has returned and that no plan will read any more; others are left alone."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path in _WRITTEN:
            _delete(_WRITTEN.pop(path), path)


def drop_scratch() -> None:
    while _WRITTEN:
        path, spark = _WRITTEN.popitem()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; shared storage keeps the files
            return


atexit.register(drop_scratch)
