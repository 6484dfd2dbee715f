"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, so that they find it wherever the session was started."""
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), "tessera"), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)  # the driver serves it; no executor reads that folder


def build_session(app_name: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC, and a warehouse outside the repository.

    ``conf`` keys use double underscores for dots: ``spark__sql__shuffle__partitions="8"``. On a cluster they must
    name ``spark__checkpoint__dir``, a folder that the driver and all executors share; the package is sent along.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if (master or "local").startswith("local"):  # a cluster's own setting stays
        settings["spark.sql.warehouse.dir"] = os.path.join(tempfile.gettempdir(), "tessera-warehouse")
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    spark = builder.config(map=settings).getOrCreate()
    ship(spark)
    return spark
