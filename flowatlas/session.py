"""Session settings and the shared folder for intermediate tables."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowatlas")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", True)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", False)
        .config("spark.ui.showConsoleProgress", False)
        .getOrCreate()
    )


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="flowatlas-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`, which all executors can reach.

    Only a local session may leave the setting out; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries of the session remove their shuffle files as they end, not when the driver collects garbage.

    For steps that write what they compute and read that back: a frame that is executed a second
    time makes its shuffles anew.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, True)
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
