"""Where intermediate files go: the shared folder the cluster names, never a machine's own disk."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="retailstrata-")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under ``spark.checkpoint.dir``.

    Where that is unset a local session gets a temporary folder; a cluster session must name one, as
    its executors do not share the driver's disk.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(app)


def _target(spark: SparkSession, path: str):
    """A path and its file system, whichever Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _target(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is not there is none to delete."""
    target, files = _target(spark, path)
    files.delete(target, True)


def few_rows(spark: SparkSession, names: Sequence[str], rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows of texts and numbers, made without Python workers."""
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


# Tasks read so much of the files and, after a shuffle, are given so much, that whole rows of it fit in memory.
READ, GIVEN = 32 << 20, 32 << 20


@contextmanager
def smaller_tasks(spark: SparkSession, read: int = READ, given: int = GIVEN) -> Iterator[None]:
    """What runs meanwhile reads and is given at most so many bytes in a task, so that nothing is spilled to disk."""
    limits = {"spark.sql.files.maxPartitionBytes": read, "spark.sql.adaptive.advisoryPartitionSizeInBytes": given}
    before = {key: spark.conf.get(key) for key in limits}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    try:
        for key, limit in limits.items():
            spark.conf.set(key, str(min(limit, in_bytes(before[key]))))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def release(spark: SparkSession) -> None:
    """Delete shuffle files that nothing refers to. Spark does so when the JVM finds them, which it may not for long."""
    spark._jvm.System.gc()
