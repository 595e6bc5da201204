"""Layer tables in the catalog. The storage format is a parameter ("delta" where it is installed)."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FORMAT = "parquet"
# Tables are written, and rewritten by each run, in the smaller of the codecs that Spark's readers all know.
COMPRESSION = {"parquet": "zstd", "orc": "zstd"}


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
    bucket_by: str | None = None,
) -> None:
    """Replace the whole table by ``df``; ``path`` places it outside the warehouse folder.

    With ``buckets`` the rows are stored by hash of ``bucket_by``, so that later joins and aggregates
    on it need no shuffle of this table. Only for a column whose values are spread evenly: a bucket is
    read by one task.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if fmt in COMPRESSION:
        writer = writer.option("compression", COMPRESSION[fmt])
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets is not None:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def gathered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> DataFrame:
    """Rows of a partition brought together and sorted, so that few files are written for each.

    The rebalance hint lets adaptive execution split a partition value that holds a large share.
    """
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *cluster_by)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace only the partitions of the table that occur in ``df``.

    An insert into a table heeds the session's setting only (the writer option of that name is for paths). It is
    set in a session of its own with the same settings otherwise, so that other writes of this one are untouched.
    """
    spark = df.sparkSession
    rows = df.select(*[df[f"`{c}`"] for c in spark.table(name).columns])
    database, _, table = name.rpartition(".")
    child, view = spark.newSession(), f"replacing_{uuid4().hex}"
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            child.conf.set(key, value)
    child.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows.createGlobalTempView(view)
    try:
        whole = f"{database or spark.catalog.currentDatabase()}.{table}"
        child.table(f"global_temp.{view}").write.mode("overwrite").insertInto(whole)
    finally:
        spark.catalog.dropGlobalTempView(view)
        spark.catalog.refreshTable(name)


def drop_if(spark: SparkSession, name: str, view: bool) -> None:
    """Drop what has this name if it is a view, or if it is a table, to make room for the other."""
    if spark.catalog.tableExists(name) and (spark.catalog.getTable(name).tableType == "VIEW") == view:
        spark.sql(f"DROP {'VIEW' if view else 'TABLE'} {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
