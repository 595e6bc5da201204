"""A setting of the session that operators on texts need."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Rows go to Python workers in batches of so many bytes at most, unless the session says otherwise.

    By default a batch has 10,000 rows, whatever their texts hold.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, size)
