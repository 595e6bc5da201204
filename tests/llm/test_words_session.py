"""Batches that go to Python workers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from retailstrata.llm.session import BATCH_BYTES, bounded_batches


def test_batches_are_bounded_by_bytes_unless_the_session_says_otherwise(spark):
    before = spark.conf.get(BATCH_BYTES)
    set_before = BATCH_BYTES in spark.conf.getAll
    try:
        spark.conf.unset(BATCH_BYTES)
        bounded_batches(spark, "100k")

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

        df = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("t"))
        found = [r["n"] for r in df.mapInArrow(sizes, "n long").collect()]
        assert len(found) > 40 and max(found) < 150_000
        bounded_batches(spark, "1g")
        assert spark.conf.get(BATCH_BYTES) == "100k"
    finally:
        spark.conf.set(BATCH_BYTES, before) if set_before else spark.conf.unset(BATCH_BYTES)
