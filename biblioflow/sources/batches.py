"""Bounds on the Arrow batches that pass between the JVM and Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows in an Arrow batch; texts can be long, so batches are kept far below Spark's default.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)
