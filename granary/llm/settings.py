"""Session settings of the training-data operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

from granary.session import configure

# An Arrow batch ends at this size as well as at its row limit, so long texts don't make large batches.
ARROW_BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark
