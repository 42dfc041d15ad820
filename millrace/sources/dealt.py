"""Rows dealt out by key once, as Parquet, in place of a shuffle by each of their readers.

Shuffled rows take some three times the bytes of Parquet, which stores columns, and every reader
shuffles them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.lake import CODEC

#: Smaller inputs are left to Spark, which broadcasts or shuffles them.
LEAST_BYTES = 32 << 20
#: Larger ones are shuffled: tasks times buckets, the number of files, grows with the square of the input.
MOST_BYTES = 16 << 30
#: Stored bytes that a bucket is meant for: a task sorts some ten times that.
BUCKET_BYTES = 32 << 20
#: A bucket of more than so many times that holds hot keys, which only a shuffle splits or limits.
SKEWED = 4


def buckets_for(spark: SparkSession, size: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))


def skewed(spark: SparkSession, folder: str) -> bool:
    """Whether a bucket is far larger than meant, by the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    bucket = F.regexp_extract("path", r"_(\d+)\.c\d+[^/]*$", 1)
    sizes = files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes"))
    return not sizes.where(F.col("bytes") > SKEWED * BUCKET_BYTES).isEmpty()


def dealt(df: DataFrame, folder: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` stored in buckets by the hash of its keys, and read again.

    Joins, windows and groups by the keys then need no shuffle. With a hot key the rows are read
    as if they were not in buckets, so Spark shuffles them as it does any others. Spark knows of
    buckets by its catalog only: the table is named there until it is read.
    """
    spark, name = df.sparkSession, f"millrace_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, *keys)
    writer.option("compression", CODEC).option("path", folder).saveAsTable(name)
    try:
        if skewed(spark, folder):
            return spark.read.schema(df.schema).parquet(folder)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay
