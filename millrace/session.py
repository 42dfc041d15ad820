"""Sessions, their sizing, and scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


PARTITION_BYTES = 256 * 1024 * 1024
MOST_PARTITIONS = 50_000
#: Bits of the Bloom filter that a join's smaller side may put before the larger one's shuffle,
#: and keys it is made for. It is broadcast, so its 8 MB are the bound.
FILTER_BITS = 1 << 26
FILTER_KEYS = 8_000_000
#: A side estimated to be larger (some 30 bytes a key) would fill the filter: it makes none.
FILTERED_BY_BYTES = 30 * FILTER_KEYS


def size_for(spark: SparkSession, input_bytes: int) -> None:
    """Fit the session's shuffles to the largest input of a job.

    Adaptive execution merges shuffle partitions but never adds any, so their number has
    to start from the data: Spark's 200 would be half a terabyte each for 100 TB. Beyond
    ``MOST_PARTITIONS`` the blocks of a shuffle cost more than larger partitions that spill.
    Spark's own Bloom filters before joins are made for sides beyond its broadcast limit, too.
    """
    wanted = -(-input_bytes // PARTITION_BYTES)
    cores = spark.sparkContext.defaultParallelism
    settings = {
        "spark.sql.shuffle.partitions": min(max(wanted, cores), MOST_PARTITIONS),
        "spark.sql.files.maxPartitionBytes": PARTITION_BYTES,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARTITION_BYTES,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": FILTERED_BY_BYTES,
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": FILTER_KEYS,
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": FILTER_KEYS,
        "spark.sql.optimizer.runtime.bloomFilter.numBits": FILTER_BITS,
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": FILTER_BITS,
    }
    for name, value in settings.items():
        spark.conf.set(name, str(value))


#: For a run of many jobs, whose shuffles would otherwise lie on disk until the driver next collects
#: garbage. Rows that go into few slices are written as they come, and others are read in splits whose
#: rows can be sorted in memory, where they take some ten times what they take in Parquet: neither spills.
FRUGAL = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.files.maxPartitionBytes": str(32 << 20),
    "spark.sql.files.openCostInBytes": str(128 << 10),
}


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the session's jobs keep less on disk; see ``FRUGAL``."""
    before = {name: spark.conf.get(name) for name in FRUGAL}
    for name, value in FRUGAL.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "millrace") -> SparkSession:
    """For tests, the bench and trials; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is that Spark writes to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for this run under ``spark.checkpoint.dir``, shared by all executors.

    Where the setting is missing, a temporary folder serves a local master only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/millrace/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="millrace-"), purpose)
