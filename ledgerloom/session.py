"""Session settings for the batch job, the tests and the benchmark.

The operators themselves read no settings from here: they also run in a
session that somebody else has built.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # skip the sorts of a join whose measured partitions all fit in memory
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the SQL defaults; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: codec of the batch job's tables, most of which are ids: they take about half of what Spark's default makes of them
CODEC = "zstd"


@contextmanager
def unsorted_partitions(spark: SparkSession, values: int) -> Iterator[None]:
    """Writes by a partition column of at most ``values`` values need no sort of whole rows.

    Without it each task sorts all its rows, and spills them when they don't fit. More values than
    stated are still written right: a task then sorts what is left.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(values))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/ledgerloom/{label}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    For results that a plan uses more than once: the table survives the loss of
    executors and later reads prune columns and know the real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
