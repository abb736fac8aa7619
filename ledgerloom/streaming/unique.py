"""Repeated keys of a stream, found by state that is kept per key.

``ingest`` judges rows one by one; this query remembers, for every key that has arrived, how
many rows had it and which valid row comes first. A later row may come first, or be the second
of its key, however late it is: the key's state changes, and the batch stores its new values.
The state is partitioned by key and as large as the table of keys; on a cluster, let the RocksDB
state store hold it (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import clean as cleaning
from ledgerloom.operators.rules import FIRST_BY, UNIQUE_METRIC
from ledgerloom.schemas import PRIMARY_KEY, RAW
from ledgerloom.sources import files


def _keys(rows: DataFrame, table: str) -> DataFrame:
    """Per key: how many rows have it, valid or not, and the first valid one, NULL without any."""
    key = PRIMARY_KEY[table]
    valid = cleaning.is_valid(rows, table)
    first = F.min(F.when(valid, F.struct(*FIRST_BY[table])))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), first.alias("first"))


def track_keys(
    spark: SparkSession, table: str, source: str, target: str, checkpoint: str, fmt: str = "csv"
) -> StreamingQuery:
    """Follow the keys of the files in ``source``; each batch stores the keys that it changed.

    A batch owns a directory that a replay overwrites with the same rows. The query ends when all
    files present have been read.
    """
    if table not in UNIQUE_METRIC:
        raise ValueError(f"keys of {table!r} need not be unique")
    if fmt == "csv":
        reader = files.csv_options(spark.readStream.schema(files.csv_schema(spark, source, table)))
    else:
        reader = spark.readStream.schema(spark.read.format(fmt).load(source).schema)
    rows = files.typed(reader.format(fmt).load(source), table)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/keys/{table}/batch_id={batch_id}")

    return (
        _keys(rows, table)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keys(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Every key with its latest state: ``rows`` and ``first``.

    The latest state is the one that has seen most rows. That holds too after a lost checkpoint,
    when the stream begins again with batch 0 over all files.
    """
    stored = spark.read.parquet(f"{target}/keys/{table}")
    latest = F.max_by(F.struct("rows", "first"), F.struct("rows", "batch_id"))
    key = PRIMARY_KEY[table]
    return stored.groupBy(key).agg(latest.alias("state")).select(key, "state.*")


def clean(spark: SparkSession, target: str, table: str) -> DataFrame:
    """The clean table of all that has arrived, as the batch job gives it."""
    found = keys(spark, target, table).where(F.col("first").isNotNull())
    return found.select(PRIMARY_KEY[table], "first.*").select(*RAW[table].fieldNames())


def repeated(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Keys that more than one row has, valid or not, and how many have it."""
    return keys(spark, target, table).where("rows > 1").select(PRIMARY_KEY[table], "rows")
