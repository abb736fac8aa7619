"""The quality rules on newly arriving files, with the batch job's own code.

The rules look at one row at a time, so a stream needs no state for them. One
row per key is a property of the whole table and is left to the batch job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.clean import rejected, valid_rows
from ledgerloom.sources import files


def _day(spark: SparkSession, path: str, as_of: dt.date | str | None) -> str:
    """The day by which a batch is judged: as given, or as stored when it was first read."""
    if as_of is not None:
        return str(as_of)
    try:
        return spark.read.schema("day string").json(path).first()["day"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    today = spark.range(1).select(F.current_date().cast("string").alias("day"))
    today.write.mode("overwrite").json(path)
    return spark.read.schema("day string").json(path).first()["day"]


def ingest(
    spark: SparkSession,
    table: str,
    source: str,
    target: str,
    checkpoint: str,
    as_of: dt.date | str | None = None,
    fmt: str = "csv",
) -> StreamingQuery:
    """Split the files that have arrived in ``source`` into valid and rejected rows.

    Each batch owns a directory that a replay overwrites, so rows are stored
    exactly once. The query ends when all files present have been read. CSV columns are
    found by name, as the batch reader does; a file whose header is another than that of
    the files present at the start stops the query. A batch is judged as of one day,
    today unless given, that stands with its files, so a replay judges by the same.
    """
    if fmt == "csv":
        schema = files.csv_schema(spark, source, table)
    else:
        schema = spark.read.format(fmt).load(source).schema
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = files.csv_options(reader)

    def store(batch: DataFrame, batch_id: int) -> None:
        day = _day(batch.sparkSession, f"{target}/as_of/{table}/batch_id={batch_id}", as_of)
        rows = files.typed(batch, table).persist()  # both outputs from one reading
        try:
            for kind, part in (
                ("valid", valid_rows(rows, table, day)),
                ("rejected", rejected(rows, table, day)),
            ):
                part.write.mode("overwrite").parquet(f"{target}/{kind}/{table}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return (
        reader.load(source)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
