"""Incremental form of the monthly back-fill: new ledger files become silver snapshots.

The unit of work is a snapshot, as in the batch jobs.  Files that arrived since the last run are found by the file
source's checkpoint, cleaned, and replace the snapshots they hold.  A repeated micro-batch after a failure
writes the same partitions again, so nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from creditloom import fixed_values as fixed
from creditloom.operators.silver import clean_loans
from creditloom.sources import sinks

TEXT_LEDGER = T.StructType([T.StructField(c, T.StringType()) for c in fixed.LEDGER_TYPES])


def ledger_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger files as they arrive, cleaned row by row; every column starts as text.  A header that does not name the
    columns in the ledger's order stops the run instead of shifting values."""
    reader = spark.readStream.schema(TEXT_LEDGER).option("header", True).option("enforceSchema", False)
    return clean_loans(reader.csv(folder))


def ingest_new_snapshots(spark: SparkSession, folder: str, silver: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop.  Each file holds whole snapshots and one snapshot's files arrive together, as
    the monthly extracts do."""

    def write(batch: DataFrame, _: int) -> None:
        sinks.write_snapshots(batch, silver)

    return (
        ledger_arrivals(spark, folder)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
