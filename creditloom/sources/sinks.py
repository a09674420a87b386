"""Writers.

Every snapshot store is one dataset partitioned by date.  A back-fill replaces the snapshots it holds and no other, a
rebuild replaces the store, so any run can be repeated.  Rows are first rebalanced on the partition column: files come out at a sensible size, and a
snapshot that holds much of the data is written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "snapshot_date"


#: Between the values of a row that travels as one text, and in place of a missing one: line ends, which no value of a
#: file that is read line by line can hold.
GAP, MISSING = "\n", "\r"


def rebalanced(df: DataFrame, by: list[str], lines: bool = False) -> DataFrame:
    """Rows together by partition in parts of a sensible size.

    With ``lines``, all columns are text without line ends, and a row travels as one text: every text column of a row
    costs a shuffle its place, length and padding."""
    rest = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in df.columns if c not in by]
    if not (lines and rest):
        return df.hint("rebalance", *by)
    packed = df.select(*by, F.array_join(F.array(*rest), GAP, MISSING).alias("__row")).hint("rebalance", *by)
    values = packed.withColumn("__row", F.split("__row", GAP))
    names = [c for c in df.columns if c not in by]
    back = {c: F.nullif(F.col("__row")[at], F.lit(MISSING)).alias(c) for at, c in enumerate(names)}
    return values.select(*[back.get(c, c) for c in df.columns])


def write_snapshots(
    df: DataFrame, path: str, partition: str | list[str] = DATE, rebuild: bool = False, lines: bool = False
) -> None:
    """Replace the partitions present in ``df`` and leave the others, or with ``rebuild`` the whole store.

    A rebuild must not read the store it replaces.  ``lines`` is that of :func:`rebalanced`."""
    by = [partition] if isinstance(partition, str) else list(partition)
    (
        rebalanced(df, by, lines)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if rebuild else "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Replace a dataset without partitions."""
    df.write.mode("overwrite").parquet(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Store an intermediate result and continue from the stored copy: it is computed once, later readers prune its
    columns, and a lost executor costs a re-read instead of a re-computation."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def write_csv_snapshots(df: DataFrame, path: str, partition: str = DATE) -> None:
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(partition)
        .csv(path)
    )


def append_run(summary: DataFrame, path: str, executed_at: Column | None = None) -> None:
    """Add the summary rows of one run, stamped with its time."""
    at = F.current_timestamp() if executed_at is None else executed_at
    summary.withColumn("batch_execution_date", at).write.mode("append").parquet(path)


def write_documents(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Nested rows as one JSON object per line; with a partition column, only the partitions present are replaced."""
    writer = df.write.mode("overwrite")
    if partition is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.json(path)
