"""Snapshot scans and catalogue queries.  Dates are DATE literals, so partitioned stores prune by directory."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(date: str | Column) -> Column:
    return F.lit(date).cast("date") if isinstance(date, str) else date


def snapshot(df: DataFrame, date: str | Column, column: str = "snapshot_date") -> DataFrame:
    return df.filter(F.col(column) == day(date))


def snapshot_range(df: DataFrame, start: str | Column, end: str | Column, column: str = "snapshot_date") -> DataFrame:
    return df.filter(F.col(column).between(day(start), day(end)))


def snapshots_until(df: DataFrame, date: str | Column, column: str = "snapshot_date") -> DataFrame:
    """What was known at ``date``."""
    return df.filter(F.col(column) <= day(date))


def snapshot_dates(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    return df.select(column).distinct()


def union_slices(slices: Sequence[DataFrame]) -> DataFrame:
    """All rows of all slices, columns matched by name; a column some slices lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slices)


def row_audit(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))

