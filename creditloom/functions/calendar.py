"""Month calendars and training windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = {"daily": "INTERVAL 1 DAY", "weekly": "INTERVAL 7 DAYS", "monthly": "INTERVAL 1 MONTH"}


def dates_between(start: Column, end: Column, frequency: str = "monthly") -> Column:
    """List of dates from ``start`` to ``end``, both included.  Monthly lists count from the start date, so a start
    on the 31st returns to the 31st after short months."""
    if frequency not in STEPS:
        raise ValueError(f"unknown frequency: {frequency}")
    return F.when(start <= end, F.sequence(start, end, F.expr(STEPS[frequency]))).otherwise(
        F.array().cast("array<date>")
    )


def month_starts(start: Column, end: Column) -> Column:
    """First-of-month dates from the month of ``start`` up to ``end``."""
    return dates_between(F.trunc(start, "MM"), end, "monthly")


def calendar(bounds: DataFrame, start: str, end: str, frequency: str = "monthly", name: str = "snapshot_date") -> DataFrame:
    """One row per date for every row of ``bounds`` (usually the single row of an aggregate)."""
    return bounds.select(F.explode(dates_between(F.col(start), F.col(end), frequency)).alias(name))


def batch_end(start: Column, months: int = 3) -> Column:
    """Default last date of a batch run."""
    return F.add_months(start, months)


def months_since(date: Column, epoch: dt.date = dt.date(2023, 1, 1)) -> Column:
    """Whole calendar months from the epoch's month."""
    return (F.year(date) - epoch.year) * 12 + (F.month(date) - epoch.month)


def training_windows(train_date: Column, history_months: int = 12, oot_months: int = 2) -> dict[str, Column]:
    """Bounds, all inclusive: the out-of-time window ends the day before training, the train/test window the day
    before that window starts."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "train_start": F.add_months(oot_start, -history_months),
        "train_end": F.date_sub(oot_start, 1),
        "oot_start": oot_start,
        "oot_end": F.date_sub(train_date, 1),
    }
