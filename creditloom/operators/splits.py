"""Time and hash splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.calendar import training_windows
from creditloom.operators.order_stats import BOUNDARIES, PLACE, below, hash_fraction, with_boundaries


def time_split(df: DataFrame, train_date: Column, date: str = "snapshot_date", **windows: int) -> DataFrame:
    """Keep the rows of the two windows before ``train_date`` and name their split: ``train_test`` or ``oot``."""
    at, w = F.col(date), training_windows(train_date, **windows)
    split = F.when(at.between(w["oot_start"], w["oot_end"]), "oot").when(
        at.between(w["train_start"], w["train_end"]), "train_test"
    )
    return df.filter(at.between(w["train_start"], w["oot_end"])).withColumn("split", split).filter("split IS NOT NULL")


def hash_split(df: DataFrame, keys: Sequence[str], train_ratio: float = 0.8) -> DataFrame:
    """Repeatable random split: a row's side depends only on its key, never on partitioning or other rows."""
    return df.withColumn("split", F.when(hash_fraction(*keys) < train_ratio, "train").otherwise("test"))


def stratified_split(df: DataFrame, keys: Sequence[str], label: str = "label", train_ratio: float = 0.8) -> DataFrame:
    """Repeatable random split that gives every label the same share, up to one row."""
    first_test = F.round(F.col("group_rows") * train_ratio)
    cut = with_boundaries(df, keys, [first_test], [label])
    return cut.withColumn("split", F.when(below(0), "train").otherwise("test")).drop(PLACE, BOUNDARIES)


def equal_parts(df: DataFrame, keys: Sequence[str], parts: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Cut into ``parts`` equal slices of a shuffled order, numbered from 1; the remainder is left out."""
    size = F.floor(F.col("group_rows") / parts)
    cut = with_boundaries(df, keys, [size * (k + 1) for k in range(parts)], by)
    part = F.lit(None).cast("int")
    for k in reversed(range(parts)):
        part = F.when(below(k), k + 1).otherwise(part)
    return cut.withColumn("part", part).filter("part IS NOT NULL").drop(PLACE, BOUNDARIES)
