"""Feature/label joins.

All of them are equi-joins whose strategy Spark picks from measured sizes.  A hot customer is split at run time by
the adaptive skew join, which ``session.tune`` keeps on for every join here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUSTOMER, LOAN = "Customer_ID", "loan_id"
#: Rows of a key above which a left join deals them out.
HOT_ROWS = 1_000_000


def offset_join(features: DataFrame, labels: DataFrame, months: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """Features of date d with the customer's labels of date d + ``months``: one join, no loop over dates.

    Dates are shifted with month-end clamping.  Feature rows without a later label and labels without an earlier
    feature row drop out; repeated keys multiply, as in a join per date.  Features that know their loan meet the labels of
    that loan only.  ``carry`` names further label columns to keep.
    """
    shifted = features.withColumnRenamed("snapshot_date", "feature_snapshot_date").withColumn(
        "label_snapshot_date", F.add_months("feature_snapshot_date", months)
    )
    keys = [CUSTOMER, *[c for c in (LOAN,) if c in features.columns and c in labels.columns]]
    outcome = labels.select(
        *keys, F.col("snapshot_date").alias("label_snapshot_date"), "label", *[c for c in carry if c not in keys]
    )
    return shifted.join(outcome, [*keys, "label_snapshot_date"], "inner")


def training_set(features: DataFrame, labels: DataFrame, as_of: Column, months: int = 3) -> DataFrame:
    """``offset_join`` of what was known at ``as_of``; the feature date column is ``feature_snapshot_date``."""
    known_features = features.filter(F.col("feature_snapshot_date") <= as_of)
    known_labels = labels.filter(F.col("snapshot_date") <= as_of)
    return offset_join(known_features.withColumnRenamed("feature_snapshot_date", "snapshot_date"), known_labels, months)


def customer_labels(features: DataFrame, labels: DataFrame, date: Column) -> DataFrame:
    """Features of one date with every label the customer ever had.  This lets later outcomes in; it exists for
    results that were produced that way, ``offset_join`` is the sound form."""
    return features.filter(F.col("feature_snapshot_date") == date).join(labels, CUSTOMER, "inner")


def heavy_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys that hold more than ``hot_rows`` rows and a thousandth of all, with their rows; None if there is none.

    A sketch of key hashes finds the candidates in one pass without a shuffle; only their rows are counted.  A thousandth
    of all rows bounds the result to a thousand keys.
    """
    spark, on = df.sparkSession, list(on)
    keyed = df.dropna(subset=on).select(*on, F.xxhash64(*on).alias("__hash"))
    top = keyed.agg(F.count(F.lit(1)).alias("rows"), F.expr("approx_top_k(__hash, 1000, 20000)").alias("top")).first()
    least = max(hot_rows, top["rows"] // 1000)
    hashes = [t["item"] for t in top["top"] or [] if t["count"] > least]  # counts of a sketch are never too small
    if not hashes:
        return None
    counted = keyed.filter(F.col("__hash").isin(hashes)).groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    found = counted.filter(F.col("rows") > least).collect()
    return spark.createDataFrame(found, counted.schema) if found else None


def labels_with_features(
    labels: DataFrame,
    features: DataFrame,
    on: Sequence[str] = (CUSTOMER, "snapshot_date"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join that keeps labels without features.

    A left join splits a hot key on its left side only.  Keys with very many feature rows are therefore dealt out: their
    feature rows get a number below the key's deals, their labels one copy per number.  Such a label has features, so
    copies that met none are dropped.  All other keys join as they are, and either input is read once; finding the heavy
    keys reads the key columns of ``features`` beforehand.
    """
    on = list(on)
    heavy = heavy_keys(features, on, hot_rows)
    columns = [*labels.columns, *[c for c in features.columns if c not in on]]
    if heavy is None:
        return labels.join(features, on, "left").select(*columns)
    deals = heavy.select(*on, F.ceil(F.col("rows") / hot_rows).cast("int").alias("__deals"))
    dealt = (
        features.join(F.broadcast(deals), on, "left")
        .withColumn("__deal", F.coalesce((F.monotonically_increasing_id() % F.col("__deals")).cast("int"), F.lit(0)))
        .drop("__deals")
        .withColumn("__met", F.lit(True))
    )
    copies = labels.join(F.broadcast(deals), on, "left").withColumn(
        "__deal", F.explode(F.sequence(F.lit(0), F.coalesce("__deals", F.lit(1)) - 1))
    )
    joined = copies.join(dealt, [*on, "__deal"], "left")
    return joined.filter("__deals IS NULL OR __met").select(*columns)


def slice_coverage(features: DataFrame, labels: DataFrame, months: int = 3) -> DataFrame:
    """Per feature date: rows, and whether a label snapshot exists ``months`` later.  Both sides are reduced to one
    row per date before they meet."""
    dates = features.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("feature_rows"))
    label_dates = labels.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("label_rows"))
    return (
        dates.withColumn("label_snapshot_date", F.add_months("snapshot_date", months))
        .join(label_dates.withColumnRenamed("snapshot_date", "label_snapshot_date"), "label_snapshot_date", "left")
        .select(
            "snapshot_date",
            "label_snapshot_date",
            "feature_rows",
            F.coalesce("label_rows", F.lit(0)).alias("label_rows"),
            F.col("label_rows").isNotNull().alias("covered"),
        )
    )


def repeated_slices(sources: Mapping[str, DataFrame], keys: Sequence[str] = (CUSTOMER, "snapshot_date")) -> DataFrame:
    """Slices that a source holds more than once, with their rows: such a slice multiplies in a join of the sources."""
    parts = [repeated_keys(df, *keys).select(F.lit(name).alias("source"), *keys, "rows") for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row; these multiply in the joins above."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
