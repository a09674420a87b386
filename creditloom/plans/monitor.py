"""Monitoring run: prediction store to one monitoring row and its governance document."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed
from creditloom.operators import governance, monitoring


def run_metrics(
    predictions: DataFrame,
    run_date: Column,
    model_version: str,
    oot: DataFrame | None = None,
    keys: Sequence[str] = ("Customer_ID", monitoring.P),
    threshold: float = fixed.DRIFT_THRESHOLD,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    rolled: DataFrame | None = None,
) -> DataFrame:
    """All measures of one run in one row; no row when there are no predictions.

    ``oot`` is the one-row stability of the model's out-of-time periods.  ``rolled`` is the stored rollup of the
    predictions over ``keys``; with it the predictions are read once, for the rows where the drift halves meet.  Without
    it the rollup is computed, and ``stage(df, name)`` may store it: two reads then, more without.
    """
    if rolled is None:
        rolled = stage(monitoring.rollup(predictions, keys), "rollup")
    whole = monitoring.overall(monitoring.profile_of(rolled))
    drifted = monitoring.drift(predictions, keys, threshold, rolled)
    row = whole.filter("n > 0").withColumn("d", drifted.select(F.struct("*")).scalar())
    if oot is None:
        row = row.withColumns({"oot_rating": F.lit(None).cast("string"), "oot_cv": F.lit(None).cast("double")})
    else:
        pair = oot.select(F.struct("stability_rating", "coefficient_of_variation")).scalar()
        row = row.withColumn("o", pair).withColumns(
            {"oot_rating": F.col("o.stability_rating"), "oot_cv": F.col("o.coefficient_of_variation")}
        )
    four = monitoring.stable_round
    return row.select(
        run_date.alias("snapshot_date"),
        F.lit(model_version).alias("model_version"),
        F.col("d.drift_detected").alias("drift_detected"),
        F.col("d.mean_difference").alias("mean_difference"),
        monitoring.is_stable(four(F.col("cv"))).alias("is_stable"),
        F.col("n").alias("prediction_count"),
        four(F.try_divide("positives", "n")).alias("positive_rate"),
        four(F.col("cv")).alias("coefficient_of_variation"),
        four(F.col("mean")).alias("avg_confidence"),
        four(1 / (1 + F.col("std_of_daily_means"))).alias("temporal_consistency"),
        "oot_rating",
        "oot_cv",
    )


def monitoring_row(ruled: DataFrame, monitored_at: Column | None = None) -> DataFrame:
    """The stored monitoring row; unset advice reads ``N/A``, measures that one date or one prediction cannot have are
    NULL."""

    def text(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name), F.lit("N/A")).alias(alias)

    columns = [
        "snapshot_date",
        F.coalesce("drift_detected", F.lit(False)).alias("drift_detected"),
        F.coalesce("mean_difference", F.lit(0.0)).alias("mean_difference"),
        F.col("is_stable").alias("model_stable"),
        "prediction_count",
        F.coalesce("positive_rate", F.lit(0.0)).alias("positive_rate"),
        F.array_join("recommendations", " | ").alias("recommendations"),
        text("retrain_urgency", "retrain_urgency"),
        text("retrain_timeline", "retrain_timeline"),
        text("action", "required_action"),
        text("investigation", "investigation_needed"),
        text("strategy", "deployment_strategy"),
        text("rollback_plan", "rollback_plan"),
        F.lit(str(fixed.GOVERNANCE_BLOCKS["refresh_triggers"])).alias("refresh_triggers"),
        "model_version",
        F.coalesce("avg_confidence", F.lit(0.0)).alias("avg_confidence"),
        "temporal_consistency",
        "coefficient_of_variation",
    ]
    if monitored_at is not None:
        columns.insert(0, monitored_at.alias("monitoring_date"))
    return ruled.select(*columns)


def monitor(predictions: DataFrame, run_date: Column, model_version: str, **options) -> tuple[DataFrame, DataFrame]:
    """Monitoring row and governance document of one run, both lazy."""
    ruled = governance.apply_rules(run_metrics(predictions, run_date, model_version, **options))
    return monitoring_row(ruled, F.current_timestamp()), governance.governance_document(ruled)
