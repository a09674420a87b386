"""Scoring one or many snapshots in a single job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.measures import oot_rating, positive_class

REQUIRED_REGISTRY_FIELDS = ("model_version", "feature_columns", "hyper_parameters", "splits")


def with_probability(model: PipelineModel, features: DataFrame, name: str = "model_predictions") -> DataFrame:
    """Probability of the positive class; every other column is kept."""
    before = features.columns
    scored = model.transform(features)
    return scored.select(*before, vector_to_array("probability")[1].alias(name))


INTERCEPT = "(intercept)"


def coefficient_table(model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Weights (feature, weight) of a logistic model over numeric columns, on the columns' own scale, with the intercept.

    Standardisation is folded in; a column without variation has no weight."""
    *_, scaler, fitted = model.stages
    weights = [float(w / s) if s else 0.0 for w, s in zip(fitted.coefficients, scaler.std)]
    shift = float(fitted.intercept) - sum(w * float(m) for w, m in zip(weights, scaler.mean))
    rows = [*zip(columns, weights), (INTERCEPT, shift)]
    return SparkSession.active().createDataFrame(rows, "feature string, weight double")


def with_linear_score(features: DataFrame, coefficients: DataFrame, columns: Sequence[str], name: str = "model_predictions") -> DataFrame:
    """Probability from a table of weights: a missing value counts as 0, a feature without a weight not at all.  The table
    has a row per feature and enters as a scalar subquery, so rows are scored in one pass without a model object."""
    weights = coefficients.agg(F.map_from_entries(F.collect_list(F.struct("feature", "weight")))).scalar()
    total = F.coalesce(F.col("__weights")[INTERCEPT], F.lit(0.0))
    for c in columns:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.coalesce(F.col("__weights")[c], F.lit(0.0))
    return features.withColumn("__weights", weights).withColumn(name, 1 / (1 + F.exp(-total))).drop("__weights")


def score(
    model: PipelineModel,
    features: DataFrame,
    model_name: str,
    model_version: str | None = None,
    date: str = "feature_snapshot_date",
    keep: Sequence[str] = ("Customer_ID",),
) -> DataFrame:
    """Prediction rows.  Scaling and encoding belong to the model, so nothing else has to be applied here."""
    scored = with_probability(model, features)
    columns = [
        *keep,
        F.col(date).alias("feature_snapshot_date"),
        F.col(date).alias("snapshot_date"),
        F.lit(model_name).alias("model_name"),
        "model_predictions",
        positive_class(F.col("model_predictions")).alias("prediction_class"),
    ]
    if model_version is not None:
        columns.append(F.lit(model_version).alias("model_version"))
    return scored.select(*columns)


def score_snapshot(
    model: PipelineModel, features: DataFrame, snapshot: Column, model_name: str, date: str = "feature_snapshot_date", **kw
) -> DataFrame:
    """Score one date; a date without features is an error."""
    rows = features.filter(F.col(date) == snapshot)
    if rows.isEmpty():
        raise ValueError("no feature data found for the snapshot date")
    return score(model, rows, model_name, date=date, **kw)


def batch_inference(
    model: PipelineModel, features: DataFrame, calendar: DataFrame, model_name: str, date: str = "feature_snapshot_date", **kw
) -> DataFrame:
    """Score every date of the calendar in one pass.

    The calendar holds one date per row; Spark broadcasts it as long as its size allows.
    """
    dates = calendar.select(F.col(calendar.columns[0]).alias(date)).distinct()
    return score(model, features.join(dates, date, "left_semi"), model_name, date=date, **kw)


def batch_summary(calendar: DataFrame, predictions: DataFrame, cut: float = 0.5) -> DataFrame:
    """One row per calendar date: predictions, positives, average and status; dates without predictions failed.

    Predictions shrink to one row per date before they meet the calendar.
    """
    p = F.col("model_predictions")
    per_date = predictions.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(p > cut).alias("hits"), F.avg(p).alias("mean")
    )
    empty = F.concat(F.lit("FAILED: No feature data found for date "), F.col("snapshot_date").cast("string"), F.lit(" 00:00:00"))
    return calendar.join(per_date, "snapshot_date", "left").select(
        "snapshot_date",
        F.coalesce("n", F.lit(0)).alias("prediction_count"),
        F.coalesce("hits", F.lit(0)).alias("positive_predictions"),
        F.coalesce("mean", F.lit(0.0)).alias("avg_probability"),
        F.when(F.col("n") > 0, "SUCCESS").otherwise(empty).alias("status"),
    )


def with_run(summary: DataFrame, start: Column, end: Column, frequency: str) -> DataFrame:
    return summary.withColumns(
        {"batch_start_date": start, "batch_end_date": end, "frequency": F.lit(frequency)}
    )


def batch_rollup(summary: DataFrame) -> DataFrame:
    """Totals of a batch over its successful dates."""
    ok = F.col("status") == "SUCCESS"
    n = F.col("prediction_count")
    total = F.sum(F.when(ok, n))
    period = F.concat_ws(" to ", F.min("snapshot_date").cast("string"), F.max("snapshot_date").cast("string"))
    return summary.agg(
        period.alias("inference_period"),
        F.count(F.lit(1)).alias("total_prediction_periods"),
        total.alias("total_predictions_generated"),
        F.try_divide(F.sum(F.when(ok, F.col("positive_predictions"))), total).alias("overall_positive_rate"),
        F.try_divide(F.sum(F.when(ok, F.col("avg_probability") * n)), total).alias("average_probability"),
        F.count_if(ok).alias("successful_runs"),
        F.count_if(~ok).alias("failed_runs"),
    )


def success_rate(summary: DataFrame, by: Sequence[str] = (), target: float = 95) -> DataFrame:
    """Successful and failed dates, predictions made, and the rate in percent against its target."""
    ok = F.col("status") == "SUCCESS"
    return (
        summary.groupBy(*by)
        .agg(
            F.count_if(ok).alias("successful"),
            F.count_if(~ok).alias("failed"),
            F.sum("prediction_count").alias("predictions"),
            (F.avg(ok.cast("double")) * 100).alias("success_rate"),
        )
        .withColumn("on_target", F.col("success_rate") >= target)
    )


def validate_registry(registry: DataFrame) -> DataFrame:
    """Check a model registry: the required fields, at least one feature, and the rating of its out-of-time spread.

    Absent fields are an error; a row that lacks features is reported as not usable.
    """
    absent = [c for c in REQUIRED_REGISTRY_FIELDS if c not in registry.columns]
    if absent:
        raise ValueError(f"registry lacks {absent}")
    features = F.coalesce(F.size("feature_columns"), F.lit(0))
    cv = F.col("oot_cv") if "oot_cv" in registry.columns else F.lit(None).cast("double")
    return registry.withColumns(
        {"feature_count": features, "usable": features > 0, "oot_stability": F.coalesce(oot_rating(cv), F.lit("UNKNOWN"))}
    )
