"""Monitoring of stored predictions.

``rollup`` reads predictions once and leaves a row of counts and moments per snapshot date and hash prefix; it can be
stored and appended snapshot by snapshot.  Profile, trend, stability, concentration, confidence, the monitored period and
the drift halves all follow from that small table.  Only quantiles and the rows of the one prefix where the drift halves
meet need the predictions again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed
from creditloom.functions.measures import oot_explanation, oot_rating, positive_class, share, stable_round
from creditloom.operators import order_stats

P, CLASS, DATE = "prediction_probability", "prediction_class", "snapshot_date"


def reconcile(df: DataFrame) -> DataFrame:
    """One layout for old and new prediction files: probability and class under their current names.

    Where both layouts were merged into one table, each row takes whichever name it came with.
    """
    if "model_predictions" not in df.columns:
        return df
    if P not in df.columns:
        return df.withColumnRenamed("model_predictions", P).withColumn(CLASS, positive_class(F.col(P)))
    old = F.col("model_predictions")
    classes = positive_class(old) if CLASS not in df.columns else F.coalesce(F.col(CLASS), positive_class(old))
    return df.withColumns({P: F.coalesce(F.col(P), old), CLASS: classes}).drop("model_predictions")


# Bands of the probability: concentration and confidence shares.
def bands() -> dict[str, Column]:
    p = F.col(P)
    return {
        "below_0_1": p < 0.1,
        "between_0_1_0_5": (p >= 0.1) & (p < 0.5),
        "above_0_5": p >= 0.5,
        "high_confidence": (p < 0.2) | (p > 0.8),
        "medium_confidence": (p >= 0.2) & (p <= 0.8),
    }


def _moments() -> list[Column]:
    p = F.col(P)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(p).alias("scored"),
        F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"),
        F.sum(CLASS).alias("positives"),
        *[F.count_if(c).alias(name) for name, c in bands().items()],
    ]


def daily_profile(predictions: DataFrame) -> DataFrame:
    """One row per snapshot date: rows, mean, deviation, positives and rows per band."""
    return predictions.groupBy(DATE).agg(*_moments())


def rollup(
    predictions: DataFrame, keys: Sequence[str] = ("Customer_ID", P), digits: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row per snapshot date and hash prefix (per ``by``), with the figures of the profile.

    Prefixes have ``digits`` places, by default as many as leave about ``order_stats.ROWS_PER_PREFIX`` rows to each.
    Snapshots do not share rows, so a new one is appended by itself, whatever the digits of the others."""
    digits = order_stats.hash_digits(predictions.count()) if digits is None else digits
    prefix = F.substring(order_stats.row_hash(*keys), 1, digits)
    return predictions.groupBy(*by, DATE, prefix.alias("prefix")).agg(*_moments())


def profile_of(rolled: DataFrame) -> DataFrame:
    """The daily profile from a rollup; deviations are pooled (within plus between prefixes)."""
    same_date = Window.partitionBy(DATE)
    total = F.sum("scored").over(same_date)
    centred = rolled.withColumn("grand", F.try_divide(F.sum(F.col("mean") * F.col("scored")).over(same_date), total))
    within = F.coalesce(F.col("std"), F.lit(0.0)) ** 2 * (F.col("scored") - 1)
    between = F.col("scored") * (F.col("mean") - F.col("grand")) ** 2
    sums = centred.groupBy(DATE).agg(
        F.sum("n").alias("n"),
        F.sum("scored").alias("scored"),
        F.max("grand").alias("mean"),
        F.sum(F.when(F.col("scored") > 0, within + between)).alias("squares"),
        F.sum("positives").alias("positives"),
        *[F.sum(name).alias(name) for name in bands()],
    )
    std = F.when(F.col("scored") > 1, F.sqrt(F.col("squares") / (F.col("scored") - 1)))
    return sums.select(DATE, "n", "scored", "mean", std.alias("std"), "positives", *bands())


def performance_trend(profile: DataFrame) -> DataFrame:
    return profile.select(
        DATE,
        stable_round(F.col("mean")).alias("avg_probability"),
        stable_round(F.col("std")).alias("std_probability"),
        F.col("scored").alias("prediction_count"),
        stable_round(F.try_divide("positives", "n")).alias("positive_rate"),
    )


def overall(profile: DataFrame) -> DataFrame:
    """The profile rolled up to one row.  Deviations are pooled from the daily ones (within plus between dates),
    which stays accurate where sums of squares would cancel."""
    # The whole window holds one row per date.
    everything = Window.partitionBy()
    total = F.sum("scored").over(everything)
    centred = profile.withColumn("grand", F.try_divide(F.sum(F.col("mean") * F.col("scored")).over(everything), total))
    spread = F.coalesce(F.col("std"), F.lit(0.0)) ** 2 * (F.col("scored") - 1)
    between = F.col("scored") * (F.col("mean") - F.col("grand")) ** 2
    sums = centred.agg(
        F.sum("n").alias("n"),
        F.sum("scored").alias("scored"),
        F.sum("positives").alias("positives"),
        F.max("grand").alias("mean"),
        F.sum(F.when(F.col("scored") > 0, spread + between)).alias("squares"),
        F.stddev_samp("mean").alias("std_of_daily_means"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        *[F.sum(name).alias(name) for name in bands()],
    )
    std = F.when(F.col("scored") > 1, F.sqrt(F.col("squares") / (F.col("scored") - 1)))
    return sums.withColumn("std", std).withColumn("cv", F.try_divide("std", "mean"))


def stability_metrics(rolled: DataFrame) -> DataFrame:
    """Overall mean, deviation, positive rate and coefficient of variation; stable below the fixed limit, unstable where
    the coefficient is undefined."""
    return rolled.select(
        stable_round(F.col("mean")).alias("overall_mean"),
        stable_round(F.col("std")).alias("overall_std"),
        F.col("n").alias("prediction_count"),
        stable_round(F.try_divide("positives", "n")).alias("positive_prediction_rate"),
        stable_round(F.col("cv")).alias("coefficient_of_variation"),
    ).withColumn("is_stable", is_stable(F.col("coefficient_of_variation")))


def is_stable(cv: Column) -> Column:
    return F.coalesce(cv < fixed.STABLE_BELOW_CV, F.lit(False))


def prediction_concentration(rolled: DataFrame) -> DataFrame:
    shares = [F.try_divide(b, "n").alias(b) for b in ("below_0_1", "between_0_1_0_5", "above_0_5")]
    return rolled.select(stable_round(F.col("cv")).alias("overall_coefficient_of_variation"), *shares)


def confidence_metrics(rolled: DataFrame) -> DataFrame:
    """Shares of confident scores, and how level the daily means are (NULL for a single date)."""
    return rolled.select(
        stable_round(F.try_divide("high_confidence", "n")).alias("high_confidence_predictions"),
        stable_round(F.try_divide("medium_confidence", "n")).alias("medium_confidence_predictions"),
        stable_round(1 / (1 + F.col("std_of_daily_means"))).alias("temporal_consistency"),
        stable_round(F.col("mean")).alias("average_prediction_confidence"),
        stable_round(F.col("std")).alias("confidence_std"),
    )


def monitoring_period(rolled: DataFrame) -> DataFrame:
    period = F.concat_ws(" to ", F.col("first_date").cast("string"), F.col("last_date").cast("string"))
    return rolled.select(period.alias("monitoring_period"), F.col("n").alias("total_predictions_analyzed"))


def distribution_by_period(predictions: DataFrame, approximate: bool = False) -> DataFrame:
    """Count, mean, deviation, range and quartiles per date.

    Quartiles are exact with interpolation by default.  ``approximate`` trades that for a single pass.
    """
    # The same filter on every branch keeps their exchanges interchangeable.
    predictions = predictions.filter(F.col(DATE).isNotNull())
    p, quartiles = F.col(P), {"q25": 0.25, "median": 0.5, "q75": 0.75}
    moments = [
        F.count(p).alias("count"),
        F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
    ]
    if approximate:
        sketches = [F.percentile_approx(p, q, 10_000).alias(name) for name, q in quartiles.items()]
        full = predictions.groupBy(DATE).agg(*moments, *sketches)
    else:
        ranks = order_stats.exact_quantiles(predictions, P, quartiles, by=[DATE])
        full = predictions.groupBy(DATE).agg(*moments).join(ranks, DATE, "left")
    rounded = {c: stable_round(F.col(c)) for c in ("mean", "std", "min", "max", *quartiles)}
    return full.withColumns(rounded)


def run_statistics(predictions: DataFrame) -> DataFrame:
    """Statistics of one scoring run; the deviation is the population's."""
    p = F.col(P)
    return predictions.agg(
        F.count(p).alias("count"),
        F.avg(p).alias("mean"),
        F.stddev_pop(p).alias("std"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
        share(p > 0.5).alias("positive_rate"),
    )


def confidence_histogram(predictions: DataFrame, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin over [0, 1]; bin 0 and bin ``bins`` + 1 hold what lies outside."""
    bin_ = F.width_bucket(F.col(P), F.lit(0.0), F.lit(1.0), F.lit(bins))
    return predictions.filter(F.col(P).isNotNull()).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("predictions"))


# --- drift ------------------------------------------------------------------------------------------------------


def _running(df: DataFrame, *order: str) -> DataFrame:
    """Add ``start``: rows (column ``n``) in the entries before this one."""
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("start", F.coalesce(F.sum("n").over(window), F.lit(0)))


def _struct_of(df: DataFrame) -> Column:
    """The only row of ``df`` as a scalar subquery; NULL when there is none."""
    return df.select(F.struct("*")).scalar()


def drift(
    predictions: DataFrame,
    keys: Sequence[str] = ("Customer_ID", P),
    threshold: float = fixed.DRIFT_THRESHOLD,
    rolled: DataFrame | None = None,
    digits: int | None = None,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Mean and deviation of the older half of the rows against the newer half.

    Rows are ordered by date; rows of the date in the middle by a hash of ``keys`` (then by probability), which
    settles ties the same way on every run.  Keys should tell rows apart; the default adds the probability, so one
    busy customer still spreads out.  The older half has floor(n / 2) rows.

    No sort over all rows is needed.  The rollup shows which date the middle falls into and, within that date, which hash
    prefix; and only the rows of that prefix are read and ordered.  Equal rows travel as one row with a count, so repeated
    rows cannot swell the part.  Pass a stored ``rolled`` (over the same ``keys``), and the predictions are read once;
    else it is computed, and ``stage(df, name)`` may store it.
    """
    rolled = stage(rollup(predictions, keys, digits), "rollup") if rolled is None else rolled
    p, n, start, half = F.col("p"), F.col("n"), F.col("start"), F.col("half")
    # First and second moments are sums around a constant near the middle of the scale; any constant would do.
    off = p - 0.5
    mean, std = F.col("mean") - 0.5, F.coalesce(F.col("std"), F.lit(0.0))

    sums = ["n", "s1", "s2"]

    def summed(df: DataFrame, name: str) -> DataFrame:
        return _running(
            df.filter("scored > 0").select(
                name, F.col("scored").alias("n"), (F.col("scored") * mean).alias("s1"),
                ((F.col("scored") - 1) * std * std + F.col("scored") * mean * mean).alias("s2"),
            ),
            name,
        )

    dates = summed(profile_of(rolled), DATE).withColumn("half", F.floor(F.sum("n").over(Window.partitionBy()) / 2))
    divided = (start < half) & (start + n > half)

    def sides(df: DataFrame) -> DataFrame:
        """Entries that lie on one side as a whole."""
        return df.filter(~divided).select((start < half).alias("early"), *sums)

    # The date in the middle, by hash prefix.
    middle = _struct_of(dates.filter(divided).select(DATE, "start", "half"))
    parts = summed(rolled.filter(F.col(DATE) == middle[DATE]), "prefix").withColumn("half", middle["half"] - middle["start"])

    # The part in the middle, row by row: copies before the middle are early, the others recent.
    cut = _struct_of(parts.filter(divided).select("prefix", "start", "half"))
    rows = predictions.filter(F.col(P).isNotNull() & (F.col(DATE) == middle[DATE])).select(
        F.col(P).alias("p"), order_stats.row_hash(*keys).alias("hash")
    )
    ordered = _running(
        rows.filter(F.startswith("hash", cut["prefix"])).groupBy("hash", "p").agg(F.count(F.lit(1)).alias("n")), "hash", "p"
    ).withColumn("early_n", F.greatest(F.lit(0), F.least(n, cut["half"] - cut["start"] - start)))
    copies = [
        F.struct(F.lit(True).alias("early"), F.col("early_n").alias("n")),
        F.struct(F.lit(False).alias("early"), (n - F.col("early_n")).alias("n")),
    ]
    dealt = ordered.select("p", F.explode(F.array(*copies)).alias("side")).select(
        "side.early", "side.n", (off * F.col("side.n")).alias("s1"), (off * off * F.col("side.n")).alias("s2")
    )

    def total(column: str, early: bool) -> Column:
        return F.sum(F.when(F.col("early") == early, F.col(column)))

    halves = sides(dates).unionByName(sides(parts)).unionByName(dealt).agg(
        *[
            total(c, side).alias(f"{name}_{c}")
            for name, side in (("early", True), ("recent", False))
            for c in sums
        ]
    )

    def mean_of(name: str) -> Column:
        return F.try_divide(F.col(f"{name}_s1"), F.col(f"{name}_n")) + 0.5

    def std_of(name: str) -> Column:
        count, s1, s2 = (F.col(f"{name}_{c}") for c in sums)
        return F.sqrt(F.greatest(F.lit(0.0), F.try_divide(s2 - F.try_divide(s1 * s1, count), count - 1)))

    mean_diff = F.abs(mean_of("recent") - mean_of("early"))
    std_diff = F.abs(std_of("recent") - std_of("early"))
    drifted = F.coalesce(mean_diff > threshold, F.lit(False)) | F.coalesce(std_diff > threshold, F.lit(False))
    return halves.select(
        drifted.alias("drift_detected"),
        stable_round(mean_diff).alias("mean_difference"),
        stable_round(std_diff).alias("std_difference"),
        F.lit(threshold).alias("drift_threshold"),
        stable_round(mean_of("early")).alias("early_mean"),
        stable_round(std_of("early")).alias("early_std"),
        stable_round(mean_of("recent")).alias("recent_mean"),
        stable_round(std_of("recent")).alias("recent_std"),
    )


# --- discrimination over periods --------------------------------------------------------------------------------


def oot_stability(period_aucs: DataFrame, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """How evenly a model performs over its out-of-time periods: mean, population deviation, coefficient of
    variation, range and rating."""
    auc = F.col("auc")
    span = F.format_string("%.4f - %.4f", F.col("lowest"), F.col("highest"))
    return (
        period_aucs.filter(auc.isNotNull())
        .groupBy(*by)
        .agg(
            F.count(auc).alias("periods"),
            F.avg(auc).alias("average_score"),
            F.stddev_pop(auc).alias("std_deviation"),
            F.min(auc).alias("lowest"),
            F.max(auc).alias("highest"),
        )
        .withColumn("coefficient_of_variation", F.try_divide("std_deviation", "average_score"))
        .withColumn("score_range", span)
        .withColumn("score_spread", F.col("highest") - F.col("lowest"))
        .withColumn("stability_rating", oot_rating(F.col("coefficient_of_variation")))
        .withColumn("stability_explanation", oot_explanation(F.col("stability_rating")))
        .drop("lowest", "highest")
    )


def threshold_incidents(
    periods: DataFrame,
    performance: float = fixed.PERFORMANCE_THRESHOLD,
    critical: float = fixed.CRITICAL_AUC,
    drift_limit: float = fixed.DRIFT_THRESHOLD,
) -> DataFrame:
    """Number of periods below the AUC limits or above the drift limit."""
    return periods.agg(
        F.count(F.lit(1)).alias("periods"),
        F.count_if(F.col("auc") < performance).alias("below_performance"),
        F.count_if(F.col("auc") < critical).alias("below_critical"),
        F.count_if(F.col("drift_score") > drift_limit).alias("drift_incidents"),
        F.avg("auc").alias("average_auc"),
        F.avg("drift_score").alias("average_drift"),
    )


def drift_by_period(profile: DataFrame) -> DataFrame:
    """Drift score per date: change of the daily mean against the date before (one row per date)."""
    previous = F.lag("mean").over(Window.orderBy(DATE))
    return profile.select(DATE, F.abs(F.col("mean") - previous).alias("drift_score"))
