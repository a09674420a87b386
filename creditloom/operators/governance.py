"""Governance rules over monitoring rows, and retraining decisions over the model registry."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed
from creditloom.functions.calendar import months_since
from creditloom.functions.measures import model_file_date, oot_explanation

EPOCH = dt.date(2023, 1, 1)


@dataclass(frozen=True)
class Rule:
    """When the condition holds, the advice is listed and the fields are set; later rules overwrite earlier ones."""

    when: Column
    advice: str
    sets: dict[str, str] = field(default_factory=dict)


def governance_rules() -> list[Rule]:
    """The rules in their order.  Fixed values: advice texts, field values and limits."""
    drift, cv = F.col("drift_detected"), F.col("coefficient_of_variation")
    severe = F.col("mean_difference") > 0.15
    unstable = ~F.col("is_stable")
    count, positive, rating = F.col("prediction_count"), F.col("positive_rate"), F.col("oot_rating")
    return [
        Rule(
            drift & severe,
            "CRITICAL: Severe data drift detected - IMMEDIATE RETRAIN REQUIRED",
            {
                "retrain_urgency": "IMMEDIATE",
                "retrain_timeline": "24-48 hours",
                "strategy": "blue_green_deployment",
                "rollback_plan": "automated_rollback_on_performance_drop",
            },
        ),
        Rule(
            drift & ~severe,
            "HIGH: Data drift detected - Schedule retrain within 1 week",
            {
                "retrain_urgency": "HIGH",
                "retrain_timeline": "1 week",
                "strategy": "canary_deployment",
                "rollback_plan": "manual_approval_rollback",
            },
        ),
        Rule(
            rating == "POOR",
            "CRITICAL: Poor OOT stability during training - Model reliability compromised",
            {"action": "immediate_model_review", "investigation": "feature_engineering_review"},
        ),
        Rule(
            rating == "MODERATE",
            "MEDIUM: Moderate OOT stability - Monitor closely",
            {"action": "enhanced_monitoring"},
        ),
        Rule(
            rating == "EXCELLENT",
            "EXCELLENT: High OOT stability - Model is robust",
            {"action": "standard_monitoring"},
        ),
        Rule(
            unstable & (cv > 1.0),
            "CRITICAL: High prediction variability - Model stability compromised",
            {"action": "investigate_model_degradation", "monitoring": "enhanced_real_time_monitoring"},
        ),
        Rule(
            unstable & F.coalesce(cv <= 1.0, F.lit(True)),  # also where it is undefined
            "MEDIUM: Monitor model stability closely",
            {"action": "increase_monitoring_frequency"},
        ),
        Rule(
            count < 100,
            "LOW: Insufficient prediction volume for reliable monitoring",
            {"action": "increase_data_collection"},
        ),
        Rule(
            count > 10000,
            "HIGH: High prediction volume - Consider model optimization",
            {"action": "optimize_inference_pipeline"},
        ),
        Rule(
            positive > 0.8,
            "INVESTIGATE: Unusually high positive prediction rate",
            {"investigation": "data_quality_check"},
        ),
        Rule(
            positive < 0.05,
            "INVESTIGATE: Unusually low positive prediction rate",
            {"investigation": "feature_distribution_analysis"},
        ),
    ]


# What applies when no rule does.
QUIET_ADVICE = "CONTINUE: Model performance stable - Continue regular monitoring"
QUIET_SETS = {"action": "routine_monitoring", "strategy": "maintain_current_deployment"}
FIELDS = [
    "retrain_urgency",
    "retrain_timeline",
    "action",
    "investigation",
    "strategy",
    "rollback_plan",
    "monitoring",
]


def apply_rules(metrics: DataFrame) -> DataFrame:
    """Add ``recommendations`` and one column per field to every metrics row.

    Input columns: drift_detected, mean_difference, is_stable, coefficient_of_variation, prediction_count,
    positive_rate, oot_rating.  Missing metrics trigger nothing, missing stability counts as stable.
    """
    rules = governance_rules()
    advice = F.filter(F.array(*[F.when(r.when, r.advice) for r in rules]), lambda a: a.isNotNull())
    listed = metrics.withColumn("recommendations", advice)
    quiet = F.size("recommendations") == 0

    def value(name: str) -> Column:
        setters = [F.when(quiet, QUIET_SETS[name])] if name in QUIET_SETS else []
        setters += [F.when(r.when, r.sets[name]) for r in reversed(rules) if name in r.sets]
        return F.coalesce(*setters)

    listed = listed.withColumns({name: value(name) for name in FIELDS})
    return listed.withColumn(
        "recommendations", F.when(quiet, F.array(F.lit(QUIET_ADVICE))).otherwise(F.col("recommendations"))
    )


def _constant(block: dict) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in block.items()])


def governance_document(ruled: DataFrame, keep: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """The nested document per monitored row; as JSON, unset fields are left out."""
    sop = ["retrain_urgency", "retrain_timeline", "action", "investigation"]
    rating = F.coalesce(F.col("oot_rating"), F.lit("UNKNOWN"))
    assessment = F.struct(
        rating.alias("rating"),
        F.coalesce(F.col("oot_cv"), F.lit(0.0)).alias("coefficient_of_variation"),
        F.coalesce(oot_explanation(F.col("oot_rating")), F.lit("N/A")).alias("recommendation"),
    )
    return ruled.select(
        *keep,
        "recommendations",
        F.struct(*sop, *[_constant(b).alias(name) for name, b in fixed.GOVERNANCE_BLOCKS.items()]).alias(
            "governance_sop"
        ),
        F.struct("strategy", "rollback_plan", "monitoring").alias("deployment_options"),
        assessment.alias("oot_stability_assessment"),
    )


# --- retraining -------------------------------------------------------------------------------------------------


def registry_entries(registry: DataFrame) -> DataFrame:
    """Registry rows with what their file name says: date, and whether the model counts as active."""
    name = F.col("model_file")
    return registry.withColumns(
        {
            "name_date": model_file_date(name),
            "active": ~(name.endswith("_archived.pkl") | name.endswith("_retrain.pkl")),
        }
    )


def previous_model(executions: DataFrame, registry: DataFrame, date: str = "execution_date") -> DataFrame:
    """Attach to every execution date the newest active model strictly older than it.

    The registry first shrinks to one model per date, so the ordered window spans dates, however many models there
    are.
    """
    per_date = (
        registry_entries(registry)
        .filter("active AND name_date IS NOT NULL")
        .groupBy(F.col("name_date").alias("__date"))
        .agg(F.max(F.struct("model_file", "auc", "cv", "readable")).alias("model"))
    )
    asked = executions.select(F.col(date).alias("__date")).distinct().withColumn("asked", F.lit(True))
    earlier = Window.orderBy(F.unix_date("__date")).rangeBetween(Window.unboundedPreceding, -1)
    line = asked.unionByName(per_date, allowMissingColumns=True).withColumn(
        "model", F.last("model", ignorenulls=True).over(earlier)
    )
    found = line.filter("asked").select(F.col("__date").alias(date), "model.*")
    return executions.join(found, date, "left")


def models_as_of(executions: DataFrame, registry: DataFrame, date: str = "execution_date") -> DataFrame:
    """Attach to every execution date the newest model that was saved before it and not yet archived on it.

    A model is valid from the day after its name's date to the day before ``archived_date`` (open where that is NULL).  Dates
    and validity meet in calendar months, an equi-join; both tables hold one row per model or run.
    """

    def month(day: Column) -> Column:
        return F.year(day) * 12 + F.month(day)

    asked = executions.select(F.col(date).alias("__date")).distinct()
    last_month = asked.agg(F.max(month(F.col("__date")))).scalar()
    first = month(F.col("name_date"))
    end = F.least(F.coalesce(month(F.col("archived_date")), last_month), last_month)
    valid = registry_entries(registry).filter(F.col("active") & F.col("name_date").isNotNull() & (first <= end))
    spread = valid.withColumn("__month", F.explode(F.sequence(first, end)))
    met = asked.withColumn("__month", month(F.col("__date"))).join(spread, "__month").filter(
        (F.col("name_date") < F.col("__date")) & (F.col("archived_date").isNull() | (F.col("archived_date") > F.col("__date")))
    )
    newest = met.groupBy("__date").agg(
        F.max_by(F.struct("model_file", "auc", "cv", "readable"), F.struct("name_date", "model_file")).alias("model")
    )
    return executions.join(newest.select(F.col("__date").alias(date), "model.*"), date, "left")


def breaches() -> dict[str, Column]:
    """Threshold breaches of the previous model; a missing or zero AUC is a breach of its own."""
    auc, cv = F.coalesce(F.col("auc"), F.lit(0.0)), F.coalesce(F.col("cv"), F.lit(0.0))
    return {
        "auc_critical": (auc > 0) & (auc < fixed.CRITICAL_AUC),
        "auc_warning": (auc > 0) & (auc < fixed.WARNING_AUC),
        "auc_missing": auc <= 0,
        "cv_high": cv > fixed.RETRAIN_CV,
    }


def retraining_decision(
    executions: DataFrame, registry: DataFrame, date: str = "execution_date", epoch: dt.date = EPOCH
) -> DataFrame:
    """``retrain`` or ``keep`` with a reason for every execution date.  A registry with an ``archived_date`` is read as it
    was on that date."""
    models = pipeline_path(registry).select("models").scalar()
    candidate = models_as_of if "archived_date" in registry.columns else previous_model
    known = candidate(executions, registry, date)
    month = months_since(F.col(date), epoch)
    hits = F.filter(F.array(*[F.when(c, name) for name, c in breaches().items()]), lambda b: b.isNotNull())
    judged = known.withColumns({"months_since_start": month, "breaches": hits})
    after_grace = F.col("months_since_start") - 12
    reason = (
        F.when(models == 0, "no_models")
        .when(F.col("model_file").isNull(), "no_previous_model")
        .when(~F.col("readable"), "unreadable_model")
        .when(after_grace < 0, "grace_period")
        .when(F.size("breaches") >= 2, "threshold")
        .when(after_grace % 6 == 0, "periodic")
        .otherwise("healthy")
    )
    retrain = ["no_models", "unreadable_model", "threshold", "periodic"]
    return judged.withColumn("reason", reason).withColumn(
        "decision", F.when(F.col("reason").isin(retrain), "retrain").otherwise("keep")
    )


def trigger_counts(decisions: DataFrame) -> DataFrame:
    """Execution dates per trigger: single breaches of judged models, the schedule and first trainings."""
    past_grace = F.col("reason").isin("threshold", "periodic", "healthy")
    schedule = past_grace & ((F.col("months_since_start") - 12) % 6 == 0)
    triggers = F.concat(
        F.when(past_grace, F.col("breaches")).otherwise(F.array().cast("array<string>")),
        F.when(schedule, F.array(F.lit("schedule"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("reason") == "no_models", F.array(F.lit("initial"))).otherwise(F.array().cast("array<string>")),
    )
    return decisions.select(F.explode(triggers).alias("trigger")).groupBy("trigger").agg(F.count(F.lit(1)).alias("dates"))


def before_and_after(registry: DataFrame) -> DataFrame:
    """AUC of each model against the model of the date before; one model per date."""
    newest = registry.groupBy("model_date").agg(F.max(F.struct("model_file", "auc")).alias("m"))
    return newest.select(
        "m.model_file",
        "model_date",
        F.lag("m.auc").over(Window.orderBy("model_date")).alias("auc_before"),
        F.col("m.auc").alias("auc_after"),
    )


def retraining_timeline(decisions: DataFrame) -> DataFrame:
    """Class of every month: initial training, grace, periodic, threshold or no action."""
    month = F.col("months_since_start")
    kind = (
        F.when(month == 0, "Initial Training")
        .when(month < 12, "Grace Period")
        .when(month % 6 == 0, "Periodic Retrain")
        .when(F.coalesce(F.size("breaches") >= 2, F.lit(False)) & F.col("model_file").isNotNull(), "Threshold Retrain")
        .otherwise("No Action")
    )
    return decisions.withColumn("timeline", kind).withColumn(
        "retrained", F.col("timeline").contains("Retrain").cast("int")
    )


def pipeline_path(registry: DataFrame) -> DataFrame:
    """Train when there is no model at all, else go on to inference."""
    models = F.count_if(F.col("model_file").startswith("credit_model_") & F.col("model_file").endswith(".pkl"))
    return registry.agg(models.alias("models")).withColumn(
        "path", F.when(F.col("models") == 0, "train_model").otherwise("model_inference")
    )


def retention(registry: DataFrame, keep: int = 3) -> DataFrame:
    """Keep the newest ``keep`` files by name, archive the others.

    The boundary name is a top-k, so no ordered pass over the registry is needed.
    """
    files = registry.filter(F.col("model_file").startswith("credit_model_") & F.col("model_file").endswith(".pkl"))
    newest = files.select("model_file").orderBy(F.desc("model_file")).limit(keep)
    boundary = newest.agg(F.min("model_file").alias("b")).scalar()
    return files.withColumn("status", F.when(F.col("model_file") >= boundary, "kept").otherwise("archived"))


def best_model(results: DataFrame, by: Sequence[str] = (), name: str = "model_name", score: str = "auc") -> DataFrame:
    """The model with the highest score; the alphabetically first one on a tie."""
    best = F.min_by(F.struct(name, score), F.struct((-F.col(score)).alias("s"), F.col(name).alias("n")))
    scored = results.filter(F.col(score).isNotNull())
    return scored.groupBy(*by).agg(best.alias("best")).select(*by, "best.*")
