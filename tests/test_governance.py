"""Governance rules against stored documents, and retraining decisions against a truth table."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed
from creditloom.operators import governance

D = dt.date
METRICS = (
    "snapshot_date date, drift_detected boolean, mean_difference double, is_stable boolean, coefficient_of_variation double, "
    "prediction_count bigint, positive_rate double, oot_rating string, oot_cv double"
)


def ruled(spark, drift=False, diff=0.0, stable=True, cv=0.3, count=500, positive=0.2, rating=None, oot_cv=None):
    row = (D(2024, 5, 1), drift, diff, stable, cv, count, positive, rating, oot_cv)
    return governance.apply_rules(spark.createDataFrame([row], METRICS))


def document(df):
    return json.loads(governance.governance_document(df, keep=()).select(F.to_json(F.struct("*"))).first()[0])


# The two stored documents, without their constant blocks.
STORED = [
    (
        {"drift": True, "diff": 0.12, "stable": False, "cv": 0.8},
        ["HIGH: Data drift detected - Schedule retrain within 1 week", "MEDIUM: Monitor model stability closely"],
        {"retrain_urgency": "HIGH", "retrain_timeline": "1 week", "action": "increase_monitoring_frequency"},
        {"strategy": "canary_deployment", "rollback_plan": "manual_approval_rollback"},
    ),
    (
        {"stable": False, "cv": 1.2, "count": 10001, "positive": 0.01},
        [
            "CRITICAL: High prediction variability - Model stability compromised",
            "HIGH: High prediction volume - Consider model optimization",
            "INVESTIGATE: Unusually low positive prediction rate",
        ],
        {"action": "optimize_inference_pipeline", "investigation": "feature_distribution_analysis"},
        {"monitoring": "enhanced_real_time_monitoring"},
    ),
]


@pytest.mark.parametrize("metrics, advice, sop, deployment", STORED)
def test_stored_documents(spark, metrics, advice, sop, deployment):
    assert document(ruled(spark, **metrics)) == {
        "recommendations": advice,
        "governance_sop": sop | fixed.GOVERNANCE_BLOCKS,
        "deployment_options": deployment,
        "oot_stability_assessment": {"rating": "UNKNOWN", "coefficient_of_variation": 0, "recommendation": "N/A"},
    }


@pytest.mark.parametrize(
    "metrics, field, value",
    [
        ({"drift": True, "diff": 0.2}, "strategy", "blue_green_deployment"),
        ({"drift": True, "diff": 0.15}, "strategy", "canary_deployment"),
        ({"drift": True, "diff": 0.05}, "retrain_urgency", "HIGH"),
        ({"drift": False, "diff": 0.9}, "retrain_urgency", None),
        ({"rating": "POOR"}, "action", "immediate_model_review"),
        ({"rating": "POOR", "positive": 0.9}, "investigation", "data_quality_check"),
        ({"rating": "MODERATE"}, "action", "enhanced_monitoring"),
        ({"rating": "EXCELLENT"}, "action", "standard_monitoring"),
        ({"rating": "EXCELLENT", "count": 50}, "action", "increase_data_collection"),
        ({"rating": "GOOD"}, "action", "routine_monitoring"),
        ({"rating": "GOOD"}, "strategy", "maintain_current_deployment"),
        ({"stable": False, "cv": 1.0}, "action", "increase_monitoring_frequency"),
        ({"stable": False, "cv": 1.01}, "monitoring", "enhanced_real_time_monitoring"),
        ({"count": 100}, "action", "routine_monitoring"),
        ({"count": 10000}, "action", "routine_monitoring"),
        ({"positive": 0.8}, "investigation", None),
        ({"positive": 0.05}, "investigation", None),
    ],
)
def test_rules(spark, metrics, field, value):
    assert ruled(spark, **metrics).first()[field] == value


def test_quiet_run(spark):
    row = ruled(spark).first()
    assert row["recommendations"] == ["CONTINUE: Model performance stable - Continue regular monitoring"]


def decision(spark, execution, models):
    registry = spark.createDataFrame(
        models, "model_file string, model_date date, auc double, cv double, readable boolean"
    )
    dates = spark.createDataFrame([(execution,)], "execution_date date")
    return governance.retraining_decision(dates, registry).first()


def model(date=D(2023, 6, 1), auc=0.8, cv=0.01, readable=True, suffix=""):
    return (f"credit_model_{date:%Y%m%d}{suffix}.pkl", date, auc, cv, readable)


@pytest.mark.parametrize(
    "execution, models, expected, reason",
    [
        (D(2023, 5, 1), [], "retrain", "no_models"),
        (D(2024, 5, 1), [model(D(2024, 5, 1))], "keep", "no_previous_model"),
        (D(2024, 5, 1), [model(suffix="_retrain")], "keep", "no_previous_model"),
        (D(2024, 5, 1), [model(suffix="_archived")], "keep", "no_previous_model"),
        (D(2023, 12, 1), [model(auc=0.60, cv=0.20)], "keep", "grace_period"),
        (D(2024, 2, 1), [model(auc=0.69)], "retrain", "threshold"),
        (D(2024, 2, 1), [model(auc=0.71)], "keep", "healthy"),
        (D(2024, 2, 1), [model(auc=0.71, cv=0.09)], "retrain", "threshold"),
        (D(2024, 2, 1), [model(auc=None, cv=0.09)], "retrain", "threshold"),
        (D(2024, 2, 1), [model(auc=None)], "keep", "healthy"),
        (D(2024, 2, 1), [model(readable=False)], "retrain", "unreadable_model"),
        (D(2024, 1, 1), [model()], "retrain", "periodic"),
        (D(2024, 7, 1), [model()], "retrain", "periodic"),
        (D(2024, 3, 1), [model()], "keep", "healthy"),
        (D(2024, 3, 1), [model(D(2023, 6, 1), auc=0.5), model(D(2023, 7, 1))], "keep", "healthy"),
        (D(2024, 3, 1), [model(D(2023, 7, 1), auc=0.5), model(D(2024, 3, 1))], "retrain", "threshold"),
    ],
)
def test_retraining(spark, execution, models, expected, reason):
    row = decision(spark, execution, models)
    assert (row["decision"], row["reason"]) == (expected, reason)


def test_retention_and_path(spark):
    models = [model(D(2024, m, 1)) for m in range(1, 6)] + [("other.txt", D(2024, 1, 1), 0.1, 0.1, True)]
    registry = spark.createDataFrame(models, "model_file string, model_date date, auc double, cv double, readable boolean")
    kept = {r["model_file"] for r in governance.retention(registry).filter("status = 'kept'").collect()}
    assert kept == {f"credit_model_2024{m:02}01.pkl" for m in (3, 4, 5)}
    assert governance.retention(registry).count() == 5
    assert governance.retention(registry.limit(2)).filter("status = 'archived'").count() == 0
    assert governance.pipeline_path(registry).first()["path"] == "model_inference"
    assert governance.pipeline_path(registry.filter("false")).first()["path"] == "train_model"


def test_best_model_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", 0.6), ("d", None)], "model_name string, auc double")
    assert tuple(governance.best_model(df).first()) == ("a", 0.7)
