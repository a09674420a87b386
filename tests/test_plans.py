"""Physical plans: what must and must not appear, whatever the data size."""

import re
import time

import pytest
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators import features, monitoring, order_stats
from creditloom.plans.queries import QUERIES, Inputs, stored_predictions
from tests.conftest import SF_DIR


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables far above the broadcast threshold."""
    session.tune(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


# Queries without a model fit; building them is cheap.
PLANNED = [
    "bad_rate_by_mob",
    "label_store_30dpd_3mob",
    "silver_financials",
    "offset_snapshot_join",
    "training_set_bounded",
    "label_left_features",
    "slice_coverage",
    "cap_quantiles",
    "distribution_by_period",
    "drift_detection",
    "auc_gini_by_period",
    "oot_stability",
    "monitoring_row",
    "governance_rules",
    "stratified_split",
    "oot_thirds",
    "retraining_decision",
    "model_retention",
    "batch_summary",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loops_no_python(spark, no_broadcast, capsys, name):
    text = plan(QUERIES[name](spark, SF_DIR), capsys)
    for operator in ("NestedLoop", "Cartesian", "PythonUDF", "ArrowEval", "BatchEvalPython", "InPandas"):
        assert operator not in text


def test_the_label_filter_reaches_the_scan(spark, no_broadcast, capsys):
    text = plan(QUERIES["offset_snapshot_join"](spark, SF_DIR), capsys)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_linenumber,3\)", text)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert not any("l_tax" in line or "l_comment" in line for line in scans)


def test_trend_reads_two_columns(spark, capsys):
    text = plan(QUERIES["performance_trend"](spark, SF_DIR), capsys)
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_quantile_detail_is_spread_over_ranges(spark, no_broadcast, capsys):
    """The join that carries the detail rows shuffles on group and range, never on the group alone."""
    df = order_stats.exact_quantiles(stored_predictions(Inputs(spark, SF_DIR)), monitoring.P, {"m": 0.5}, ["snapshot_date"])
    lines = plan(df, capsys).splitlines()
    at = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    assert re.search(r"SortMergeJoin \[__group#\d+, __range#\d+\]", lines[at])
    first = next(line for line in lines[at:] if "Exchange" in line)
    assert re.search(r"hashpartitioning\(__group#\d+, __range#\d+, \d+\)", first)


def test_repeated_subplans_share_their_shuffle(spark, no_broadcast, capsys):
    df = QUERIES["distribution_by_period"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan(df, capsys)


def test_a_stored_statistic_is_one_subquery(spark, capsys):
    text = plan(QUERIES["cap_quantiles"](spark, SF_DIR), capsys)
    assert len(set(re.findall(r"Subquery subquery#(\d+)", text))) == 1


def test_scratch_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_dir(spark, "x")
    assert path != session.scratch_dir(spark, "x")
    if folder:
        assert path.startswith(folder.rstrip("/"))


def test_time_zone_is_fixed(spark):
    session.tune(spark)
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"


@pytest.mark.parametrize("partitions", [8, 200, 2000])
def test_quantile_plans_do_not_grow_with_columns_and_partitions(spark, monkeypatch, partitions):
    """Twenty capped columns over 400 ranges each: built at once, and in a plan without cut points in its expressions."""
    monkeypatch.setattr(order_stats, "ROWS_PER_RANGE", 50)
    df = spark.range(20_000).select(*[(F.rand(k) * (k + 1)).alias(f"fe_{k + 1}") for k in range(20)]).persist()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df.count()
        began = time.time()
        fitted = features.fit_quantiles(df, features.cap_points(df.columns))
        took = time.time() - began
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        df.unpersist()
    assert order_stats._default_ranges(df) == 400
    assert took < 5 and len(fitted._jdf.queryExecution().optimizedPlan().toString()) < 200_000


@pytest.mark.parametrize("name", ["oot_thirds", "stratified_split"])
def test_splits_never_sort_or_number_rows(spark, no_broadcast, capsys, name):
    """Windows run over counted prefixes alone: none below it reads a row that was not aggregated first."""
    text = plan(QUERIES[name](spark, SF_DIR), capsys)
    assert "Window" in text and "row_number" not in text
    for window in re.findall(r"Window \[.*", text):
        assert "sum(n" in window


@pytest.mark.parametrize(("name", "most"), [("drift_detection", 1), ("monitoring_row", 2)])
def test_monitoring_reads_the_predictions_that_often(spark, no_broadcast, name, most):
    """Everything else follows from the stored rollup."""
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    relations = [line for line in text.splitlines() if re.search(r"Relation \[", line)]
    assert 1 <= sum("props" in line for line in relations) <= most  # a column that only the events have
