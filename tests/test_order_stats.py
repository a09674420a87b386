"""Rank statistics against brute force, with ties, hot groups and few distinct values."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.operators import monitoring, order_stats, splits
from creditloom.plans import monitor


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def sample(rows=900, seed=3, levels=None):
    """Three groups, the first with two thirds of all rows; optional ties."""
    r = random.Random(seed)
    out = []
    for k in range(rows):
        score = r.random() ** 3 if levels is None else r.randrange(levels) / levels
        out.append((k, "hot" if k % 3 else f"g{k % 2}", score, int(r.random() < 0.3 + 0.4 * score)))
    return pd.DataFrame(out, columns=["id", "g", "s", "y"])


@pytest.mark.parametrize("levels", [None, 5, 1])
@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_auc(spark, levels, ranges):
    pdf = sample(levels=levels)
    df = spark.createDataFrame(pdf)
    cuts = None if ranges is None else order_stats.range_cuts(df, "s", ranges)
    got = {r["g"]: r for r in order_stats.auc(df, "s", "y", ["g"], cuts).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g]["auc"] == pytest.approx(brute_auc(part.s, part.y))
        assert got[g]["positives"] == part.y.sum()


def test_auc_of_the_complement_and_of_one_class(spark):
    df = spark.createDataFrame(sample())
    up = order_stats.auc(df, "s", "y").first()["auc"]
    down = order_stats.auc(df.withColumn("s", 1 - F.col("s")), "s", "y").first()["auc"]
    assert up + down == pytest.approx(1)
    assert order_stats.auc(df.filter("y = 1"), "s", "y").first()["auc"] is None


def test_cut_points_never_change_the_result(spark):
    df = spark.createDataFrame(sample(levels=20))
    values = {order_stats.auc(df, "s", "y", cuts=c).first()["auc"] for c in ([], [0.5], [0.05, 0.1, 0.9], [-4.0, 7.0])}
    assert len({round(v, 12) for v in values}) == 1


@pytest.mark.parametrize("levels", [None, 4])
def test_exact_quantiles(spark, levels):
    pdf = sample(levels=levels)
    points = {"q0": 0.0, "q25": 0.25, "median": 0.5, "q95": 0.95, "q100": 1.0}
    got = order_stats.exact_quantiles(spark.createDataFrame(pdf), "s", points, ["g"]).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        for name, q in points.items():
            assert got.loc[g, name] == pytest.approx(part.s.quantile(q))
    whole = order_stats.exact_quantiles(spark.createDataFrame(pdf), "s", points).first()
    assert whole["median"] == pytest.approx(pdf.s.median())


def test_hash_positions_are_a_permutation(spark):
    df = spark.createDataFrame(sample())
    placed = order_stats.hash_position(df, "id", by=["g"], digits=1).toPandas()
    for _, part in placed.groupby("g"):
        assert sorted(part.position) == list(range(len(part)))
        assert set(part.group_rows) == {len(part)}


def test_equal_parts_drop_the_remainder(spark):
    parts = splits.equal_parts(spark.range(100).withColumnRenamed("id", "k"), ["k"]).groupBy("part").count()
    assert {r["part"]: r["count"] for r in parts.collect()} == {1: 33, 2: 33, 3: 33}


def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.createDataFrame(sample())
    split = splits.stratified_split(df, ["id"], "y", 0.8)
    pdf = split.toPandas()
    for _, part in pdf.groupby("y"):
        assert (part.split == "train").sum() == round(len(part) * 0.8)
    again = splits.stratified_split(df.repartition(7), ["id"], "y", 0.8).toPandas()
    assert dict(zip(pdf.id, pdf.split)) == dict(zip(again.id, again.split))


def brute_drift(pdf, spark):
    hashed = spark.createDataFrame(pdf).withColumn("h", order_stats.row_hash("Customer_ID", "prediction_probability")).toPandas()
    hashed = hashed.sort_values(["snapshot_date", "h", "prediction_probability"])
    half = len(hashed) // 2
    early, recent = hashed.prediction_probability[:half], hashed.prediction_probability[half:]
    return abs(recent.mean() - early.mean()), abs(recent.std() - early.std()), early.mean(), recent.std()


@pytest.mark.parametrize("shape", ["even", "one_date", "hot_customer", "equal_rows", "odd", "two_rows"])
def test_drift(spark, shape):
    r = np.random.default_rng(7)
    n = {"odd": 301, "two_rows": 2}.get(shape, 300)
    days = pd.to_datetime("2024-01-01") + pd.to_timedelta(np.arange(n) * 6 // n, unit="D")
    pdf = pd.DataFrame(
        {
            "Customer_ID": [f"c{k}" for k in range(n)],
            "snapshot_date": [d.date() for d in days],
            "prediction_probability": r.beta(1, 4, n) + np.arange(n) / n / 2,
            "prediction_class": 0,
        }
    )
    if shape == "one_date":
        pdf["snapshot_date"] = pdf.snapshot_date[0]
    if shape == "hot_customer":
        pdf["Customer_ID"] = "c"
    if shape == "equal_rows":
        pdf["Customer_ID"], pdf["snapshot_date"] = "c", pdf.snapshot_date[0]
        pdf["prediction_probability"] = np.where(np.arange(n) % 3 == 0, 0.25, 0.75)
    got = monitoring.drift(spark.createDataFrame(pdf), digits=1).first()
    want = brute_drift(pdf, spark)
    shown = (got["mean_difference"], got["std_difference"] or 0, got["early_mean"], got["recent_std"] or 0)
    assert shown == pytest.approx([0 if np.isnan(w) else w for w in want], abs=6e-5)
    assert got["drift_detected"] == (want[0] > 0.1 or want[1] > 0.1)


def test_pooled_moments(spark):
    r = np.random.default_rng(5)
    pdf = pd.DataFrame(
        {
            "Customer_ID": "c",
            "snapshot_date": [pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=int(k)) for k in r.integers(0, 5, 200)],
            "prediction_probability": r.beta(2, 5, 200),
            "prediction_class": 0,
        }
    )
    pdf.loc[0, "prediction_probability"] = None
    row = monitoring.overall(monitoring.daily_profile(spark.createDataFrame(pdf).replace(float("nan"), None))).first()
    p = pdf.prediction_probability
    assert row["mean"] == pytest.approx(p.mean()) and row["std"] == pytest.approx(p.std())
    assert row["n"] == 200 and row["scored"] == 199
    assert row["std_of_daily_means"] == pytest.approx(pdf.groupby("snapshot_date").prediction_probability.mean().std())


def test_one_prediction_is_unstable_and_has_no_consistency(spark):
    pdf = pd.DataFrame({"Customer_ID": ["c"], "snapshot_date": [pd.Timestamp("2024-01-01").date()], "prediction_probability": [0.4], "prediction_class": [0]})
    rolled = monitoring.overall(monitoring.daily_profile(spark.createDataFrame(pdf)))
    assert monitoring.stability_metrics(rolled).first()["is_stable"] is False
    assert monitoring.confidence_metrics(rolled).first()["temporal_consistency"] is None
    row, _ = monitor.monitor(spark.createDataFrame(pdf), F.lit("2024-02-01").cast("date"), "m.pkl")
    stored = row.first()
    assert stored["model_stable"] is False and stored["temporal_consistency"] is None
    assert "MEDIUM: Monitor model stability closely" in stored["recommendations"]


def test_missing_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(k, None if k % 2 else "a", k / 10) for k in range(20)], "k int, g string, s double")
    placed = order_stats.hash_position(df, "k", by=["g"])
    assert placed.count() == 20
    medians = {r["g"]: r["m"] for r in order_stats.exact_quantiles(df, "s", {"m": 0.5}, ["g"]).collect()}
    assert medians == {"a": pytest.approx(0.9), None: pytest.approx(1.0)}


@pytest.mark.parametrize(("partitions", "shuffle"), [(1, 8), (16, 200), (64, 512)])
def test_order_statistics_do_not_depend_on_settings(spark, partitions, shuffle):
    """Values between rows never appear; ties, missing values, NaN and infinities keep their places."""
    df = (
        spark.range(20_000)
        .withColumn("v", F.when(F.col("id") < 9_000, F.lit(0.5)).otherwise(F.sqrt(F.col("id").cast("double"))))
        .withColumn("w", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(-F.col("id").cast("double")))
        .withColumn("x", F.expr("CASE id WHEN 1 THEN double('NaN') WHEN 2 THEN double('inf') ELSE id END"))
        .withColumn("none", F.lit(None).cast("double"))
        .repartition(partitions)
    )
    shares = [0.0, 0.01, 0.07, 0.25, 0.5, 0.95, 1.0]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        row = order_stats.order_statistics(df, {c: shares for c in ("v", "w", "x", "none")}).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    pdf = df.select("v", "w").toPandas()
    for c in ("v", "w"):
        values = np.sort(pdf[c].dropna().to_numpy())
        ranks = [max(1, -(-len(values) * round(q * 100) // 100)) - 1 for q in shares]
        assert row[c] == [values[k] for k in ranks]
    assert row["x"][:2] == [0.0, 201.0] and np.isnan(row["x"][-1]) and row["none"] == [None] * len(shares)


def test_hash_digits_follow_the_rows():
    assert [order_stats.hash_digits(n) for n in (0, 1, 50_000, 900_000, 10**9, 10**13)] == [1, 1, 1, 2, 4, 7]


@pytest.mark.parametrize("ranges", [1, 2, 37, 400])
def test_order_statistics_do_not_depend_on_the_ranges(spark, ranges):
    df = spark.range(3_000).withColumns(
        {"v": F.floor(F.sqrt(F.col("id").cast("double"))), "w": F.expr("CASE WHEN id % 5 = 0 THEN double('NaN') ELSE -id END")}
    )
    row = order_stats.order_statistics(df, {"v": [0.1, 0.5, 0.999], "w": [0.0, 0.5, 0.9]}, ranges).first()
    values = np.sort(np.floor(np.sqrt(np.arange(3_000))))
    assert row["v"] == [values[299], values[1499], values[2996]]
    others = np.sort([-k for k in range(3_000) if k % 5])
    assert row["w"][:2] == [others[0], others[1499]] and np.isnan(row["w"][2])


def test_ranges_follow_the_rows(spark):
    assert order_stats._default_ranges(spark.range(10)) == 1
    assert order_stats._default_ranges(spark.range(4 * order_stats.ROWS_PER_RANGE + 1)) == 5
    assert order_stats._default_ranges(spark.range(10**10)) == order_stats.MAX_RANGES


@pytest.mark.parametrize("shape", ["even", "hot", "few", "one_prefix"])
def test_boundaries_equal_positions(spark, monkeypatch, shape):
    """Cut by comparison against numbered rows, over many prefixes, and with more parts than rows."""
    monkeypatch.setattr(order_stats, "ROWS_PER_PREFIX", 10**6 if shape == "one_prefix" else 20)
    rows = 2 if shape == "few" else 997
    df = spark.range(rows).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 9)).alias("g")
    )
    if shape == "hot":
        df = df.withColumn("g", F.lit(None).cast("string"))
    placed = order_stats.hash_position(df, "k", by=["g"]).toPandas()
    thirds = {r["k"]: r["part"] for r in splits.equal_parts(df, ["k"], 3, ["g"]).collect()}
    size = placed.group_rows // 3
    want = {k: p // s + 1 for k, p, s in zip(placed.k, placed.position, size) if s and p // s < 3}
    assert thirds == want
    sides = {r["k"]: r["split"] for r in splits.stratified_split(df, ["k"], "g", 0.8).collect()}
    assert sides == {
        k: "train" if p < int(n * 0.8 + 0.5) else "test" for k, p, n in zip(placed.k, placed.position, placed.group_rows)
    }
