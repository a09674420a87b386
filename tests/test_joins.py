"""Joins: equality with the date-by-date form, left-join completeness, and hot keys."""

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import functions as F

from creditloom.operators import features, joins, ledger
from creditloom.plans.queries import Inputs, labels, silver_ledger, silver_statements
from creditloom.sources import scans


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_offset_join_equals_the_loop_over_dates(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    features = silver_statements(i).select("Customer_ID", "row_id", "snapshot_date")
    loans = silver_ledger(i)
    one = joins.offset_join(features, ledger.label_store(loans, 30, 3), 3)

    slices = []
    for (date,) in sorted(scans.snapshot_dates(features).collect()):
        later = dt.date(date.year + (date.month + 2) // 12, (date.month + 2) % 12 + 1, 1)
        label_slice = loans.filter((F.col("snapshot_date") == later) & (F.col("mob") == 3)).select(
            "Customer_ID", ledger.bad_flag(30).alias("label")
        )
        slices.append((date, later, label_slice))
    # A few dates are enough to compare; the loop form is what the operator replaces.
    parts = [
        features.filter(F.col("snapshot_date") == date)
        .join(label_slice, "Customer_ID")
        .select("Customer_ID", "row_id", F.lit(date).alias("d"), F.lit(later).alias("l"), "label")
        for date, later, label_slice in slices[20:32]
    ]
    chosen = [s[0] for s in slices[20:32]]
    mine = one.filter(F.col("feature_snapshot_date").isin(chosen)).select(
        "Customer_ID", "row_id", "feature_snapshot_date", "label_snapshot_date", "label"
    )
    assert rows(mine) == rows(reduce(lambda a, b: a.unionByName(b), parts)) != []


def test_month_end_is_clamped(spark):
    f = spark.createDataFrame([("c", dt.date(2023, 11, 30))], "Customer_ID string, snapshot_date date")
    l = spark.createDataFrame([("c", dt.date(2024, 2, 29), 1)], "Customer_ID string, snapshot_date date, label int")
    assert joins.offset_join(f, l, 3).count() == 1


def test_left_join_keeps_every_label(spark):
    key = "Customer_ID string, snapshot_date date"
    d = dt.date(2024, 1, 1)
    l = spark.createDataFrame([("a", d, 1), ("b", d, 0), (None, d, 1), ("c", None, 0)], key + ", label int")
    f = spark.createDataFrame([("a", d, 5), ("a", d, 6), (None, d, 7)], key + ", fe_1 int")
    plain = l.join(f, ["Customer_ID", "snapshot_date"], "left").select("Customer_ID", "snapshot_date", "label", "fe_1")
    mine = joins.labels_with_features(l, f).select("Customer_ID", "snapshot_date", "label", "fe_1")
    assert rows(mine) == rows(plain)


@pytest.mark.parametrize("hot_rows", [4, 50, 10_000])
def test_left_join_deals_out_heavy_feature_keys(spark, capsys, hot_rows):
    """Heavy keys on the right, equal rows among them; every input once in the plan."""
    d = dt.date(2024, 1, 1)
    key = "Customer_ID string, snapshot_date date"
    f = [("hot", d, k % 7) for k in range(300)] + [("warm", d, 1) for _ in range(60)] + [(f"c{k}", d, k) for k in range(200)]
    f += [(None, d, 1) for _ in range(80)] + [("nul", None, 1) for _ in range(80)]
    l = [("hot", d, 1), ("hot", d, 1), ("warm", d, 0), ("none", d, 1), (None, d, 1), ("nul", None, 0)]
    l += [(f"c{k}", d, k % 2) for k in range(0, 400, 3)]
    labels_ = spark.createDataFrame(l, key + ", label int").repartition(3)
    features_ = spark.createDataFrame(f, key + ", fe_1 int").repartition(5)
    plain = labels_.join(features_, ["Customer_ID", "snapshot_date"], "left").select("Customer_ID", "snapshot_date", "label", "fe_1")
    mine = joins.labels_with_features(labels_, features_, hot_rows=hot_rows)
    assert rows(mine) == rows(plain)
    heavy = joins.heavy_keys(features_, ["Customer_ID", "snapshot_date"], hot_rows)
    assert (heavy is None) == (hot_rows == 10_000)
    if heavy is not None:
        assert {r["Customer_ID"]: r["rows"] for r in heavy.collect()} == {"hot": 300, "warm": 60}


def test_left_join_reads_each_input_once(spark, tmp_path):
    d = F.lit("2024-01-01").cast("date")
    spark.range(500).select(F.concat(F.lit("c"), F.col("id") % 3).alias("Customer_ID"), d.alias("snapshot_date"), F.col("id").alias("fe_1")).write.parquet(f"{tmp_path}/f")
    spark.range(9).select(F.concat(F.lit("c"), F.col("id")).alias("Customer_ID"), d.alias("snapshot_date"), F.lit(1).alias("label")).write.parquet(f"{tmp_path}/l")
    joined = joins.labels_with_features(spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/f"), hot_rows=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and joined.count() == 506


def test_training_set_never_looks_ahead(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    store = silver_statements(i).withColumnRenamed("snapshot_date", "feature_snapshot_date")
    out = joins.training_set(store, labels(i), F.lit("1998-06-01").cast("date"))
    late = out.filter("feature_snapshot_date > '1998-06-01' OR label_snapshot_date > '1998-06-01'")
    assert out.count() > 0 and late.count() == 0


@pytest.fixture
def small_skew(spark):
    """Make the skew handling act on test-sized partitions."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_customer_is_split(spark, small_skew, capsys):
    """One customer and date holds a third of the features; the join splits its partition and loses nothing."""
    d = F.lit("2024-01-01").cast("date")
    features = (
        spark.range(0, 30_000, 1, 6)
        .withColumn("Customer_ID", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))))
        .withColumn("snapshot_date", d)
    )
    outcome = (
        spark.range(0, 30_000, 1, 6)
        .filter("id % 3 <> 0")
        .select(F.concat(F.lit("c"), F.col("id")).alias("Customer_ID"))
        .unionByName(spark.range(2).select(F.lit("hot").alias("Customer_ID")))
        .withColumns({"snapshot_date": F.add_months(d, 3), "label": F.lit(1)})
    )
    joined = joins.offset_join(features, outcome, 3)
    per_customer = joined.groupBy("Customer_ID").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["Customer_ID"]: r["n"] for r in per_customer.filter("Customer_ID = 'hot' OR Customer_ID = 'c1'").collect()}
    assert counts == {"hot": 20_000, "c1": 1}

    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    joined.explain()
    assert "skew=true" in capsys.readouterr().out


def test_two_loans_of_one_slice_give_two_rows(spark):
    """k labels of a customer and date give k rows of a three-way join, and the training join keeps each to its loan."""
    d, later = dt.date(2024, 1, 1), dt.date(2024, 4, 1)
    keys = "Customer_ID string, snapshot_date date"
    sources = [spark.createDataFrame([("a", d, k), ("b", d, k + 5)], f"{keys}, v{k} int") for k in range(3)]
    outcome = [("a", "l1", later, 0), ("a", "l2", later, 0), ("a", "l3", later, 1), ("b", "l4", later, 1)]
    outcome = spark.createDataFrame(outcome, "Customer_ID string, loan_id string, snapshot_date date, label int")
    store = reduce(
        lambda x, y: x.join(y, features.SLICE), [joins.offset_join(f, outcome, 3, carry=["loan_id"]) for f in sources]
    )
    assert rows(store.select("Customer_ID", "loan_id", "label", "v0", "v1", "v2")) == [
        ("a", "l1", 0, 0, 1, 2), ("a", "l2", 0, 0, 1, 2), ("a", "l3", 1, 0, 1, 2), ("b", "l4", 1, 5, 6, 7)
    ]
    kept = store.drop("label", "label_snapshot_date")
    assert joins.training_set(kept, outcome, F.lit("2024-06-01").cast("date")).count() == 4
    twice = {"x": sources[0].unionByName(sources[0].filter("v0 = 0")), "y": sources[1]}
    assert rows(joins.repeated_slices(twice)) == [("x", "a", d, 2)]
