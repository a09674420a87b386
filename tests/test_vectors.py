"""Small hand-checked cases for every rule."""

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed
from creditloom.functions import calendar, cleaning, measures
from creditloom.operators import features, ledger, scaling, silver

D = dt.date


def column(spark, values, kind="string"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")


def evaluate(df, expression):
    return [r[0] for r in df.orderBy("k").select(expression).collect()]


@pytest.mark.parametrize(
    "due, overdue, snapshot, missed, first, dpd, label",
    [
        (100.0, 250.0, D(2024, 3, 31), 3, D(2023, 12, 31), 91, 1),
        (100.0, 100.0, D(2024, 3, 31), 1, D(2024, 2, 29), 31, 1),
        (100.0, 100.0, D(2024, 3, 1), 1, D(2024, 2, 1), 29, 0),
        (100.0, 0.0, D(2024, 3, 1), 0, None, 0, 0),
        (0.0, 5.0, D(2024, 3, 1), 0, None, None, 0),
        (None, 50.0, D(2024, 3, 1), 0, None, None, 0),
    ],
)
def test_days_past_due(spark, due, overdue, snapshot, missed, first, dpd, label):
    row = ("l", "c", D(2023, 1, 1), 10, 3, 1000.0, due, 0.0, overdue, 500.0, snapshot)
    df = spark.createDataFrame([row], ", ".join(f"{c} {t}" for c, t in fixed.LEDGER_TYPES.items()))
    out = silver.clean_loans(df)
    got = out.select("mob", "installments_missed", "first_missed_date", "dpd").first()
    assert tuple(got) == (3, missed, first, dpd)
    assert ledger.label_store(out, 30, 3).first()["label"] == label
    assert ledger.label_store(out, 30, 6).count() == 0


def test_single_precision_ledger_fills_numbers(spark):
    types = ", ".join(f"{c} {t}" for c, t in fixed.LEDGER_TYPES.items())
    rows = [
        ("l", "c", D(2023, 1, 1), 10, 1, 1000.0, 0.1, 0.0, 0.3, None, D(2024, 3, 1)),
        ("l", "c", D(2023, 1, 1), 10, 2, 1000.0, 0.0, 0.0, 5.0, None, D(2024, 3, 1)),
    ]
    df = spark.createDataFrame(rows, types)
    got = silver.clean_loans_single_precision(df).orderBy("mob").select("installments_missed", "balance", "dpd").collect()
    # Single precision pushes 0.3 / 0.1 above 3; a missing balance reads 0; a zero due amount counts as none missed.
    assert [tuple(r) for r in got] == [(4, 0.0, 121), (0, 0.0, None)]
    assert silver.clean_loans(df).orderBy("mob").first()["installments_missed"] == 3


RAW = ["10000_", "__10000__", "__-333.5__", "-100", "3.0", "5-3", "", "_", "NA", "na", "N/A", None]


@pytest.mark.parametrize(
    "keep, to, expected",
    [
        ("0-9.-", "double", [10000.0, 10000.0, -333.5, -100.0, 3.0, None]),
        ("0-9-", "int", [10000, 10000, -3335, -100, 30, None]),
        ("0-9", "int", [10000, 10000, 3335, 100, 30, 53]),
        ("0-9.", "double", [10000.0, 10000.0, 333.5, 100.0, 3.0, 53.0]),
    ],
)
def test_number_cleaning(spark, keep, to, expected):
    got = evaluate(column(spark, RAW), cleaning.number_from_text(F.col("v"), keep, to))
    assert got == expected + [None] * 6


def test_plain_integer_text(spark):
    df = column(spark, ["3.0", "x", "99999999999", "7", None])
    assert evaluate(cleaning.cast_columns(df, {"v": "int"}), F.col("v")) == [3, None, None, 7, None]


def test_numbers_skip_the_detour_through_text(spark):
    df = column(spark, [12345678.5, 3.0], "double")
    assert evaluate(cleaning.clean_numbers(df, {"v": ("0-9.", "double")}), F.col("v")) == [12345678.5, 3.0]


def test_placeholders(spark):
    df = cleaning.blank_tokens(column(spark, ["_", "NA", "na", "N/A", "n/a", "_______", "x"]), fixed.NULL_TOKENS)
    assert evaluate(df, F.col("v")) == [None, None, None, None, "n/a", "_______", "x"]
    df = cleaning.blank_tokens(column(spark, ["_______"]), fixed.ATTRIBUTE_NULL_TOKENS)
    assert evaluate(df, F.col("v")) == [None]


def test_loan_types(spark):
    df = column(spark, ["Auto Loan, Home Loan, and Payday Loan", None, "Auto Loan"])
    stored, clean = cleaning.loan_types(F.col("v")), cleaning.loan_types(F.col("v"), strict=False)
    assert evaluate(df, stored)[0] == ["auto loan", "home loan", "and payday loan"]
    assert evaluate(df, clean)[0] == ["auto loan", "home loan", "payday loan"]
    assert evaluate(df, cleaning.list_size(stored)) == evaluate(df, cleaning.list_size(clean)) == [3, -1, 1]


def test_history(spark):
    df = column(spark, ["22 Years and 3 Months", "5 Years", "NA", "7 Months", None])
    assert evaluate(df, cleaning.history_months(F.col("v"))) == [267, 60, None, None, None]


def test_attributes(spark):
    rows = [("1", "28_", "123-45-6789"), ("2", "-500", "#F%$D@*&8"), ("3", "0", "123-45-678"), ("4", "99", "x123-45-6789")]
    df = spark.createDataFrame(rows, "Customer_ID string, Age string, SSN string").withColumns(
        {"Occupation": F.lit("_______"), "snapshot_date": F.lit("2024-01-01")}
    )
    got = silver.clean_attributes(df).orderBy("Customer_ID").select("Age", "SSN", "Occupation").collect()
    assert [tuple(r) for r in got] == [(28, "123-45-6789", None), (None, None, None), (None, None, None), (99, None, None)]


def test_age_groups(spark):
    df = column(spark, [99, 17, None, 24, 25, 40, 60, 75, 18], "int").selectExpr("k", "v AS Age", "'x' AS Occupation")
    got = [r[0] for r in features.attribute_groups(df).orderBy("k").select("Age_group").collect()]
    assert got == ["60+", "60+", "60+", "<25", "25–39", "40–59", "60+", "60+", "<25"]
    assert features.attribute_groups(df, missing_as_oldest=False).orderBy("k").first()["Age_group"] == "Unknown"


def test_missing_keys_are_dropped(spark):
    rows = [("1", "2024-01-01", "5"), (None, "2024-01-01", "6"), ("2", None, "7"), ("NA", "2024-01-01", "8")]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date string, fe_1 string")
    got = silver.clean_clickstream(df).collect()
    assert [tuple(r) for r in got] == [("1", D(2024, 1, 1), 5)]


def test_ratios_with_zero_divisor(spark):
    assert evaluate(column(spark, [-1.0, 1.0, None], "double"), measures.ratio(F.lit(4.0), F.col("v"))) == [None, 2.0, None]


def test_onehot(spark):
    df = column(spark, ["a", "b", "a", None])
    got = features.encode(df, ["v"]).orderBy("k").select(vector_to_array("v_vec")).collect()
    assert [r[0] for r in got] == [[1, 0], [0, 1], [1, 0], [0, 0]]


def test_many_categories_and_unseen_values(spark):
    df = spark.range(36_000).selectExpr("cast(id as int) k", "cast(id % 12000 as string) v").unionAll(
        spark.range(5).selectExpr("cast(-id as int) k", "'7' v")
    )
    encoder = features.fit_encoder(df, ["v"])
    assert encoder.sizes == {"v": 12_000}
    indexes = encoder.table.select("index").collect()
    assert sorted(r["index"] for r in indexes) == list(range(12_000))
    slots = {r["value"]: r["index"] for r in encoder.table.filter("index < 3").collect()}
    assert slots == {"7": 0, "0": 1, "1": 2}
    unseen = features.encode(column(spark, ["7", "new", None]), ["v"], encoder).orderBy("k").collect()
    assert [r["v_vec"].indices.tolist() for r in unseen] == [[0], [], []] and unseen[0]["v_vec"].size == 12_000


def test_caps_keep_nulls_and_are_fitted_elsewhere(spark):
    train = spark.range(1, 201).selectExpr("cast(id as int) k", "cast(id as int) v")
    df = column(spark, [-5, 3, 500, None], "int")
    fitted = features.fit_quantiles(train, features.cap_points(["v"]))
    assert tuple(fitted.first()) == (2.0, 190.0)
    assert evaluate(features.cap_quantiles(df, ["v"], fitted), F.col("v")) == [2.0, 3.0, 190.0, None]


def test_scaling_uses_the_training_rows(spark):
    train = column(spark, [1.0, 3.0, None], "double").withColumn("w", F.lit(7))
    df = column(spark, [5.0, 2.0], "double").withColumn("w", F.lit(8))
    scaled = scaling.scale(df, ["v", "w"], scaling.fit_scaler(train, ["v", "w"]))
    assert [tuple(r) for r in scaled.orderBy("k").select("v", "w").collect()] == [(3.0, 1.0), (0.0, 1.0)]


def test_alignment(spark):
    df = spark.createDataFrame([("c", D(2024, 1, 1), 5, None)], "Customer_ID string, snapshot_date date, b int, a double")
    out = scaling.align_features(df, ["a", "zz", "b"])
    assert out.columns == ["Customer_ID", "snapshot_date", "a", "zz", "b"]
    assert tuple(out.first())[2:] == (0.0, 0.0, 5.0)
    assert scaling.missing_features(df, ["a", "zz", "b"]) == ["zz"]
    assert scaling.missing_ratio(df, ["a", "zz", "b"]) == pytest.approx(1 / 3)
    assert scaling.numeric_columns(df) == ["b", "a"]


def test_target(spark):
    assert scaling.target_column(spark.range(1).selectExpr("1 AS label", "2 AS target")) == "target"
    with pytest.raises(ValueError):
        scaling.target_column(spark.range(1))


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def day(text):
    return F.lit(text).cast("date")


def test_month_starts(spark):
    months = one(spark, calendar.month_starts(day("2023-01-15"), day("2024-12-01")))[0]
    assert len(months) == 24 and months[0] == D(2023, 1, 1) and months[-1] == D(2024, 12, 1)


def test_training_windows(spark):
    w = calendar.training_windows(day("2024-09-01"))
    got = one(spark, *[w[k] for k in ("oot_start", "oot_end", "train_start", "train_end")])
    assert tuple(got) == (D(2024, 7, 1), D(2024, 8, 31), D(2023, 7, 1), D(2024, 6, 30))


def test_batch_dates(spark):
    start = day("2024-09-01")
    dates = one(spark, calendar.dates_between(start, calendar.batch_end(start), "monthly"))[0]
    assert dates == [D(2024, 9, 1), D(2024, 10, 1), D(2024, 11, 1), D(2024, 12, 1)]
    assert len(one(spark, calendar.dates_between(start, calendar.batch_end(start), "weekly"))[0]) == 14
    assert one(spark, calendar.dates_between(day("2024-09-02"), start, "daily"))[0] == []
    with pytest.raises(ValueError):
        calendar.dates_between(start, start, "yearly")


def test_model_names(spark):
    df = column(spark, ["credit_model_20240901.pkl", "credit_model_20240901_retrain.pkl", "credit_model_20241399.pkl"])
    assert evaluate(df, measures.model_file_date(F.col("v"))) == [D(2024, 9, 1), None, None]
    assert evaluate(df, measures.model_stem(F.col("v")))[0] == "credit_model_20240901"


def test_ratings(spark):
    df = column(spark, [0.0199, 0.02, 0.05, 0.0999, 0.1, None], "double")
    assert evaluate(df, measures.oot_rating(F.col("v"))) == ["EXCELLENT", "GOOD", "MODERATE", "MODERATE", "POOR", None]
