"""Registered queries: every operator over whole test tables.

Each query takes ``(spark, sf_dir)``.  Doubles that come out of sums are rounded so that summation order, which
differs between engines and runs, cannot show.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import session
from creditloom.fixed_values import DRIFT_THRESHOLD, FINANCIAL_CATEGORIES
from creditloom.functions import calendar, cleaning, measures
from creditloom.operators import (
    features,
    governance,
    inference,
    joins,
    ledger,
    monitoring,
    order_stats,
    scaling,
    silver,
    splits,
    training,
)
from creditloom.plans import mart, monitor
from creditloom.sources import adapters, ingest, scans, sinks, stores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
REGISTRY_EPOCH = dt.date(1995, 1, 1)


class Inputs:
    """The adapters and tables of one scale factor, by attribute.  Each is built once, so that uses of the same input
    within a query are recognisably the same and Spark can reuse their exchanges."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in adapters.ADAPTERS:
            df = adapters.adapter(self.spark, self.sf_dir, name)
        else:
            df = adapters.table(self.spark, self.sf_dir, name)
        setattr(self, name, df)
        return df

    def scratch(self, label: str) -> str:
        return session.scratch_dir(self.spark, label)


def query(build: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Inputs(session.tune(spark), sf_dir))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def staged(i: Inputs):
    """Store intermediate results under a fresh scratch folder."""
    folder = i.scratch("stage")
    return lambda df, name: sinks.materialise(df, f"{folder}/{name}")


# --- ledger -----------------------------------------------------------------------------------------------------


def silver_ledger(i: Inputs) -> DataFrame:
    return silver.clean_loans(i.loans)


@query
def bad_rate_by_mob(i):
    return rounded(ledger.bad_rate(silver_ledger(i)), "bad_rate").orderBy("mob")


@query
def bad_rate_completed_cohort(i):
    cohort = ledger.started_before(silver_ledger(i), day("1998-01-01"))
    return rounded(ledger.bad_rate(cohort), "bad_rate")


@query
def fixed_instalment_bads(i):
    rows = ledger.at_instalment(silver_ledger(i), 5).withColumn("dpd_flag", ledger.bad_flag(30))
    return rows.select("loan_id", "Customer_ID", "snapshot_date", "dpd", "dpd_flag")


@query
def silver_loans(i):
    return silver_ledger(i)


@query
def silver_loans_lab_variant(i):
    df = silver.clean_loans_single_precision(i.loans)
    money = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
    return df.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in money})


@query
def label_store_30dpd_3mob(i):
    return ledger.label_store(silver_ledger(i), 30, 3)


@query
def label_store_30dpd_6mob(i):
    return ledger.label_store(silver_ledger(i), 30, 6)


@query
def label_distribution(i):
    return ledger.label_distribution(ledger.label_store(silver_ledger(i)))


@query
def snapshot_row_audit(i):
    return scans.row_audit(i.loans)


@query
def snapshot_dates(i):
    return scans.snapshot_dates(i.loans)


@query
def snapshot_scan_eq(i):
    return scans.snapshot(i.loans, "1998-03-01").select("loan_id", "installment_num", "snapshot_date")


@query
def snapshot_scan_range(i):
    return scans.snapshot_range(i.loans, "1997-07-01", "1998-06-30").select("loan_id", "installment_num", "snapshot_date")


@query
def snapshot_scan_upto(i):
    return scans.snapshots_until(i.loans, "1996-12-31").select("loan_id", "installment_num", "snapshot_date")


# --- cleaning ---------------------------------------------------------------------------------------------------


def silver_statements(i: Inputs) -> DataFrame:
    return silver.clean_financials(i.financials)


def silver_people(i: Inputs) -> DataFrame:
    return silver.clean_attributes(i.attributes)


@query
def silver_financials(i):
    return silver_statements(i).withColumn("Loan_Types_Array", F.array_join("Loan_Types_Array", "; "))


@query
def loan_type_array(i):
    stored, clean = cleaning.loan_types(F.col("Type_of_Loan")), cleaning.loan_types(F.col("Type_of_Loan"), strict=False)
    return i.financials.select(
        "row_id",
        F.array_join(stored, "; ").alias("loan_types"),
        F.array_join(clean, "; ").alias("loan_types_clean"),
        cleaning.list_size(stored).alias("num_loan_types"),
    )


@query
def credit_history_months(i):
    return i.financials.select(
        "row_id", "Credit_History_Age", cleaning.history_months(F.col("Credit_History_Age")).alias("months")
    )


@query
def silver_attributes(i):
    return silver_people(i)


@query
def silver_clickstream(i):
    return silver.clean_clickstream(i.clickstream)


@query
def silver_clickstream_text(i):
    """All twenty features from dirty text."""
    return silver.clean_clickstream(i.clickstream_text)


# --- features ---------------------------------------------------------------------------------------------------


@query
def impute_defaults_median(i):
    completed = features.complete_financials(silver_statements(i))
    filled = features.attach(completed, features.fit_financials(completed))
    return filled.select(
        "row_id",
        "Credit_Mix",
        "Payment_Behaviour",
        "Changed_Credit_Limit",
        "Monthly_Balance",
        features.impute_debt(filled).alias("Outstanding_Debt"),
    )


@query
def ratio_features(i):
    ratios = features.financial_ratios()
    df = features.complete_financials(silver_statements(i)).withColumns(ratios)
    return rounded(df.select("row_id", *ratios), *[c for c in ratios if c != "has_credit_limit_change"])


@query
def cap_quantiles(i):
    return features.click_features(silver.clean_clickstream(i.clickstream))


@query
def age_groups(i):
    people = features.attribute_groups(silver_people(i))
    known = measures.age_group(F.col("Age"), missing_as_oldest=False)
    return people.select("Customer_ID", "snapshot_date", "Age", "Occupation", "Age_group", known.alias("Age_group_known"))


def _slot(vector: str) -> Column:
    """1-based place of the one in a one-hot vector, 0 for the all-zero vector."""
    return F.array_position(vector_to_array(vector), 1.0).cast("int")


@query
def index_onehot(i):
    df = features.encode(silver_statements(i), FINANCIAL_CATEGORIES)
    shown = {}
    for c in FINANCIAL_CATEGORIES:
        shown[f"{c}_slot"] = _slot(f"{c}_vec")
        shown[f"{c}_width"] = F.size(vector_to_array(f"{c}_vec"))
    return df.withColumns(shown).select("row_id", *shown)


@query
def standard_scale(i):
    """Every embedding dimension scaled, in long form."""
    return rounded(scaling.scale_vectors(i.embeddings, ["vec_id"], "embedding"), "scaled", digits=5)


@query
def align_features(i):
    clean = silver.clean_clickstream(i.clickstream)
    wanted = ["fe_3", "fe_1", "fe_99", "fe_2"]
    absent = scaling.missing_features(clean, wanted)
    aligned = scaling.align_features(clean, wanted, keep=["event_id"])
    return aligned.withColumns(
        {
            "missing_features": F.lit(",".join(absent)),
            "missing_ratio": F.lit(scaling.missing_ratio(clean, wanted)),
            "numeric_features": F.lit(",".join(scaling.numeric_columns(clean, (*scaling.NOT_FEATURES, "event_id")))),
            "click_features": F.lit(",".join(scaling.prefixed_columns(clean))),
        }
    )


# --- joins ------------------------------------------------------------------------------------------------------


def labels(i: Inputs, mob: int = 3) -> DataFrame:
    return ledger.label_store(silver_ledger(i), 30, mob)


@query
def offset_snapshot_join(i):
    joined = joins.offset_join(silver_statements(i), labels(i))
    return joined.select("Customer_ID", "row_id", "feature_snapshot_date", "label_snapshot_date", "label", "Annual_Income")


@query
def training_set_bounded(i):
    store = silver_statements(i).withColumnRenamed("snapshot_date", "feature_snapshot_date")
    rows = joins.training_set(store, labels(i), day("1998-06-01"))
    return rows.select("Customer_ID", "row_id", "feature_snapshot_date", "label_snapshot_date", "label")


@query
def label_join_customer_only(i):
    store = silver_statements(i).withColumnRenamed("snapshot_date", "feature_snapshot_date")
    rows = joins.customer_labels(store, labels(i), day("1997-06-01"))
    return rows.select("Customer_ID", "row_id", "feature_snapshot_date", "loan_id", "label", "snapshot_date")


@query
def label_left_features(i):
    return joins.labels_with_features(labels(i), i.clickstream_m)


@query
def slice_coverage(i):
    return joins.slice_coverage(i.financials, labels(i))


@query
def repeated_keys(i):
    return joins.repeated_keys(i.financials, "Customer_ID", "snapshot_date")


@query
def repeated_slices(i):
    """Slices that a source of the feature store repeats."""
    return joins.repeated_slices(
        {"financials": silver_statements(i), "attributes": silver_people(i), "clickstream": i.clickstream_m}
    )


@query
def feature_store(i):
    store = features.feature_store(
        silver_statements(i), silver_people(i), i.clickstream_m, silver_ledger(i), stage=staged(i)
    )
    encoded = [c for c in store.columns if c.endswith("_vec")]
    shown = store.withColumns({c.replace("_vec", "_slot"): _slot(c) for c in encoded}).drop(*encoded)
    return rounded(shown, *[n for n, t in shown.dtypes if t == "double"])


# --- calendars, splits ------------------------------------------------------------------------------------------


@query
def month_calendar(i):
    bounds = i.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return bounds.select(F.explode(calendar.month_starts(F.col("a"), F.col("b"))).alias("snapshot_date"))


@query
def batch_calendar(i):
    start = i.events.agg(F.min("ts").cast("date").alias("a"))
    bounds = start.withColumn("b", calendar.batch_end(F.col("a")))
    lists = [F.struct(F.lit(f).alias("frequency"), calendar.dates_between(F.col("a"), F.col("b"), f).alias("dates")) for f in calendar.STEPS]
    per_frequency = bounds.select(F.explode(F.array(*lists)).alias("l")).select("l.*")
    return per_frequency.select("frequency", F.explode("dates").alias("inference_date"))


@query
def time_split(i):
    split = splits.time_split(labels(i), day("1998-09-01"))
    return rounded(ledger.base_rates(split), "base_rate")


@query
def hash_split(i):
    return splits.hash_split(i.predictions, ["Customer_ID", "event_id"]).select("event_id", "split")


@query
def stratified_split(i):
    return splits.stratified_split(i.predictions, ["Customer_ID", "event_id"]).select("event_id", "label", "split")


@query
def oot_thirds(i):
    held_out = splits.hash_split(i.predictions, ["Customer_ID", "event_id"]).filter("split = 'test'")
    return splits.equal_parts(held_out, ["Customer_ID", "event_id"]).select("event_id", "part")


# --- monitoring -------------------------------------------------------------------------------------------------

ROW_KEYS = ("Customer_ID", "event_id")


def stored_predictions(i: Inputs) -> DataFrame:
    return monitoring.reconcile(i.predictions)


def profile(i: Inputs) -> DataFrame:
    return monitoring.daily_profile(stored_predictions(i))


def overall(i: Inputs) -> DataFrame:
    return monitoring.overall(profile(i))


@query
def performance_trend(i):
    return monitoring.performance_trend(profile(i))


@query
def distribution_by_period(i):
    return monitoring.distribution_by_period(stored_predictions(i))


@query
def prediction_concentration(i):
    return rounded(monitoring.prediction_concentration(overall(i)), "below_0_1", "between_0_1_0_5", "above_0_5")


@query
def confidence_metrics(i):
    return monitoring.confidence_metrics(overall(i))


@query
def stability_metrics(i):
    return monitoring.stability_metrics(overall(i))


@query
def monitoring_period(i):
    return monitoring.monitoring_period(overall(i))


@query
def run_statistics(i):
    return rounded(monitoring.run_statistics(stored_predictions(i)), "mean", "std", "positive_rate")


@query
def drift_detection(i):
    return monitoring.drift(stored_predictions(i), ROW_KEYS, stage=staged(i))


@query
def rollup_by_snapshot(i):
    """The daily profile from a rollup that was appended snapshot by snapshot, with prefixes of different lengths."""
    path, first = i.scratch("rollup"), F.col("snapshot_date") < day("2024-01-15")
    for part, digits in ((stored_predictions(i).filter(first), 1), (stored_predictions(i).filter(~first), 2)):
        sinks.write_snapshots(monitoring.rollup(part, ROW_KEYS, digits), path)
    stored = i.spark.read.parquet(path).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    profile = monitoring.profile_of(stored)
    return profile.withColumns({c: measures.stable_round(F.col(c)) for c in ("mean", "std")})


@query
def confidence_histogram(i):
    return monitoring.confidence_histogram(stored_predictions(i))


def daily_auc(i: Inputs) -> DataFrame:
    return order_stats.auc(stored_predictions(i), monitoring.P, "label", by=["snapshot_date"])


@query
def auc_gini_by_period(i):
    return rounded(daily_auc(i), "auc")


@query
def average_period_auc(i):
    return daily_auc(i).agg(F.count("auc").alias("periods"), F.round(F.avg("auc"), 6).alias("oot_avg"))


@query
def auc_text_length_quality(i):
    scored = i.documents.select("doc_id", "n_chars").join(i.labels, "doc_id", "inner")
    return rounded(order_stats.auc(scored, "n_chars", "quality"), "auc")


def weekly_auc(i: Inputs) -> DataFrame:
    """Three models (by customer number) over weekly periods."""
    version = F.concat(F.lit("credit_model_"), F.pmod(F.col("Customer_ID").cast("bigint"), F.lit(3)).cast("string"))
    df = stored_predictions(i).withColumns(
        {"model_version": version, "period": F.date_trunc("week", "snapshot_date").cast("date")}
    )
    return order_stats.auc(df, monitoring.P, "label", by=["model_version", "period"])


@query
def oot_stability(i):
    return rounded(
        monitoring.oot_stability(weekly_auc(i)),
        "average_score",
        "std_deviation",
        "coefficient_of_variation",
        "score_spread",
    )


@query
def threshold_incidents(i):
    periods = daily_auc(i).join(monitoring.drift_by_period(profile(i)), "snapshot_date", "inner")
    return rounded(monitoring.threshold_incidents(periods), "average_auc", "average_drift")


@query
def monitoring_row(i):
    oot = monitoring.oot_stability(daily_auc(i).withColumn("model_version", F.lit("m")))
    metrics = monitor.run_metrics(
        stored_predictions(i), day("2024-02-01"), "credit_model_2024_02_01.pkl", oot, ROW_KEYS, stage=staged(i)
    )
    return monitor.monitoring_row(governance.apply_rules(metrics))


def governed(i: Inputs) -> DataFrame:
    """Rules per snapshot date.  The rating of a date comes from its predictions' AUC over three equal parts."""
    daily = staged(i)(profile(i), "profile")
    drifted = monitoring.drift_by_period(daily)
    parts = splits.equal_parts(stored_predictions(i), ROW_KEYS, by=["snapshot_date"])
    cuts = order_stats.range_cuts(stored_predictions(i), monitoring.P)
    part_auc = order_stats.auc(parts, monitoring.P, "label", by=["snapshot_date", "part"], cuts=cuts)
    rating = monitoring.oot_stability(part_auc, by=["snapshot_date"]).select(
        "snapshot_date",
        F.col("stability_rating").alias("oot_rating"),
        F.round("coefficient_of_variation", 4).alias("oot_cv"),
    )
    cv = measures.stable_round(F.try_divide("std", "mean"))
    metrics = (
        daily.join(drifted, "snapshot_date")
        .join(rating, "snapshot_date", "left")
        .select(
            "snapshot_date",
            (F.coalesce("drift_score", F.lit(0.0)) > DRIFT_THRESHOLD).alias("drift_detected"),
            measures.stable_round(F.col("drift_score")).alias("mean_difference"),
            monitoring.is_stable(cv).alias("is_stable"),
            cv.alias("coefficient_of_variation"),
            F.col("n").alias("prediction_count"),
            measures.stable_round(F.try_divide("positives", "n")).alias("positive_rate"),
            "oot_rating",
            "oot_cv",
        )
    )
    return governance.apply_rules(metrics)


@query
def governance_rules(i):
    return governed(i).select(
        "snapshot_date",
        F.array_join("recommendations", " | ").alias("recommendations"),
        *governance.FIELDS,
        "oot_rating",
    )


@query
def governance_json(i):
    path = i.scratch("governance")
    documents = governance.governance_document(governed(i))
    sinks.write_documents(documents, path)
    back = i.spark.read.schema(documents.schema).json(path)
    sop = documents.schema["governance_sop"].dataType
    blocks = [
        F.col(f"governance_sop.`{block.name}`.`{entry.name}`").alias(f"{block.name}_{entry.name}")
        for block in sop.fields
        if isinstance(block.dataType, T.StructType)
        for entry in block.dataType.fields
    ]
    advice = [f"governance_sop.{f.name}" for f in sop.fields if not isinstance(f.dataType, T.StructType)]
    return back.select(
        "snapshot_date",
        F.array_join("recommendations", " | ").alias("recommendations"),
        *advice,
        *blocks,
        "deployment_options.*",
        "oot_stability_assessment.rating",
        F.round("oot_stability_assessment.coefficient_of_variation", 6).alias("oot_cv"),
        F.col("oot_stability_assessment.recommendation").alias("explanation"),
    )


# --- batch summaries --------------------------------------------------------------------------------------------


def summary(i: Inputs) -> DataFrame:
    """Daily calendar over the predictions and a week beyond, so some dates have none."""
    preds = i.predictions
    bounds = preds.agg(F.min("snapshot_date").alias("a"), F.date_add(F.max("snapshot_date"), 7).alias("b"))
    days = calendar.calendar(bounds, "a", "b", "daily")
    return inference.batch_summary(days, preds)


@query
def batch_summary(i):
    return rounded(summary(i), "avg_probability")


@query
def batch_rollup(i):
    return rounded(inference.batch_rollup(summary(i)), "overall_positive_rate", "average_probability")


@query
def success_rate(i):
    weekly = summary(i).withColumn("week", F.date_trunc("week", "snapshot_date").cast("date"))
    return rounded(inference.success_rate(weekly, by=["week"]), "success_rate")


# --- registry ---------------------------------------------------------------------------------------------------


def executions(i: Inputs) -> DataFrame:
    bounds = i.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return bounds.select(F.explode(calendar.month_starts(F.col("a"), F.col("b"))).alias("execution_date"))


def decisions(i: Inputs) -> DataFrame:
    return governance.retraining_decision(executions(i), i.registry, epoch=REGISTRY_EPOCH)


@query
def retraining_decision(i):
    return decisions(i).select(
        "execution_date", "model_file", "months_since_start", F.array_join("breaches", ",").alias("breaches"), "reason", "decision"
    )


@query
def retraining_as_of(i):
    """Decisions over a registry in which models are archived between two and seven months after their date, some never."""
    months = F.month("model_date")
    archived = F.when(months % 4 > 0, F.add_months("model_date", 2 + months % 6))
    registry = i.registry.withColumn("archived_date", archived)
    decided = governance.retraining_decision(executions(i), registry, epoch=REGISTRY_EPOCH)
    return decided.select("execution_date", "model_file", F.array_join("breaches", ",").alias("breaches"), "reason", "decision")


@query
def retraining_timeline(i):
    return governance.retraining_timeline(decisions(i)).select("execution_date", "timeline", "retrained")


@query
def retraining_trigger_counts(i):
    return governance.trigger_counts(decisions(i))


@query
def retraining_before_after(i):
    return governance.before_and_after(i.registry)


@query
def pipeline_path(i):
    return governance.pipeline_path(i.registry)


@query
def model_retention(i):
    return governance.retention(i.registry).select("model_file", "status")


@query
def best_model(i):
    return governance.best_model(i.registry.withColumn("year", F.year("model_date")), by=["year"], name="model_file")


@query
def model_names(i):
    name = F.col("model_file")
    return i.registry.select(
        "model_file",
        measures.model_stem(name).alias("stem"),
        measures.model_file_date(name).alias("name_date"),
        measures.model_version(F.col("model_date")).alias("model_version"),
        measures.oot_rating(F.col("cv")).alias("rating"),
        measures.oot_explanation(measures.oot_rating(F.col("cv"))).alias("explanation"),
        measures.gini(F.col("auc")).alias("gini"),
    )


# --- stores -----------------------------------------------------------------------------------------------------


@query
def bronze_ingest(i):
    """Ledger out to CSV, through the bronze layer, and back through silver; one source is missing on purpose."""
    root = i.scratch("bronze")
    i.loans.write.option("header", True).option("compression", "gzip").csv(f"{root}/source/loans")
    report = ingest.ingest_bronze(
        i.spark, {"loans": f"{root}/source/loans", "clickstream": f"{root}/source/absent"}, f"{root}/bronze"
    )
    back = silver.clean_loans(ingest.read_bronze(i.spark, f"{root}/bronze", "loans"))
    return back.withColumns({"ingested_rows": F.lit(report["loans"]), "skipped": F.lit(report["clickstream"] is None)})


@query
def bronze_csv_snapshots(i):
    """Ledger as CSV per snapshot, all of them read back with their contents."""
    path = i.scratch("bronze_csv")
    sinks.write_csv_snapshots(i.loans, path)
    back = i.spark.read.option("header", True).option("inferSchema", False).csv(path)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in i.loans.schema.fields])


@query
def bronze_reconcile(i):
    """Predictions stored in an old and a new layout, read as one."""
    root = i.scratch("reconcile")
    old = i.predictions.filter("label = 0").drop("label")
    new = monitoring.reconcile(i.predictions).filter("label = 1").drop("label")
    sinks.write_table(old, f"{root}/old.parquet")
    sinks.write_table(new, f"{root}/new.parquet")
    return stores.read_predictions(i.spark, [f"{root}/old.parquet", f"{root}/new.parquet"])


@query
def slice_union(i):
    """Slices of an older and a newer schema as one table; absent columns are missing values."""
    older = i.clickstream.filter("fe_3 IS NULL").drop("fe_3")
    return scans.union_slices([older, i.clickstream.filter("fe_3 IS NOT NULL")])


@query
def snapshot_overwrite(i):
    """All snapshots, then a re-run of the later ones: only those are replaced."""
    path = i.scratch("snapshots")
    first = i.predictions.withColumn("run", F.lit(1))
    sinks.write_snapshots(first, path)
    rerun = scans.snapshot_range(first, "2024-01-16", "2024-12-31").withColumn("run", F.lit(2))
    sinks.write_snapshots(rerun, path)
    sinks.write_snapshots(rerun, path)
    return i.spark.read.parquet(path).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


@query
def snapshot_rebuild(i):
    """All snapshots, a rebuild from the later ones, which drops the others, and a back-fill of one week."""
    path = i.scratch("rebuild")
    first = i.predictions.withColumn("run", F.lit(1))
    sinks.write_snapshots(first, path)
    sinks.write_snapshots(scans.snapshot_range(first, "2024-01-16", "2024-12-31").withColumn("run", F.lit(2)), path, rebuild=True)
    sinks.write_snapshots(scans.snapshot_range(first, "2024-01-03", "2024-01-09").withColumn("run", F.lit(3)), path)
    return i.spark.read.parquet(path).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


@query
def batch_summary_append(i):
    """Summary rows of two runs in one store."""
    path = i.scratch("summaries")
    rows = inference.with_run(summary(i), day("2024-01-01"), day("2024-04-01"), "daily")
    for at in ("2024-04-01 08:00:00", "2024-04-02 08:00:00"):
        sinks.append_run(rows, path, F.lit(at).cast("timestamp_ntz"))
    stored = i.spark.read.parquet(path).withColumn("run_date", F.col("batch_execution_date").cast("date"))
    return rounded(stored.drop("batch_execution_date"), "avg_probability")


def _named_files(i: Inputs) -> str:
    """Daily trend rows stored one named file per date."""
    path = i.scratch("named")
    trend = monitoring.performance_trend(profile(i))
    stamp = F.date_format("snapshot_date", "yyyy_MM_dd")
    run = F.date_format("snapshot_date", "yyyyMMdd")
    file = F.concat(F.lit("model_monitoring_"), stamp, F.lit(".parquet"))
    batch = F.concat(F.lit("batch_inference_summary_daily_"), run, F.lit("_063000.parquet"))
    trend.withColumn("file", file).write.partitionBy("file").parquet(f"{path}/monitoring")
    trend.withColumn("file", batch).write.partitionBy("file").parquet(f"{path}/batch")
    return path


@query
def store_dates_from_paths(i):
    path = _named_files(i)
    dated = stores.with_path_date(stores.read_all(i.spark, f"{path}/monitoring"))
    stamped = stores.with_path_timestamp(stores.read_all(i.spark, f"{path}/batch"))
    return dated.select("snapshot_date", "monitoring_date", "prediction_count").join(
        stamped.select("snapshot_date", "batch_run_timestamp", F.col("batch_run_timestamp_at").cast("timestamp_ntz").alias("run_at")),
        "snapshot_date",
    )


@query
def store_inventory(i):
    path = _named_files(i)
    return stores.inventory(
        {name: stores.read_all(i.spark, f"{path}/{name}") for name in ("monitoring", "batch")}
    )


# --- models -----------------------------------------------------------------------------------------------------


def vectors(i: Inputs) -> DataFrame:
    """Embeddings with a binary label and a repeatable train/test/oot split."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    df = i.embeddings.select(
        F.col("vec_id").cast("string").alias("Customer_ID"),
        array_to_vector(doubles).alias("embedding_vec"),
        (F.col("label") % 2).alias("label"),
    )
    u = order_stats.hash_fraction("Customer_ID")
    return df.withColumn("split", F.when(u < 0.6, "train").when(u < 0.8, "test").otherwise("oot"))


def train_rows(i: Inputs) -> DataFrame:
    return vectors(i).filter("split = 'train'")


def checked(table: DataFrame, floor: float = 0.6) -> DataFrame:
    """A comparison table without the figures a fit blurs: rows per class, whether the training rows rank at least as
    well as ``floor`` and the others have a figure at all, and whether Gini follows from the AUC."""
    auc = F.col("auc")
    learned = F.when(F.col("split") == "train", auc >= floor).otherwise(auc.between(0, 1))
    follows = F.abs(F.col("gini") - (2 * auc - 1)) < 0.000501  # stored with three digits
    return table.select("model_name", "split", "positives", "negatives", learned.alias("learned"), follows.alias("gini_follows"))


def fit_and_compare(i: Inputs, name: str, make) -> DataFrame:
    return training.compare_models(training.fit_models({name: make}, train_rows(i)), vectors(i), stage=staged(i))


def logistic_model(i: Inputs):
    return training.logistic(["embedding_vec"], train_rows(i).count())


@query
def train_logistic(i):
    """Logistic regression, and on how many rows the stored coefficients give the model's own probability."""
    model = training.fit_models({"logistic_regression": lambda: logistic_model(i)}, train_rows(i))["logistic_regression"]
    _, scaler, fitted = model.stages
    weights = [w / s if s else 0.0 for w, s in zip(fitted.coefficients, scaler.std)]
    shift = fitted.intercept - sum(w * m for w, m in zip(weights, scaler.mean))
    product = F.zip_with(vector_to_array("embedding_vec"), F.array(*map(F.lit, weights)), lambda x, w: x * w)
    by_hand = 1 / (1 + F.exp(-(F.aggregate(product, F.lit(0.0), lambda total, x: total + x) + F.lit(float(shift)))))
    scored = inference.with_probability(model, vectors(i))
    same = scored.groupBy("split").agg(F.count_if(F.abs(by_hand - F.col("model_predictions")) < 1e-9).alias("rows_by_formula"))
    table = training.compare_models({"logistic_regression": model}, vectors(i), stage=staged(i))
    return checked(table).join(same, "split")


@query
def train_forest(i):
    return checked(fit_and_compare(i, "random_forest", lambda: training.forest(["embedding_vec"])))


def boosted_model(**options):
    return training.boosted(["embedding_vec"], **options)


def marked_rows(i: Inputs) -> DataFrame:
    return training.with_validation(train_rows(i), ["Customer_ID"])


@query
def train_gbt(i):
    makers = {"boosted_trees": lambda: boosted_model(validation="is_validation")}
    models = training.fit_models(makers, marked_rows(i))
    return checked(training.compare_models(models, vectors(i), stage=staged(i)))


def vector_width(i: Inputs) -> int:
    return i.embeddings.agg(F.max(F.size("embedding")).alias("n")).first()["n"]


@query
def train_mlp(i):
    return checked(fit_and_compare(i, "neural_network", lambda: training.perceptron(["embedding_vec"], vector_width(i))))


@query
def random_search(i):
    """Random search over the boosted trees' grid, broken off after two points and continued: its trials, how many points
    differ, and how many have a place."""
    path, space = i.scratch("trials"), mart.SEARCH_SPACES["boosted_trees"]
    rows = train_rows(i)
    for draws in (2, 4):
        trials = training.run_trials({"boosted_trees": (boosted_model(), space)}, rows, ["Customer_ID"], path, draws=draws, parallelism=8)
    ranked = training.rank_trials(trials)
    size = rows.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")).alias("s")).select("s").scalar()
    places = ranked.agg(F.struct(F.max("place").alias("last"), F.count_if("best").alias("best")).alias("s")).select("s").scalar()
    return trials.agg(
        F.count(F.lit(1)).alias("trials"),
        F.countDistinct("parameters").alias("distinct_points"),
        F.count_if(F.col("auc").between(0, 1)).alias("rated"),
        F.max(places["last"]).alias("places"),
        F.max(places["best"]).alias("best"),
        F.max(size["n"]).alias("train_rows"),
        F.max(size["positives"]).alias("train_positives"),
    )


@query
def trial_ranking(i):
    """Mean, spread, place and choice over a trial table: one learner per kind of event, a point per user group, a fold
    per event, some trials without a rating and some rated twice."""
    point = F.col("user_id") % 25
    trials = i.events.select(
        F.col("event_type").alias("learner"),
        point.cast("int").alias("draw"),
        (F.col("event_id") % 3).cast("int").alias("fold"),
        F.concat(F.lit("point "), point.cast("string")).alias("parameters"),
        F.when(F.col("event_id") % 7 > 0, F.floor(F.col("value") * 1000) / 1000).alias("auc"),
    )
    return rounded(training.rank_trials(trials), "cv_auc", "cv_std")


@query
def model_comparison(i):
    """Three learners over three splits, and that the best of them by out-of-time AUC is one."""
    models = training.fit_models(
        {
            "logistic_regression": lambda: logistic_model(i),
            "random_forest": lambda: training.forest(["embedding_vec"]),
            "boosted_trees": lambda: boosted_model(validation="is_validation"),
        },
        marked_rows(i),
    )
    table = training.compare_models(models, vectors(i), stage=staged(i))
    best = governance.best_model(table.filter("split = 'oot'")).select("model_name").scalar()
    chosen = table.filter(F.col("model_name") == best).select(F.countDistinct("model_name").alias("n")).scalar()
    return checked(table).withColumn("selected_models", chosen)


@query
def search_comparison(i):
    """Random search for three learners over all splits: which have figures everywhere, and how many are selected."""
    bases = {
        "logistic_regression": logistic_model(i),
        "random_forest": training.forest(["embedding_vec"]),
        "boosted_trees": boosted_model(),
    }
    searches = {name: (base, mart.SEARCH_SPACES[name]) for name, base in bases.items()}
    _, table = training.search_models(
        searches, train_rows(i), vectors(i), ["Customer_ID"], i.scratch("trials"), stage=staged(i), draws=2, parallelism=8
    )
    complete = F.lit(True)
    for column in ("cv_auc", "train_auc", "test_auc", "oot_auc"):
        complete = complete & F.coalesce(F.col(column).between(0, 1), F.lit(False))
    selected = table.agg(F.count_if("selected").alias("n")).scalar()
    return table.select("model_name", complete.alias("complete"), selected.alias("selected_models"))


@query
def model_registry(i):
    """Registry row of a trained model, stored next to the model and validated after reading it back."""
    bank, version = i.scratch("bank"), "credit_model_2024_02_01"
    model = logistic_model(i).fit(train_rows(i))
    scored = inference.with_probability(model, vectors(i)).withColumn("period", F.substring(F.md5("Customer_ID"), 1, 1))
    row = training.registry_row(
        scored, version, dt.date(2024, 2, 1), ["embedding_vec"], {"maxIter": 1000}, period="period"
    )
    training.save_model(model, row, bank, version)
    checked = inference.validate_registry(i.spark.read.parquet(f"{bank}/registry"))
    return checked.select(
        "model_file",
        "model_date",
        "status",
        "feature_count",
        "usable",
        F.size("splits").alias("n_splits"),
        F.col("splits")["train"]["rows"].alias("train_rows"),
        F.col("splits")["test"]["rows"].alias("test_rows"),
        F.col("splits")["oot"]["rows"].alias("oot_rows"),
        F.col("splits")["train"]["base_rate"].alias("train_base_rate"),
    )


@query
def reload_check(i):
    bank, version = i.scratch("bank"), "credit_model_2024_02_01"
    model = logistic_model(i).fit(train_rows(i))
    model.write().overwrite().save(f"{bank}/models/{version}")
    return training.reload_check(model, training.load_model(bank, version), vectors(i), ["Customer_ID"])


def monthly_features(i: Inputs) -> DataFrame:
    store = i.clickstream_m.withColumnRenamed("snapshot_date", "feature_snapshot_date")
    names = ["fe_1", "fe_2", "fe_3"]
    return scaling.align_features(store, names, keep=["Customer_ID", "feature_snapshot_date"])


def credit_model(i: Inputs):
    """Logistic default model on monthly features and labels three months later, trained on what was known then."""
    rows = joins.training_set(monthly_features(i), labels(i), day("1998-06-01"))
    known = rows.select("label", "fe_1", "fe_2", "fe_3").persist()
    try:
        return training.logistic(["fe_1", "fe_2", "fe_3"], known.count()).fit(known)
    finally:
        known.unpersist()


@query
def credit_model_by_split(i):
    """Default model on labels left-joined with features: AUC in the training window and out of time."""
    table = joins.labels_with_features(labels(i), i.clickstream_m)
    split = splits.time_split(table, day("1998-09-01"), history_months=36)
    rows = scaling.align_features(split, ["fe_1", "fe_2", "fe_3"], keep=["Customer_ID", "split", "label"])
    model = credit_model(i)
    return checked(training.compare_models({"logistic_regression": model}, rows, stage=staged(i)), floor=0.0)


CLICKS = ["fe_1", "fe_2", "fe_3"]
#: Weights of a stored scorecard, as a bank would hand them over.
SCORECARD = [("fe_1", 0.031), ("fe_2", -0.02), ("fe_3", 0.007), ("fe_9", 5.0), (inference.INTERCEPT, -0.4)]


@query
def score_by_table(i):
    """Every month scored by a table of weights: probability and class."""
    weights = i.spark.createDataFrame(SCORECARD, "feature string, weight double")
    scored = inference.with_linear_score(monthly_features(i), weights, CLICKS)
    positive = measures.positive_class(F.round("model_predictions", 9)).alias("prediction_class")
    return scored.select(
        "Customer_ID", "feature_snapshot_date", F.round("model_predictions", 9).alias("model_predictions"), positive
    )


def by_formula(i: Inputs, model) -> DataFrame:
    """The monthly features with the probability that the model's stored weights give."""
    return inference.with_linear_score(monthly_features(i), inference.coefficient_table(model, CLICKS), CLICKS, "by_table")


def scored_rows(scored: DataFrame) -> DataFrame:
    """Predictions without the number itself, which a fit blurs: whether it is the probability that the table of weights
    gives, and whether the class follows from it."""
    p = F.col("model_predictions")
    same = p.between(0, 1) & (F.abs(p - F.col("by_table")) < 1e-9)
    follows = same & (F.col("prediction_class") == (p > 0.5).cast("int"))
    return scored.withColumn("class_follows", follows).drop("model_predictions", "prediction_class", "by_table")


@query
def score_snapshot(i):
    model = credit_model(i)
    scored = inference.score_snapshot(
        model, by_formula(i, model), day("1998-09-01"), "credit_model_1998_09_01.pkl",
        model_version="credit_model_1998_09_01", keep=("Customer_ID", "by_table"),
    )
    return scored_rows(scored)


@query
def batch_inference(i):
    """Every month of the feature store scored in one job."""
    bounds = i.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    months, model = calendar.calendar(bounds, "a", "b", "monthly"), credit_model(i)
    scored = inference.batch_inference(
        model, by_formula(i, model), months, "credit_model_1998_09_01.pkl", keep=("Customer_ID", "by_table")
    )
    return scored_rows(scored)


@query
def target_resolution(i):
    """The target of a table in which it goes by another name, and its rate per snapshot."""
    renamed = labels(i).withColumnRenamed("label", "default_flag")
    target = scaling.target_column(renamed)
    return renamed.groupBy("snapshot_date").agg(
        F.lit(target).alias("target"), F.count(F.lit(1)).alias("rows"), F.sum(target).alias("positives")
    )


@query
def batch_inference_counts(i):
    """Batch run over the months after training and half a year beyond the data: rows and status per date."""
    bounds = i.orders.agg(day("1998-09-01").alias("a"), F.add_months(F.max("o_orderdate").cast("date"), 6).alias("b"))
    months = calendar.calendar(bounds, "a", "b", "monthly")
    scored = inference.batch_inference(credit_model(i), monthly_features(i), months, "credit_model_1998_09_01.pkl")
    return inference.batch_summary(months, scored).select("snapshot_date", "prediction_count", "status")
