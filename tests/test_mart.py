"""The whole mart from CSV files to a retraining decision, and the model operators on their own."""

import datetime as dt
import json
from functools import reduce

import pytest
from pyspark.sql import functions as F

from creditloom import session
from creditloom.operators import features, inference, order_stats, training
from creditloom.plans import mart as jobs
from creditloom.plans.queries import QUERIES, Inputs, monthly_features, train_rows, vectors
from creditloom.sources import sinks

DAY = dt.date(2000, 6, 1)


@pytest.fixture(scope="module")
def built(spark):
    i = Inputs(spark, "/root/testdata/sf0.01")
    root = session.scratch_dir(spark, "mart")
    inputs = {
        "loans": i.loans,
        "financials": i.financials.drop("row_id"),
        "attributes": i.attributes,
        "clickstream": i.clickstream_m,
    }
    for name, df in inputs.items():
        df.write.option("header", True).csv(f"{root}/source/{name}")
    mart = jobs.Mart(spark, root)
    report = jobs.build_bronze(mart, {n: f"{root}/source/{n}" for n in inputs})
    jobs.build_silver(mart)
    jobs.build_labels(mart)
    jobs.build_features(mart)
    version = jobs.train(mart, DAY, ["logistic_regression", "boosted_trees"], history_months=60, oot_months=12, rounds=5, patience=2)
    return mart, report, version


def test_layers(built):
    mart, report, _ = built
    assert report["loans"] == 60_000 and report["financials"] == 15_000
    store = jobs.feature_store(mart)
    assert store.count() == QUERIES["feature_store"](mart.spark, "/root/testdata/sf0.01").count()
    assert not {"label", "SSN", "Name", "Annual_Income"} & set(store.columns)


def test_backfill_of_a_range_changes_nothing(built):
    mart, *_ = built
    before = mart.read("silver", "loans").groupBy("snapshot_date").count().toPandas().sort_values("snapshot_date")
    jobs.build_silver(mart, ["loans"], "1998-01-01", "1998-06-01")
    after = mart.read("silver", "loans").groupBy("snapshot_date").count().toPandas().sort_values("snapshot_date")
    assert before["count"].tolist() == after["count"].tolist()


def test_registry(built):
    mart, _, version = built
    row = mart.spark.read.parquet(f"{mart.bank}/registry").first()
    assert version == row["model_version"] == "credit_model_2000_06_01"
    assert row["model_file"] == "credit_model_20000601.pkl"
    assert set(row["splits"]) == {"train", "test", "oot"}
    assert 0 <= row["splits"]["oot"]["auc"] <= 1


def test_inference_monitoring_decision(built):
    mart, _, version = built
    summary = jobs.infer(mart, version, dt.date(2000, 1, 1), dt.date(2003, 1, 1))
    statuses = {r["status"].split(":")[0] for r in summary.collect()}
    assert statuses == {"SUCCESS", "FAILED"} and summary.count() == 37
    first = jobs.stored_predictions(mart).count()
    jobs.infer(mart, version, dt.date(2000, 1, 1), dt.date(2003, 1, 1))
    assert jobs.stored_predictions(mart).count() == first > 0

    for _ in range(2):
        jobs.monitor_run(mart, version, dt.date(2001, 1, 1))
    row = mart.read("gold", "model_monitoring").collect()
    assert len(row) == 1 and len(row[0].asDict()) == 19
    assert row[0]["prediction_count"] == first
    document = mart.spark.read.json(mart.path("gold", "governance")).first()
    assert document["governance_sop"]["3_oot_requirements"]["minimum_periods"] == 3
    assert mart.read("gold", "prediction_rollup").agg(F.sum("n")).first()[0] == first
    assert mart.spark.read.schema("path string, snapshot_date date").parquet(mart.path("gold", "skipped_files")).count() == 0
    decided = jobs.decide(mart, dt.date(2001, 1, 1), epoch=dt.date(1999, 1, 1)).first()
    assert decided["model_file"] == "credit_model_20000601.pkl"


def test_a_month_that_reorders_categories_changes_no_score(built):
    """Rebuilt features index categories anew; the model goes on with the transformers it was trained with."""
    mart, _, version = built
    jobs.infer(mart, version, dt.date(2000, 1, 1), dt.date(2000, 4, 1))
    keys = ["Customer_ID", "feature_snapshot_date"]

    def scores():
        rows = jobs.stored_predictions(mart).filter("snapshot_date BETWEEN '2000-01-01' AND '2000-04-01'")
        return sorted((str(r[0]), str(r[1]), r[2]) for r in rows.select(*keys, "prediction_probability").collect())

    def order():
        whole = features.fit_sources(jobs.matched_sources(mart)).encoder
        return {r["value"]: r["index"] for r in whole.table.filter("name = 'Credit_Mix'").collect()}

    before, first_order = scores(), order()
    rarest = max(first_order, key=first_order.get)
    silver = mart.read("silver", "financials")
    late = silver.filter("snapshot_date >= '1999-01-01'").withColumn("Credit_Mix", F.lit(rarest))
    new = sinks.materialise(
        reduce(lambda a, b: a.unionByName(b), [late] * 5).withColumn("snapshot_date", F.lit("2000-02-01").cast("date")),
        session.scratch_dir(mart.spark, "new-month"),
    )
    matching = mart.read("silver", "loans").withColumns({"snapshot_date": F.lit("2000-05-01").cast("date"), "mob": F.lit(3)})
    kept = {n: sinks.materialise(mart.read("silver", n), session.scratch_dir(mart.spark, n)) for n in ("financials", "loans")}
    try:
        sinks.write_snapshots(kept["financials"].withColumn("snapshot_date", F.col("snapshot_date").cast("date")).unionByName(new), mart.path("silver", "financials"), rebuild=True)
        loans = sinks.materialise(matching.dropDuplicates(["Customer_ID"]), session.scratch_dir(mart.spark, "loans"))
        sinks.write_snapshots(loans, mart.path("silver", "loans"))
        jobs.build_features(mart)
        assert order()[rarest] == 0 != first_order[rarest]
        jobs.infer(mart, version, dt.date(2000, 1, 1), dt.date(2000, 4, 1))
        again = scores()
        same = {row for row in again if row[1] != "2000-02-01"}
        assert same == {row for row in before if row[1] != "2000-02-01"} and same
    finally:
        for name, df in kept.items():
            sinks.write_snapshots(df, mart.path("silver", name), rebuild=True)
        jobs.build_features(mart)


def test_transformers_of_another_model_are_refused(built):
    mart, _, version = built
    path = f"{mart.bank}/transformers/{version}"
    sizes = features.Fitted.load(mart.spark, path).encoder.sizes
    with pytest.raises(ValueError, match="categories"):
        features.Fitted.load(mart.spark, path, {**sizes, "Credit_Mix": 99})


def test_search_in_the_job_goes_on_with_stored_trials(built):
    mart, *_ = built
    options = {"history_months": 60, "oot_months": 12, "learners": ["logistic_regression"], "draws": 2, "folds": 2}
    version = jobs.train(mart, dt.date(2000, 5, 1), **options)
    trials = mart.spark.read.schema(training.TRIALS).option("recursiveFileLookup", True).parquet(f"{mart.bank}/trials/{version}")
    assert trials.count() == 4
    row = mart.spark.read.parquet(f"{mart.bank}/registry").filter(F.col("model_version") == version).first()
    chosen = json.loads(json.loads(row["hyper_parameters"])["search"]["logistic_regression"])
    assert set(chosen) == {"regParam", "elasticNetParam"}
    sinks.write_snapshots(
        sinks.materialise(mart.spark.read.parquet(f"{mart.bank}/registry").filter(F.col("model_version") != version), session.scratch_dir(mart.spark, "r")),
        f"{mart.bank}/registry", "model_version", rebuild=True,
    )


def test_unreadable_and_archived_models(built, monkeypatch):
    mart, _, version = built
    row = mart.spark.read.parquet(f"{mart.bank}/registry")
    for year in (1996, 1997, 1998):
        other = row.filter(F.col("model_version") == version).withColumns(
            {
                "model_version": F.lit(f"credit_model_{year}_06_01"),
                "model_file": F.lit(f"credit_model_{year}0601.pkl"),
                "model_date": F.lit(f"{year}-06-01").cast("date"),
            }
        )
        jobs.sinks.write_snapshots(other, f"{mart.bank}/registry", "model_version")
    readable = {r["model_file"]: jobs._readable(mart, r["model_version"]) for r in jobs.registry(mart).collect()}
    assert readable.pop("credit_model_20000601.pkl") and not any(readable.values()) and len(readable) == 3
    decided = jobs.decide(mart, dt.date(1999, 1, 1), epoch=dt.date(1990, 1, 1)).first()
    assert (decided["reason"], decided["decision"]) == ("unreadable_model", "retrain")
    loaded = []
    monkeypatch.setattr(jobs, "_readable", lambda mart, v, check=jobs._readable: loaded.append(v) or check(mart, v))
    jobs.decide(mart, dt.date(1997, 1, 1), epoch=dt.date(1990, 1, 1)).collect()
    assert loaded == ["credit_model_1996_06_01"]  # the one candidate of that day
    status = {r["model_file"]: r["status"] for r in jobs.retain(mart, on=dt.date(1996, 12, 1)).collect()}
    archived = jobs.decide(mart, dt.date(1997, 1, 1), epoch=dt.date(1990, 1, 1)).first()
    assert (archived["model_file"], archived["reason"]) == (None, "no_previous_model")
    before = jobs.decide(mart, dt.date(1996, 11, 1), epoch=dt.date(1990, 1, 1)).first()
    assert before["model_file"] == "credit_model_19960601.pkl"
    assert status.pop("credit_model_19960601.pkl") == "archived" and set(status.values()) == {"active"} and len(status) == 3


def test_scoring_an_empty_date_is_an_error(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    with pytest.raises(ValueError, match="no feature data"):
        inference.score_snapshot(None, monthly_features(i), F.lit("1980-01-01").cast("date"), "m.pkl")


def test_failing_learners_are_left_out(spark, sf_dir):
    i = Inputs(spark, sf_dir)

    def broken():
        raise RuntimeError("no")

    good = {"good": lambda: training.logistic(["embedding_vec"], 300, max_iter=5), "bad": broken}
    failed = {}
    models = training.fit_models(good, train_rows(i), failed)
    assert set(models) == {"good"} and set(failed) == {"bad"}
    rows = training.compare_models(models, vectors(i), failed=failed).collect()
    assert {r["model_name"]: r["auc"] is None for r in rows} == {"good": False, "bad": True}
    with pytest.raises(ValueError):
        training.fit_models({"bad": broken}, train_rows(i))


@pytest.mark.parametrize(
    ("losses", "patience", "kept"),
    [([5, 4, 3], 2, (3, False)), ([5, 4, 4.5, 4.4, 3], 2, (2, True)), ([5, 4, 4.5, 4.4, 3], 3, (5, False)), ([1, 2, 3, 4], 3, (1, True))],
)
def test_best_prefix(losses, patience, kept):
    assert training.best_prefix(losses, patience) == kept


def test_patience_looks_beyond_a_worse_round(spark, sf_dir):
    """Where a round worsens and a later one improves, the later prefix is kept; it equals a plain run of that length."""
    df = spark.range(600).select(
        F.col("id").cast("string").alias("k"), F.rand(6).alias("a"), F.rand(7).alias("b"), F.rand(8).alias("u")
    ).withColumn("label", (F.col("a") + F.col("b") * F.col("a") + F.col("u") > 1.2).cast("int"))
    rows = training.with_validation(df, ["k"], share=0.3).persist()
    options = {"rate": 0.3, "depth": 2, "rounds": 24}
    whole = training.boosted(["a", "b"], **options).fit(rows.filter("NOT is_validation"))
    held = whole.stages[0].transform(rows.filter("is_validation"))
    losses = whole.stages[-1].evaluateEachIteration(held)
    for patience in (1, 4, 24):
        kept, _ = training.best_prefix(losses, patience)
        model = training.boosted(["a", "b"], **options, validation="is_validation", patience=patience).fit(rows)
        assert model.stages[-1].getNumTrees == kept
        assert model.stages[-1].evaluateEachIteration(held) == pytest.approx(losses[:kept])
    at = {p: training.best_prefix(losses, p)[0] for p in (1, 24)}
    assert losses[at[24] - 1] == min(losses) and losses[at[1]] >= losses[at[1] - 1]
    assert at[24] > at[1]  # these losses do worsen and improve again


def test_trials_are_resumed_and_failures_tried_again(spark, sf_dir, monkeypatch):
    rows = train_rows(Inputs(spark, sf_dir))
    space = {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 1.0]}
    path = f"{session.scratch_dir(spark, 'trials')}"
    searches = {"logistic_regression": (training.logistic(["embedding_vec"], 100, max_iter=3), space)}
    fits = []
    fit = training.Pipeline.fit

    def counted(self, df, params=None):
        fits.append(params)
        if len(fits) == 2:
            raise RuntimeError("lost")
        return fit(self, df, params)

    monkeypatch.setattr(training.Pipeline, "fit", counted)
    run = lambda draws: training.run_trials(searches, rows, ["Customer_ID"], path, draws=draws, folds=2, parallelism=1)
    first = run(2)
    assert first.count() == 4 and first.filter("auc IS NULL AND error = 'lost'").count() == 1 and len(fits) == 4
    assert training.rank_trials(first, 2).count() == 1
    second = run(3)
    assert len(fits) == 4 + 1 + 2 and second.count() == 6 and second.filter("auc IS NULL").count() == 0
    assert run(3).count() == 6 and len(fits) == 7
    ranked = training.rank_trials(second, 2).collect()
    plain = {}
    for t in second.collect():
        plain.setdefault(t["draw"], []).append(t["auc"])
    means = {d: sum(a) / 2 for d, a in plain.items()}
    assert [r["draw"] for r in sorted(ranked, key=lambda r: r["place"])] == sorted(means, key=lambda d: (-means[d], d))
    assert [r["place"] for r in ranked if r["best"]] == [1]


def test_draws_repeat_and_differ():
    space = {"maxIter": [1, 2, 3], "maxDepth": [2, 3], "stepSize": [0.1, 0.2]}
    draws = training.draw_grid(training.boosted(["f"]), space, 8)
    again = training.draw_grid(training.boosted(["f"]), space, 8)
    plain = [sorted((p.name, v) for p, v in d.items()) for d in draws]
    assert plain == [sorted((p.name, v) for p, v in d.items()) for d in again]
    assert len({str(p) for p in plain}) == 8
    assert len(training.draw_grid(training.boosted(["f"]), space, 100)) == 12


def test_splits_are_independent_of_folds(spark, sf_dir):
    df = vectors(Inputs(spark, sf_dir)).withColumn(
        "fold", F.floor(order_stats.hash_fraction("Customer_ID", seed="fold 42") * 3)
    )
    assert df.groupBy("split", "fold").count().count() == 9


def test_registry_without_fields_is_refused(spark):
    with pytest.raises(ValueError, match="feature_columns"):
        inference.validate_registry(spark.range(1).selectExpr("'v' AS model_version"))
