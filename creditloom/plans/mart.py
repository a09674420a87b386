"""Jobs over a data mart folder: ingest, silver, gold, training, inference, monitoring, retraining.

Each job reads stores, calls lazy operators and writes one store per result.  A job handles any number of snapshots
at once; running it again for a snapshot replaces that snapshot.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import session
from creditloom.functions import calendar
from creditloom.operators import features, governance, inference, joins, ledger, monitoring, scaling, silver, splits, training
from creditloom.plans.monitor import monitor
from creditloom.sources import ingest, scans, sinks, stores

log = logging.getLogger(__name__)
CLEANERS = {
    "financials": silver.clean_financials,
    "attributes": silver.clean_attributes,
    "clickstream": silver.clean_clickstream,
    "loans": silver.clean_loans,
}
#: Share of a model's features above which their absence is reported.
MISSING_LIMIT = 0.1


@dataclass(frozen=True)
class Mart:
    """Where the stores of one mart live."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str = "") -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}".rstrip("/")

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    @property
    def bank(self) -> str:
        return self.path("model_bank")


def build_bronze(mart: Mart, sources: Mapping[str, str], only: str | None = None) -> dict[str, int | None]:
    return ingest.ingest_bronze(mart.spark, sources, mart.path("bronze"), only)


def build_silver(
    mart: Mart,
    names: Sequence[str] = tuple(CLEANERS),
    start: str | None = None,
    end: str | None = None,
    single_precision_ledger: bool = False,
) -> None:
    """Clean whole sources, which replaces their tables, or only the snapshots between two dates, which replaces those
    (a back-fill of that range in one job)."""
    cleaners = CLEANERS | ({"loans": silver.clean_loans_single_precision} if single_precision_ledger else {})
    for name in names:
        bronze = mart.read("bronze", name)
        if start is not None and end is not None:
            bronze = scans.snapshot_range(bronze, start, end)
        whole = start is None or end is None
        sinks.write_snapshots(cleaners[name](bronze), mart.path("silver", name), rebuild=whole)


def build_labels(mart: Mart, dpd: int = 30, mob: int = 3) -> None:
    labels = ledger.label_store(mart.read("silver", "loans"), dpd, mob)
    sinks.write_snapshots(labels, mart.path("gold", "label_store"), rebuild=True)


SOURCES = {"financials": "financials", "attributes": "attributes", "clicks": "clickstream"}


def build_features(mart: Mart, dpd: int = 30, mob: int = 3) -> None:
    """Match the sources with their labels and store them, then the feature store over them.

    The feature store is fitted on all its rows.  Models do not read it: they fit and store their own transformers on the
    matched sources, see ``train``."""
    labels = sinks.materialise(
        ledger.label_store(mart.read("silver", "loans"), dpd, mob), session.scratch_dir(mart.spark, "labels")
    )

    def store(df: DataFrame, name: str) -> DataFrame:
        sinks.write_snapshots(df, mart.path("gold", f"matched/{name}"), "feature_snapshot_date", rebuild=True)
        return mart.read("gold", f"matched/{name}")

    sources = {name: mart.read("silver", table) for name, table in SOURCES.items()}
    matched = features.match_sources(sources, labels, mob, store)
    whole = features.assemble(matched, features.fit_sources(matched))
    sinks.write_snapshots(whole, mart.path("gold", "feature_store"), "feature_snapshot_date", rebuild=True)
    sinks.write_table(joins.repeated_slices(sources), mart.path("gold", "repeated_slices"))


def feature_store(mart: Mart) -> DataFrame:
    return mart.read("gold", "feature_store")


def matched_sources(mart: Mart) -> dict[str, DataFrame]:
    """Matched sources with dates in the type that partition names lose."""
    return {
        name: mart.read("gold", f"matched/{name}").withColumn("feature_snapshot_date", F.col("feature_snapshot_date").cast("date"))
        for name in SOURCES
    }


#: Grid of the job's random search: each learner's parameters by their Spark names.
SEARCH_SPACES = {
    "logistic_regression": {"regParam": [0.0001, 0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "random_forest": {"numTrees": [25, 50, 100], "maxDepth": [2, 3, 5], "minInstancesPerNode": [1, 3, 5]},
    "boosted_trees": {
        "maxIter": [25, 50],
        "maxDepth": [2, 3],
        "stepSize": [0.01, 0.1],
        "subsamplingRate": [0.6, 0.8],
        "featureSubsetStrategy": ["0.6", "0.8"],
        "minInfoGain": [0.0, 0.1],
        "minInstancesPerNode": [1, 3, 5],
    },
}


def train(
    mart: Mart,
    train_date: dt.date,
    learners: Sequence[str] = ("logistic_regression", "random_forest", "boosted_trees", "neural_network"),
    history_months: int = 12,
    oot_months: int = 2,
    months: int = 3,
    rounds: int = 2000,
    patience: int = 50,
    draws: int = 0,
    folds: int = 3,
) -> str:
    """Train the learners on what was known at ``train_date``, store the best by out-of-time AUC, return its version.

    Medians, caps and categories are fitted on the training window alone and stored with the model.  Feature dates before
    the out-of-time window are split 80/20 into train and test, each label by itself; the out-of-time rows are rated over
    three equal parts.  A learner that fails is reported and left out.

    With ``draws``, learners that have a grid in ``SEARCH_SPACES`` come from a random search of so many points over
    ``folds`` folds; its trials stay in the model bank, so a search that broke off goes on where it was.
    """
    today, version = F.lit(train_date), f"credit_model_{train_date:%Y_%m_%d}"
    matched = matched_sources(mart)
    bounds = calendar.training_windows(F.add_months(today, -months), history_months, oot_months)
    known_then = F.col("feature_snapshot_date").between(bounds["train_start"], bounds["train_end"])
    transformers = f"{mart.bank}/transformers/{version}"
    features.fit_sources({name: df.filter(known_then) for name, df in matched.items()}).save(transformers)
    fitted = features.Fitted.load(mart.spark, transformers)
    store = features.assemble(matched, fitted)
    numbers, vectors = scaling.numeric_columns(store), scaling.vector_columns(store)
    rows = joins.training_set(store, mart.read("gold", "label_store"), today, months)
    dated = splits.time_split(
        rows, F.add_months(today, -months), "feature_snapshot_date", history_months=history_months, oot_months=oot_months
    )
    keys = ["Customer_ID", joins.LOAN, "feature_snapshot_date"]
    side = F.when(F.col("split") == "oot", "oot").otherwise(F.col("side"))
    target = scaling.target_column(dated)
    windowed = dated.withColumnRenamed(target, "label").withColumnRenamed("split", "window")
    sided = splits.stratified_split(windowed, keys).withColumnsRenamed({"split": "side", "window": "split"})
    table = sinks.materialise(
        training.with_validation(
            scaling.model_matrix(sided.withColumn("split", side), numbers, vectors, [*keys, "split", "label"]), keys
        ),
        session.scratch_dir(mart.spark, "training"),
    )
    known = table.filter("split = 'train'")
    columns = [*numbers, *vectors]
    width = len(numbers) + sum(max(n, 1) for n in fitted.encoder.sizes.values())
    makers = {
        "logistic_regression": lambda: training.logistic(columns, known.count()),
        "random_forest": lambda: training.forest(columns),
        "boosted_trees": lambda: training.boosted(columns, rounds=rounds, validation="is_validation", patience=patience),
        "neural_network": lambda: training.perceptron(columns, width),
    }
    folder = session.scratch_dir(mart.spark, "scores")
    stage = lambda df, name: sinks.materialise(df, f"{folder}/{name}")
    searched = [name for name in learners if draws and name in SEARCH_SPACES]
    models, parameters = {}, {"rounds": rounds, "patience": patience}
    if searched:
        bases = makers | {"boosted_trees": lambda: training.boosted(columns)}
        models, results = training.search_models(
            {name: (bases[name](), SEARCH_SPACES[name]) for name in searched},
            known, table, keys, f"{mart.bank}/trials/{version}", stage=lambda df, name: stage(df, f"search-{name}"),
            draws=draws, folds=folds,
        )
        parameters["search"] = {r["model_name"]: r["best_parameters"] for r in results.collect()}
    rest = {name: makers[name] for name in learners if name not in searched}
    if rest:
        models |= training.fit_models(rest, known)
    quality = training.compare_models(models, table, stage=stage)
    best = governance.best_model(quality.filter("split = 'oot'")).first()
    name = best["model_name"] if best else next(iter(models))
    scored = stage(inference.with_probability(models[name], table).drop(*columns), "best")
    thirds = splits.equal_parts(scored.filter("split = 'oot'"), keys)
    row = training.registry_row(
        scored, version, train_date, columns, {"learner": name, **parameters}, period="part", oot=thirds
    ).withColumns(
        {
            "model_file": F.lit(f"credit_model_{train_date:%Y%m%d}.pkl"),
            "transformers": F.lit(transformers),
            "categories": F.create_map(*[F.lit(x) for pair in fitted.encoder.sizes.items() for x in pair]),
        }
    )
    training.save_model(models[name], row, mart.bank, version)
    session.remove(mart.spark, folder)
    return version


def registry(mart: Mart) -> DataFrame:
    """Model registry in the form the retraining rules read; whether a model loads is left open."""
    stored = mart.spark.read.option("mergeSchema", True).parquet(f"{mart.bank}/registry")
    archived = F.col("archived_date") if "archived_date" in stored.columns else F.lit(None).cast("date")
    return stored.select(
        "model_version", "model_file", "model_date", F.col("oot_avg").alias("auc"), F.col("oot_cv").alias("cv"),
        archived.alias("archived_date"), F.lit(True).alias("readable"),
    )


def _readable(mart: Mart, version: str) -> bool:
    try:
        training.load_model(mart.bank, version)
    except Exception as error:  # noqa: BLE001 - whatever keeps a model from loading makes it unreadable
        log.warning("model %s cannot be read: %s", version, str(error)[:200])
        return False
    return True


def retain(mart: Mart, keep: int = 3, on: dt.date | None = None) -> DataFrame:
    """Mark all but the newest ``keep`` models of the registry as archived on a date (today) and return the registry.  A
    model that was archived before keeps its date; one that is kept again is active again."""
    path = f"{mart.bank}/registry"
    merged = mart.spark.read.option("mergeSchema", True).parquet(path)  # older rows may lack later fields
    stored = sinks.materialise(merged, session.scratch_dir(mart.spark, "registry"))
    judged = governance.retention(stored.select("model_version", "model_file"), keep)
    goes = F.col("kept") == "archived"
    since = F.col("archived_date") if "archived_date" in stored.columns else F.lit(None).cast("date")
    day = F.current_date() if on is None else F.lit(on)
    rows = stored.drop("status").join(judged.select("model_version", F.col("status").alias("kept")), "model_version", "left")
    rows = rows.withColumns(
        {"status": F.when(goes, "archived").otherwise("active"), "archived_date": F.when(goes, F.coalesce(since, day))}
    )
    sinks.write_snapshots(rows.drop("kept"), path, "model_version")
    return mart.spark.read.option("mergeSchema", True).parquet(path)


def _matrix(mart: Mart, version: str) -> tuple[PipelineModel, DataFrame]:
    """The model and its matrix over the matched sources, made by the transformers stored with it."""
    row = inference.validate_registry(mart.spark.read.parquet(f"{mart.bank}/registry")).filter(
        F.col("model_version") == version
    ).first()
    if row is None or not row["usable"]:
        raise ValueError(f"no usable model {version}")
    fitted = features.Fitted.load(mart.spark, row["transformers"], row["categories"])
    store = features.assemble(matched_sources(mart), fitted)
    wanted = list(row["feature_columns"])
    share = scaling.missing_ratio(store, wanted)
    if share > MISSING_LIMIT:
        log.warning("%s lacks %.0f %% of its features: %s", version, 100 * share, scaling.missing_features(store, wanted))
    vectors = [c for c in wanted if c in scaling.vector_columns(store)]
    numbers = [c for c in wanted if c not in vectors]
    matrix = scaling.model_matrix(store, numbers, vectors, ["Customer_ID", "feature_snapshot_date"])
    return training.load_model(mart.bank, version), matrix


def infer(mart: Mart, version: str, start: dt.date, end: dt.date | None = None, frequency: str = "monthly") -> DataFrame:
    """Score all calendar dates, store predictions per model and date, append the run's summary and return it."""
    model, matrix = _matrix(mart, version)
    first = F.lit(start)
    last = calendar.batch_end(first) if end is None else F.lit(end)
    dates = mart.spark.range(1).select(F.explode(calendar.dates_between(first, last, frequency)).alias("snapshot_date"))
    scored = inference.batch_inference(model, matrix, dates, f"{version}.pkl", model_version=version)
    path = mart.path("gold", "model_predictions")
    sinks.write_snapshots(scored, path, ["model_name", "snapshot_date"])
    run = stored_predictions(mart, f"{version}.pkl").filter(F.col("snapshot_date").between(first, last))
    rolled = monitoring.rollup(run, by=["model_name"])
    sinks.write_snapshots(rolled, mart.path("gold", "prediction_rollup"), ["model_name", "snapshot_date"])
    stored = stored_predictions(mart, f"{version}.pkl").withColumnRenamed("prediction_probability", "model_predictions")
    summary = inference.with_run(inference.batch_summary(dates, stored), first, last, frequency)
    sinks.append_run(summary, mart.path("gold", "batch_inference_summary"))
    return summary


def stored_predictions(mart: Mart, model_name: str | None = None) -> DataFrame:
    df = stores.reconcile(mart.read("gold", "model_predictions")).withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date")
    )
    return df if model_name is None else df.filter(F.col("model_name") == model_name)


def monitor_run(mart: Mart, version: str, run_date: dt.date) -> None:
    """Monitoring row, governance document and the prediction files that could not be read, of one date.

    The rollup that scoring stored gives all but the rows where the drift halves meet."""
    rolled = mart.read("gold", "prediction_rollup").filter(F.col("model_name") == f"{version}.pkl")
    skipped = stores.skipped_files(mart.spark, mart.path("gold", "model_predictions"))
    sinks.write_snapshots(skipped.withColumn("snapshot_date", F.lit(run_date)), mart.path("gold", "skipped_files"))
    oot = mart.spark.read.parquet(f"{mart.bank}/registry").filter(F.col("model_version") == version).select(
        inference.oot_rating(F.col("oot_cv")).alias("stability_rating"), F.col("oot_cv").alias("coefficient_of_variation")
    )
    folder = session.scratch_dir(mart.spark, "monitor")
    row, document = monitor(
        stored_predictions(mart, f"{version}.pkl"),
        F.lit(run_date),
        f"{version}.pkl",
        oot=oot,
        rolled=rolled.withColumn("snapshot_date", F.col("snapshot_date").cast("date")),
        stage=lambda df, name: sinks.materialise(df, f"{folder}/{name}"),
    )
    sinks.write_snapshots(row, mart.path("gold", "model_monitoring"))
    sinks.write_documents(document, mart.path("gold", "governance"), "snapshot_date")
    session.remove(mart.spark, folder)


def decide(mart: Mart, execution_date: dt.date, epoch: dt.date = governance.EPOCH) -> DataFrame:
    """Retraining decision of one execution date, over the registry as it was then.  Only the model it judges is loaded."""
    dates = mart.spark.range(1).select(F.lit(execution_date).alias("execution_date"))
    models = registry(mart)
    candidate = governance.models_as_of(dates, models).join(models.select("model_file", "model_version"), "model_file").first()
    if candidate is not None and not _readable(mart, candidate["model_version"]):
        models = models.withColumn("readable", F.col("model_version") != candidate["model_version"])
    return governance.retraining_decision(dates, models.drop("model_version"), epoch=epoch)
