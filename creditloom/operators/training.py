"""Distributed training, search and comparison of default models with Spark ML."""

from __future__ import annotations

import datetime as dt
import json
import logging
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from math import prod

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.operators import order_stats
from creditloom.operators.governance import best_model
from creditloom.operators.inference import with_probability
from creditloom.operators.ledger import base_rates

log = logging.getLogger(__name__)
LABEL = "label"


# --- estimators -------------------------------------------------------------------------------------------------


def assembled(columns: Sequence[str], classifier: Estimator, scaled: bool = False) -> Pipeline:
    """Feature columns (numbers or vectors) to a fitted classifier; scaling is part of the model."""
    stages = [VectorAssembler(inputCols=list(columns), outputCol="raw_features")]
    if scaled:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    else:
        classifier = classifier.setFeaturesCol("raw_features")
    return Pipeline(stages=[*stages, classifier])


def logistic(columns: Sequence[str], rows: int, max_iter: int = 1000) -> Pipeline:
    """Ridge-penalised logistic regression on standardised input.  A unit penalty on the summed loss is 1 / rows on
    Spark's mean loss.  Spark standardises by the sample's deviation; the factor (rows - 1) / rows makes the penalty, and so
    the model, that of the population's deviation, which ``scaling.fit_scaler`` uses as well."""
    penalty = max(rows - 1, 1) / max(rows, 1) ** 2
    model = LogisticRegression(labelCol=LABEL, maxIter=max_iter, regParam=penalty, standardization=False)
    return assembled(columns, model, scaled=True)


def forest(columns: Sequence[str], trees: int = 100, depth: int = 5, seed: int = 42) -> Pipeline:
    return assembled(columns, RandomForestClassifier(labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed))


def best_prefix(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many rounds to keep, up to the smallest loss before ``patience`` rounds in a row failed to improve on it, and
    whether patience ran out."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


class PatientBooster(Estimator):
    """Boosted trees that keep the best prefix of their rounds on the rows a boolean column marks.

    Every round is rated on those rows (``evaluateEachIteration``).  Rounds are fitted in growing runs, each twice as long
    as the last; as the seed fixes the rounds, a longer run begins with the shorter one's, so the result is that of one run
    over all rounds while what lies far behind the best round is never fitted.
    """

    def __init__(self, booster: GBTClassifier, validation: str, patience: int = 50):
        super().__init__()
        self.booster, self.validation, self.patience = booster, validation, patience

    def copy(self, extra=None) -> PatientBooster:
        return PatientBooster(self.booster.copy(extra), self.validation, self.patience)

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        held = dataset.filter(F.col(self.validation)).persist()
        known = dataset.filter(~F.col(self.validation)).persist()
        try:
            if held.isEmpty():
                raise ValueError("no validation rows")
            limit, rounds = self.booster.getMaxIter(), min(self.booster.getMaxIter(), 2 * self.patience)
            while True:
                model = self.booster.copy({self.booster.maxIter: rounds}).fit(known)
                kept, stopped = best_prefix(model.evaluateEachIteration(held), self.patience)
                if stopped or rounds == limit:
                    return _first_trees(model, kept)
                rounds = min(limit, 2 * rounds)
        finally:
            held.unpersist()
            known.unpersist()


def _first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first rounds, with their weights."""
    if rounds == model.getNumTrees:
        return model
    jvm, java = SparkContext._active_spark_context._gateway, model._java_obj
    kind = jvm.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = jvm.new_array(kind, rounds), jvm.new_array(jvm.jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = java.trees()[k], float(model.treeWeights[k])
    cut = jvm.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), 2
    )
    shorter = GBTClassificationModel(cut)
    shorter._resetUid(model.uid)
    shorter = model._copyValues(shorter)
    shorter._transfer_params_to_java()
    return shorter


def boosted(
    columns: Sequence[str],
    rounds: int = 2000,
    depth: int = 4,
    rate: float = 0.03,
    subsample: float = 0.6,
    column_share: float = 0.6,
    min_leaf: int = 1,
    seed: int = 88,
    validation: str | None = None,
    patience: int = 50,
) -> Pipeline:
    """Boosted trees.  With a boolean ``validation`` column, the best prefix of the rounds on its rows is kept, and rounds
    end once ``patience`` of them have not improved on it."""
    model = GBTClassifier(
        labelCol=LABEL,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(column_share),
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    if validation is None:
        return assembled(columns, model)
    stages = assembled(columns, model).getStages()
    return Pipeline(stages=[*stages[:-1], PatientBooster(stages[-1], validation, patience)])


def perceptron(columns: Sequence[str], width: int, hidden: Sequence[int] = (100, 50), max_iter: int = 500) -> Pipeline:
    """Neural net on standardised input of ``width`` numbers."""
    model = MultilayerPerceptronClassifier(labelCol=LABEL, layers=[width, *hidden, 2], maxIter=max_iter, seed=42)
    return assembled(columns, model, scaled=True)


def with_validation(df: DataFrame, keys: Sequence[str], share: float = 0.1, name: str = "is_validation") -> DataFrame:
    """Mark a repeatable share of the training rows for early stopping, independent of other hash splits."""
    return df.withColumn(name, order_stats.hash_fraction(*keys, seed="validation") < share)


# --- fitting several models -------------------------------------------------------------------------------------

#: Fewer rows are not worth a task of their own, more do not belong in one.
LEAST_ROWS, MOST_ROWS = 2_000, 200_000


def spread(train: DataFrame) -> DataFrame:
    """The same rows, dealt evenly over the cores.

    Learners pass over their rows hundreds of times, and a pass takes as long as its largest task.  A scan makes one task
    of a Parquet row group, so training rows straight from a file may keep a single core busy.
    """
    rows, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    if rows <= LEAST_ROWS:
        return train
    return train.repartition(min(-(-rows // LEAST_ROWS), cores * -(-rows // (cores * MOST_ROWS))))


def fit_models(
    estimators: Mapping[str, Callable[[], Estimator]], train: DataFrame, failed: dict[str, str] | None = None
) -> dict[str, PipelineModel]:
    """Fit each model on the same rows; one that fails is reported, noted in ``failed`` and left out."""
    models = {}
    train = spread(train).persist()
    try:
        for name, make in estimators.items():
            try:
                models[name] = make().fit(train)
            except Exception as error:  # noqa: BLE001 - any learner may fail, the others go on
                log.error("training %s failed: %s", name, error)
                if failed is not None:
                    failed[name] = str(error)
    finally:
        train.unpersist()
    if not models:
        raise ValueError("no model could be trained")
    return models


def compare_models(
    models: Mapping[str, PipelineModel],
    df: DataFrame,
    by: Sequence[str] = ("split",),
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    failed: Mapping[str, str] | None = None,
) -> DataFrame:
    """AUC and Gini of every model on every split, in one aggregation over all scores; each learner in ``failed`` has
    a row without figures.

    The scores are read twice (for cut points, then for ranks); ``stage(df, name)`` may store them in between, so that
    scoring itself happens once.
    """
    scored = [
        with_probability(model, df).select(F.lit(name).alias("model_name"), *by, LABEL, "model_predictions")
        for name, model in models.items()
    ]
    scores = stage(reduce(DataFrame.unionByName, scored), "scores")
    quality = order_stats.auc(scores, "model_predictions", LABEL, by=["model_name", *by])
    if not failed:
        return quality
    missing = df.sparkSession.createDataFrame([(name,) for name in failed], "model_name string")
    return quality.unionByName(missing, allowMissingColumns=True)


# --- random search ----------------------------------------------------------------------------------------------


def draw_grid(estimator: Estimator, space: Mapping[str, Sequence], draws: int, seed: int = 42) -> list[dict]:
    """``draws`` different points of a parameter grid, repeatably.  The grid itself is never built.

    Names refer to parameters of the classifier, the last stage of the pipeline.
    """
    classifier = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    names, sizes = list(space), [len(space[n]) for n in space]
    points = []
    for index in random.Random(seed).sample(range(prod(sizes)), min(draws, prod(sizes))):
        point = {}
        for name, size in zip(names, sizes):
            index, at = divmod(index, size)
            point[classifier.getParam(name)] = space[name][at]
        points.append(point)
    return points


TRIALS = "learner string, draw int, fold int, parameters string, auc double, error string"


def run_trials(
    searches: Mapping[str, tuple[Estimator, Mapping[str, Sequence]]],
    train: DataFrame,
    keys: Sequence[str],
    path: str,
    draws: int = 100,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """Fill the trial table at ``path`` (learner, drawn point, fold, AUC on the fold left out) and return it.

    Each trial is stored as soon as it is rated, so a search that was interrupted goes on with the trials that are missing
    and a finished one costs nothing.  A trial that fails is stored with its error and tried again by the next run.  Folds
    and draws follow hashes and the seed, so all runs mean the same trials by the same names.
    """
    spark = train.sparkSession
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC", numBins=0)
    fold_of = F.floor(order_stats.hash_fraction(*keys, seed=f"fold {seed}") * folds).cast("int")
    folded = spread(train).withColumn("__fold", fold_of).persist()
    points = {name: draw_grid(estimator, space, draws, seed) for name, (estimator, space) in searches.items()}
    shown = {n: [json.dumps({p.name: v for p, v in point.items()}, sort_keys=True) for point in of] for n, of in points.items()}
    done = {tuple(r) for r in _trials(spark, path).filter("auc IS NOT NULL").select("learner", "draw", "fold", "parameters").collect()}
    wanted = [(n, d, f) for n in searches for d in range(len(points[n])) for f in range(folds) if (n, d, f, shown[n][d]) not in done]

    def rate(trial: tuple[str, int, int]) -> None:
        name, draw, fold = trial
        auc, error = None, None
        try:
            model = searches[name][0].fit(folded.filter(F.col("__fold") != fold), points[name][draw])
            auc = float(evaluator.evaluate(model.transform(folded.filter(F.col("__fold") == fold))))
        except Exception as failure:  # noqa: BLE001 - one trial may fail, the others go on
            log.error("trial %s failed: %s", trial, failure)
            error = str(failure)[:500]
        row = (name, draw, fold, shown[name][draw], auc, error)
        # A folder of its own: jobs that write one folder at the same time would commit each other's files.
        spark.createDataFrame([row], TRIALS).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}/{draw}/{fold}")

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            list(pool.map(inheritable_thread_target(spark)(rate), wanted))
    finally:
        folded.unpersist()
    return _trials(spark, path)


def _trials(spark: SparkSession, path: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], TRIALS)
    return spark.read.schema(TRIALS).option("recursiveFileLookup", True).parquet(path)


def rank_trials(trials: DataFrame, folds: int = 3) -> DataFrame:
    """One row per learner and drawn point that was rated on all folds: mean AUC, its spread, the place within the learner
    (ties by draw) and whether it is the learner's best."""
    # One rating per trial, should a table hold a repeated one.
    rated = trials.filter("auc IS NOT NULL").groupBy("learner", "draw", "parameters", "fold").agg(F.max("auc").alias("auc"))
    means = (
        rated.groupBy("learner", "draw", "parameters")
        .agg(F.avg("auc").alias("cv_auc"), F.stddev_pop("auc").alias("cv_std"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == folds)
        .drop("n")
    )
    place = F.row_number().over(Window.partitionBy("learner").orderBy(F.desc("cv_auc"), "draw"))  # as many rows as draws
    return means.withColumn("place", place).withColumn("best", F.col("place") == 1)


def search_models(
    searches: Mapping[str, tuple[Estimator, Mapping[str, Sequence]]],
    train: DataFrame,
    df: DataFrame,
    keys: Sequence[str],
    path: str,
    split: str = "split",
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    **options,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Random search per learner over a stored trial table, then one row per learner: best parameters, cross-validated
    AUC, AUC and Gini per split, and whether it has the best out-of-time AUC.  Each learner is fitted again on all training
    rows at its best point; one without a rated point is left out."""
    trials = run_trials(searches, train, keys, path, **options)
    best = rank_trials(trials, options.get("folds", 3)).filter("best").select(
        F.col("learner").alias("model_name"), F.col("parameters").alias("best_parameters"), "cv_auc"
    )
    chosen = {r["model_name"]: json.loads(r["best_parameters"]) for r in best.collect()}

    def at(name: str) -> Estimator:
        estimator = searches[name][0]
        classifier = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
        return estimator.copy({classifier.getParam(p): v for p, v in chosen[name].items()})

    models = fit_models({name: (lambda name=name: at(name)) for name in searches if name in chosen}, train)
    quality = compare_models(models, df, [split], stage)
    wide = quality.groupBy("model_name").agg(
        *[
            F.max(F.when(F.col(split) == part, F.col(measure))).alias(f"{part}_{measure}")
            for measure in ("auc", "gini")
            for part in ("train", "test", "oot")
        ]
    )
    selected = best_model(wide.select("model_name", F.col("oot_auc").alias("auc"))).select("model_name").scalar()
    return models, best.join(wide, "model_name").withColumn("selected", F.col("model_name") == selected)


# --- model bank -------------------------------------------------------------------------------------------------


def registry_row(
    scored: DataFrame,
    version: str,
    model_date: dt.date,
    features: Sequence[str],
    parameters: Mapping,
    split: str = "split",
    period: str | None = None,
    oot: DataFrame | None = None,
) -> DataFrame:
    """Metadata of a trained model as one row: split sizes and base rates, AUC and Gini per split, and how evenly it
    performs over out-of-time periods when a ``period`` column is given.

    ``scored`` holds label, model_predictions and the split; ``oot`` the out-of-time rows with their period, by default
    those of ``scored``.
    """
    rates = base_rates(scored, split)
    quality = order_stats.auc(scored, "model_predictions", LABEL, by=[split])
    per_split = rates.join(quality, split, "inner")
    entry = F.struct(
        "rows", F.bround("base_rate", 2).alias("base_rate"), F.col("auc"), F.col("gini")
    )
    row = per_split.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(split).alias("key"), entry.alias("value"))))).alias("splits")
    )
    if period is not None:
        late = scored.filter(F.col(split) == "oot") if oot is None else oot
        aucs = order_stats.auc(late, "model_predictions", LABEL, by=[period])
        spread = aucs.agg(F.avg("auc").alias("m"), F.stddev_pop("auc").alias("s")).select(
            F.struct("m", F.try_divide("s", "m").alias("cv"))
        )
        row = row.withColumn("__oot", spread.scalar()).withColumns(
            {"oot_avg": F.col("__oot.m"), "oot_cv": F.col("__oot.cv")}
        ).drop("__oot")
    return row.select(
        F.lit(version).alias("model_version"),
        F.lit(f"{version}.pkl").alias("model_file"),
        F.lit(model_date).alias("model_date"),
        F.lit("active").alias("status"),
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        F.lit(json.dumps(dict(parameters), sort_keys=True)).alias("hyper_parameters"),
        "*",
    )


def save_model(model: PipelineModel, row: DataFrame, bank: str, version: str) -> None:
    """Model directory plus its registry row; saving the same version again replaces both."""
    model.write().overwrite().save(f"{bank}/models/{version}")
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_version").parquet(
        f"{bank}/registry"
    )


def load_model(bank: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{bank}/models/{version}")


def reload_check(model: PipelineModel, reloaded: PipelineModel, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows scored, and rows where the stored model disagrees with the one in memory."""
    live = with_probability(model, df.select(*df.columns), "live")
    both = with_probability(reloaded, live, "stored")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("live").eqNullSafe(F.col("stored"))).alias("mismatches")
    )
