"""Gold features: imputation, capping, ratios, encodings and the feature store.

Statistics are fitted by one function and applied by another, so a model can be fitted on its training window and
applied anywhere.  Fitted numeric statistics stay a lazy one-row DataFrame that enters the applying plan as a scalar
subquery: no collect, no cross join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed
from creditloom.functions import cleaning
from creditloom.functions.measures import age_group, ratio
from creditloom.operators import joins, ledger
from creditloom.operators.order_stats import order_statistics
from creditloom.operators.silver import click_columns
from creditloom.session import scratch_dir
from creditloom.sources.sinks import materialise, write_table

STATS, INDEX = "__stats", "__index"


def attach(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Make the single row of ``stats`` available to every row, as the struct column ``__stats``."""
    return df.withColumn(STATS, stats.select(F.struct("*")).scalar())


def fit_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with the named quantiles ``{name: (column, q)}``: the smallest value that has at least the share q of
    the rows at or below it, exactly.  All columns share the passes."""
    shares: dict[str, list[float]] = {}
    for column, q in wanted.values():
        shares.setdefault(column, []).append(q)
    row = order_statistics(df, shares)
    return row.select(*[F.col(c)[shares[c].index(q)].alias(name) for name, (c, q) in wanted.items()])


def cap_points(columns: Sequence[str], low: float = fixed.CAP_LOWER, high: float = fixed.CAP_UPPER) -> dict:
    return {f"{c}__{side}": (c, q) for c in columns for side, q in (("low", low), ("high", high))}


def capped(column: str) -> Column:
    """The value pulled inside its fitted bounds; NULL stays NULL."""
    value, stats = F.col(column).cast("double"), F.col(STATS)
    low, high = stats[f"{column}__low"], stats[f"{column}__high"]
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def cap_quantiles(df: DataFrame, columns: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """Cap columns at their fitted 1% and 95% quantiles; fits on ``df`` itself unless given a fit."""
    stats = fit_quantiles(df, cap_points(columns)) if fitted is None else fitted
    return attach(df, stats).withColumns({c: capped(c) for c in columns}).drop(STATS)


# --- financial statements ---------------------------------------------------------------------------------------


def complete_financials(df: DataFrame) -> DataFrame:
    """Defaults for missing categories and limits; statements without a balance are left out."""
    return df.filter(F.col("Monthly_Balance").isNotNull()).withColumns(
        {
            "Credit_Mix": F.coalesce("Credit_Mix", F.lit("Unknown")),
            "Payment_Behaviour": F.coalesce("Payment_Behaviour", F.lit("Unknown")),
            "Changed_Credit_Limit": F.coalesce("Changed_Credit_Limit", F.lit(0.0)),
        }
    )


def fit_financials(completed: DataFrame) -> DataFrame:
    """Median debt and cap bounds in one pass."""
    return fit_quantiles(completed, {"median_debt": ("Outstanding_Debt", 0.5)} | cap_points(fixed.CAPPED_FINANCIALS))


def impute_debt(df: DataFrame) -> Column:
    return F.coalesce(F.col("Outstanding_Debt"), F.col(STATS)["median_debt"])


def financial_ratios() -> dict[str, Column]:
    """Derived numbers over imputed and capped columns."""
    income, debt, salary = F.col("Annual_Income"), F.col("Outstanding_Debt"), F.col("Monthly_Inhand_Salary")
    return {
        "log_Annual_Income": F.log1p(income),
        "debt_to_income": ratio(debt, income),
        "emi_to_salary": ratio(F.col("Total_EMI_per_month"), salary),
        "investment_rate": ratio(F.col("Amount_invested_monthly"), salary),
        "has_credit_limit_change": (F.col("Changed_Credit_Limit") != 0).cast("int"),
        "balance_to_debt": ratio(F.col("Monthly_Balance") + 1.0, debt),
        "inq_per_loan": ratio(F.col("Num_Credit_Inquiries"), F.col("Num_of_Loan")),
    }


def financial_numbers(df: DataFrame, fitted: DataFrame | None = None) -> DataFrame:
    """Everything but the encodings, in one projection after another so Spark can merge them."""
    completed = complete_financials(df)
    stats = fit_financials(completed) if fitted is None else fitted
    prepared = attach(completed, stats).withColumns(
        {
            "Outstanding_Debt": impute_debt(completed),
            "credit_history_months": cleaning.history_months(F.col("Credit_History_Age")),
            "num_loan_types": cleaning.list_size(F.col("Loan_Types_Array")),
        }
        | {c: capped(c) for c in fixed.CAPPED_FINANCIALS}
    )
    return prepared.withColumns(financial_ratios()).drop(STATS, "Credit_History_Age")


# --- encodings --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Encoder:
    """Fitted category indexes: a stored table (name, value, index) and the number of categories per column."""

    table: DataFrame
    sizes: Mapping[str, int]

    def only(self, columns: Sequence[str]) -> Encoder:
        return Encoder(self.table.filter(F.col("name").isin(list(columns))), {c: self.sizes[c] for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        """Add a sparse one-hot vector ``<column>_vec`` per column; missing and unseen values become the zero vector.

        The indexes are joined, so their number has no limit; Spark broadcasts them where they are small."""
        columns, width = df.columns, {c: max(n + 1, 2) for c, n in self.sizes.items()}
        for c, n in self.sizes.items():
            index = self.table.filter(F.col("name") == c).select(F.col("value").alias(c), F.col("index").alias(INDEX))
            nominal = {"ml_attr": {"type": "nominal", "num_vals": width[c]}}
            place = F.coalesce(INDEX, F.lit(width[c] - 1)).cast("double").alias(f"{c}_idx", metadata=nominal)
            df = df.join(index, c, "left").select(*columns, place)
            columns = df.columns
        encoder = OneHotEncoder(inputCols=[f"{c}_idx" for c in self.sizes], outputCols=[f"{c}_vec" for c in self.sizes])
        return encoder.fit(df).transform(df)


def fit_encoder(df: DataFrame, columns: Sequence[str]) -> Encoder:
    """Index categories by descending frequency (ties alphabetical).

    Categories are counted for all columns in one pass and numbered by their place in a range-partitioned order, so
    neither the driver nor a single task ever holds them all."""
    spark = df.sparkSession
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .filter("value IS NOT NULL")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = ["name", F.desc("n"), "value"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Partition number and place within it, stored so that both stay what they are.
    stored = materialise(
        placed.select("name", "value", F.monotonically_increasing_id().alias("id")), scratch_dir(spark, "categories")
    ).withColumn("part", F.shiftright("id", 33))
    starts = stored.groupBy("name", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first"))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    table = stored.join(starts, ["name", "part"]).select(
        "name", "value", (F.col("start") + F.col("id") - F.col("first")).alias("index")
    )
    found = {r["name"]: r["rows"] for r in stored.groupBy("name").agg(F.count(F.lit(1)).alias("rows")).collect()}
    return Encoder(table, {c: found.get(c, 0) for c in columns})


def encode(df: DataFrame, columns: Sequence[str], encoder: Encoder | None = None) -> DataFrame:
    """Replace category columns by their one-hot vectors."""
    encoder = fit_encoder(df, columns) if encoder is None else encoder
    return encoder.transform(df).drop(*columns, *[f"{c}_idx" for c in columns])


# --- the three sources ------------------------------------------------------------------------------------------


def financial_features(df: DataFrame, fitted: DataFrame | None = None, encoder: Encoder | None = None) -> DataFrame:
    if encoder is None:
        encoder = fit_encoder(complete_financials(df), fixed.FINANCIAL_CATEGORIES)
    return encode(financial_numbers(df, fitted), fixed.FINANCIAL_CATEGORIES, encoder)


def attribute_groups(df: DataFrame, missing_as_oldest: bool = True) -> DataFrame:
    """Ages outside 18 to 75 become unknown; occupation gets a default; age gets a band."""
    age = F.col("Age")
    return df.withColumns(
        {
            "Age": cleaning.only_if(age.between(18, 75), age),
            "Occupation": F.coalesce("Occupation", F.lit("Unknown")),
        }
    ).withColumn("Age_group", age_group(F.col("Age"), missing_as_oldest))


def attribute_features(df: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    return encode(attribute_groups(df), fixed.ATTRIBUTE_CATEGORIES, encoder)


def click_features(df: DataFrame, fitted: DataFrame | None = None) -> DataFrame:
    return cap_quantiles(df, click_columns(df), fitted)


# --- feature store ----------------------------------------------------------------------------------------------

SLICE = ["Customer_ID", "loan_id", "feature_snapshot_date", "label_snapshot_date", "label"]


def withhold(df: DataFrame, names: Sequence[str] = tuple(fixed.WITHHELD_COLUMNS)) -> DataFrame:
    """Drop the listed columns that are present."""
    return df.drop(*names)


def feature_store(
    financials: DataFrame,
    attributes: DataFrame,
    clicks: DataFrame,
    loans: DataFrame,
    dpd: int = 30,
    mob: int = 3,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Features of all sources for every customer and date that has an outcome ``mob`` months later.

    Each source meets the labels, is processed on the matched rows, and the three results are joined on the slice.  The
    loan is part of the slice, so a customer with k labels of one date has k rows; what a source itself repeats still
    multiplies, see ``joins.repeated_slices``.
    The target itself, personal data and raw sources are withheld.

    Fitting reads the matched rows more than once.  ``stage(df, name)`` may store them in between, for example with
    ``sinks.materialise``, so that cleaning and matching run a single time.
    """
    labels = stage(ledger.label_store(loans, dpd, mob), "labels")
    sources = {"financials": financials, "attributes": attributes, "clicks": clicks}

    def match_and_fit(name: str) -> tuple[DataFrame, dict]:
        matched = match_source(sources[name], labels, mob, stage, name)
        return matched, FITS[name](matched)

    found = dict(zip(sources, _together(labels, match_and_fit, sources)))
    fitted = {key: fit for _, fits in found.values() for key, fit in fits.items()}
    return assemble({name: matched for name, (matched, _) in found.items()}, Fitted(**fitted))


def match_sources(
    sources: Mapping[str, DataFrame],
    labels: DataFrame,
    months: int = 3,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, DataFrame]:
    """Each source with the labels ``months`` later.  The sources do not depend on each other; their jobs share the
    cluster instead of queueing."""

    return dict(zip(sources, _together(labels, lambda name: match_source(sources[name], labels, months, stage, name), sources)))


def match_source(source: DataFrame, labels: DataFrame, months: int, stage: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    return stage(joins.offset_join(source, labels, months, carry=[joins.LOAN]), name)


def _together(df: DataFrame, work: Callable, items: Iterable) -> list:
    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(work), items))


@dataclass(frozen=True)
class Fitted:
    """Everything that is fitted on matched sources: medians and caps as one-row tables, and the category indexes."""

    financial: DataFrame
    clicks: DataFrame
    financial_encoder: Encoder
    attribute_encoder: Encoder

    @property
    def encoder(self) -> Encoder:
        """The categories of all sources; their names differ."""
        both = self.financial_encoder, self.attribute_encoder
        return Encoder(both[0].table.unionByName(both[1].table), {**both[0].sizes, **both[1].sizes})

    def save(self, path: str) -> None:
        """Store next to a model; saving again replaces."""
        tables = {"financial": self.financial, "clicks": self.clicks, "categories": self.encoder.table}
        _together(self.clicks, lambda name: write_table(tables[name], f"{path}/{name}"), tables)

    @staticmethod
    def load(spark: SparkSession, path: str, sizes: Mapping[str, int] | None = None) -> Fitted:
        """The stored transformers; ``sizes`` are the numbers of categories they must have."""
        financial, clicks, table = (spark.read.parquet(f"{path}/{name}") for name in ("financial", "clicks", "categories"))
        found = dict.fromkeys([*fixed.FINANCIAL_CATEGORIES, *fixed.ATTRIBUTE_CATEGORIES], 0)
        found |= {r["name"]: r["n"] for r in table.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
        if sizes is not None and dict(sizes) != found:
            raise ValueError(f"stored categories {found} are not those of the model, {dict(sizes)}")
        whole = Encoder(table, found)
        return Fitted(financial, clicks, whole.only(fixed.FINANCIAL_CATEGORIES), whole.only(fixed.ATTRIBUTE_CATEGORIES))


def _fit_financials(matched: DataFrame) -> dict:
    completed = complete_financials(matched)
    return {"financial": fit_financials(completed), "financial_encoder": fit_encoder(completed, fixed.FINANCIAL_CATEGORIES)}


def _fit_attributes(matched: DataFrame) -> dict:
    return {"attribute_encoder": fit_encoder(attribute_groups(matched), fixed.ATTRIBUTE_CATEGORIES)}


def _fit_clicks(matched: DataFrame) -> dict:
    return {"clicks": fit_quantiles(matched, cap_points(click_columns(matched)))}


FITS = {"financials": _fit_financials, "attributes": _fit_attributes, "clicks": _fit_clicks}


def fit_sources(matched: Mapping[str, DataFrame]) -> Fitted:
    """Fit on the rows given, for example those of a training window."""
    found = _together(matched["clicks"], lambda name: FITS[name](matched[name]), FITS)
    return Fitted(**{key: fit for fits in found for key, fit in fits.items()})


def assemble(matched: Mapping[str, DataFrame], fitted: Fitted) -> DataFrame:
    """The feature store of matched sources under given transformers."""
    parts = [
        financial_features(matched["financials"], fitted.financial, fitted.financial_encoder),
        attribute_features(matched["attributes"], fitted.attribute_encoder),
        click_features(matched["clicks"], fitted.clicks),
    ]
    return withhold(reduce(lambda left, right: left.join(right, SLICE, "inner"), parts))
