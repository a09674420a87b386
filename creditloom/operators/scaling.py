"""Feature matrix preparation: column choice, alignment to a model and standard scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import fixed_values as fixed
from creditloom.operators.features import STATS, attach

NOT_FEATURES = ("Customer_ID", "loan_id", "snapshot_date", "feature_snapshot_date", "label_snapshot_date", *fixed.TARGET_NAMES)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES, vectors: bool = False) -> list[str]:
    """Feature columns by declared type.  Integers count whether or not they hold NULLs; vectors on request."""
    kinds = (T.NumericType, VectorUDT) if vectors else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def prefixed_columns(df: DataFrame, prefix: str = "fe_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def target_column(df: DataFrame, names: Sequence[str] = tuple(fixed.TARGET_NAMES)) -> str:
    """The first known target name that is present."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"no target column; expected one of {list(names)}")


def missing_features(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def missing_ratio(df: DataFrame, wanted: Sequence[str]) -> float:
    """Share of the model's features the data lacks; above a tenth, scores are doubtful."""
    return len(missing_features(df, wanted)) / len(wanted) if wanted else 0.0


def align_features(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ("Customer_ID", "snapshot_date")) -> DataFrame:
    """The model's features in the model's order; NULLs and absent features are 0."""
    have = set(df.columns)
    filled = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c) for c in wanted
    ]
    return df.select(*keep, *filled)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of means and population deviations over the training rows; NULLs are ignored, a constant column keeps
    scale 1."""
    stats = []
    for c in columns:
        deviation = F.stddev_pop(F.col(c).cast("double"))
        stats += [
            F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
            F.when(deviation == 0, 1.0).otherwise(deviation).alias(f"{c}__scale"),
        ]
    return df.agg(*stats)


def scale(df: DataFrame, columns: Sequence[str], fitted: DataFrame) -> DataFrame:
    stats = F.col(STATS)
    scaled = {c: (F.col(c).cast("double") - stats[f"{c}__mean"]) / stats[f"{c}__scale"] for c in columns}
    return attach(df, fitted).withColumns(scaled).drop(STATS)


def scale_vectors(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Every entry of an array column scaled over its position, in long form (keys, dim, scaled); arrays may differ in
    length.  Positions are few next to rows, so their statistics are a small joined table."""
    entries = df.select(*keys, F.posexplode(F.col(vector)).alias("dim", "v")).withColumn("v", F.col("v").cast("double"))
    deviation = F.stddev_pop("v")
    stats = entries.groupBy("dim").agg(
        F.avg("v").alias("mean"), F.when(deviation == 0, 1.0).otherwise(deviation).alias("scale")
    )
    return entries.join(stats, "dim").select(*keys, "dim", ((F.col("v") - F.col("mean")) / F.col("scale")).alias("scaled"))


def model_matrix(df: DataFrame, numbers: Sequence[str], vectors: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``align_features`` that also carries encoded vectors along."""
    aligned = align_features(df, numbers, [*keep, *[v for v in vectors if v not in keep]])
    return aligned.select(*keep, *numbers, *vectors)


def vector_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
