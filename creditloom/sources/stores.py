"""Readers for stores laid out by others: many files, mixed layouts, dates in file names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.monitoring import reconcile


def read_all(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """Every parquet file below the paths as one DataFrame, schemas merged, unreadable files skipped."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.option("mergeSchema", True)
        .option("recursiveFileLookup", recursive)
        .option("ignoreCorruptFiles", True)
        .parquet(*paths)
    )


def skipped_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files below the paths that gave :func:`read_all` no row: unreadable or empty ones, one ``path`` a row."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    seen = read_all(spark, paths).select(F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path")).distinct()
    listed = files.load(paths).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    return listed.join(seen, "path", "left_anti")


def read_predictions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Stored predictions of old and new layout in the current one; each file is read once."""
    return reconcile(read_all(spark, paths))


def _from_path(pattern: str) -> Column:
    return F.regexp_extract("_metadata.file_path", pattern, 1)


def with_path_date(df: DataFrame, name: str = "monitoring_date") -> DataFrame:
    """Date from ``..._YYYY_MM_DD.parquet`` in the path of each row's file."""
    text = _from_path(r"_(\d{4}_\d{2}_\d{2})\.parquet")
    return df.withColumn(name, F.try_to_date(text, "yyyy_MM_dd"))


def with_path_timestamp(df: DataFrame, name: str = "batch_run_timestamp") -> DataFrame:
    """Run time from ``..._YYYYMMDD_HHMMSS.parquet``, as stored text and as a timestamp."""
    text = _from_path(r"_(\d{8}_\d{6})\.parquet")
    return df.withColumn(name, text).withColumn(f"{name}_at", F.try_to_timestamp(text, F.lit("yyyyMMdd_HHmmss")))


def inventory(stores: Mapping[str, DataFrame], pattern: str = r"([^/]+\.(?:parquet|json))(?:/|$)") -> DataFrame:
    """Number of named files and records per store.  A directory written by Spark counts as the one file it is named
    after."""
    parts = [
        df.select(F.lit(store).alias("store"), _from_path(pattern).alias("file")) for store, df in stores.items()
    ]
    files = reduce(DataFrame.unionByName, parts).groupBy("store", "file").agg(F.count(F.lit(1)).alias("records"))
    return files.groupBy("store").agg(F.count("file").alias("files"), F.sum("records").alias("records"))
