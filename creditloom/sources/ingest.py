"""Bronze ingest of delimited files."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from creditloom.sources import sinks

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Header row names the columns.  Everything stays text unless inference is asked for: inferred types change
    with the data, and silver converts once and for all."""
    return spark.read.csv(path, header=True, inferSchema=infer)


def chosen_sources(sources: Mapping[str, str], only: str | None = None) -> dict[str, str]:
    """All sources, or the one asked for.  An unknown name is reported and all are processed."""
    if only is None:
        return dict(sources)
    if only not in sources:
        log.warning("unknown source %s, known are %s; processing all", only, sorted(sources))
        return dict(sources)
    return {only: sources[only]}


def ingest_bronze(
    spark: SparkSession, sources: Mapping[str, str], bronze: str, only: str | None = None, infer: bool = False
) -> dict[str, int | None]:
    """Copy each source into the bronze layer and return its row count, or None for a source that does not exist.

    A source replaces its bronze table: snapshots that it no longer holds go.  Any other failure stops the ingest.  Rows
    are counted from the footers of what was written.  (An ``Observation`` would count for free, but a session that has
    used one can no longer ship models with a training summary.)
    """
    report: dict[str, int | None] = {}
    for name, path in chosen_sources(sources, only).items():
        try:
            df = read_csv(spark, path, infer)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.error("source %s not found at %s, skipped", name, path)
            report[name] = None
            continue
        if sinks.DATE in df.columns:
            sinks.write_snapshots(df, f"{bronze}/{name}", rebuild=True, lines=not infer)
        else:
            sinks.write_table(df, f"{bronze}/{name}")
        report[name] = read_bronze(spark, bronze, name).count()
    return report


def read_bronze(spark: SparkSession, bronze: str, name: str) -> DataFrame:
    """A bronze table; partition values stay text like every other column unless they are dates."""
    return spark.read.parquet(f"{bronze}/{name}")
