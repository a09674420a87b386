"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pathlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import session

ROOT = str(pathlib.Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of an Arrow batch.  Texts are long: Spark's default of 10,000 rows costs workers and JVM hundreds of
#: megabytes.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and the place of this package for the Python workers."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return session.tune(spark)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    path = session.scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``work`` to every Arrow batch; nothing is kept from one batch to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark compares them without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by exact name, also where the name holds dots or backticks."""
    return df["`" + name.replace("`", "``") + "`"]


def text_of(df: DataFrame, name: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


def crc_mod(id_column: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def parts(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """As many partitions as the session uses, more where they would grow beyond ``rows_per_part``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_part))
