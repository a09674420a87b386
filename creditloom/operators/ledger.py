"""Labels and bad rates from the silver ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bad_flag(cutoff: int = 30) -> Column:
    """1 from ``cutoff`` days past due; unknown days past due count as good."""
    return F.when(F.col("dpd") >= cutoff, 1).otherwise(0)


def at_month_on_book(loans: DataFrame, mob: int) -> DataFrame:
    return loans.filter(F.col("mob") == mob)


def label_store(loans: DataFrame, dpd: int = 30, mob: int = 3, with_definition: bool = True) -> DataFrame:
    """One row per loan observed at the given month on book."""
    labels = at_month_on_book(loans, mob).withColumn("label", bad_flag(dpd))
    columns = ["Customer_ID", "loan_id", "label", "snapshot_date"]
    if with_definition:
        labels = labels.withColumn("label_def", F.lit(f"{dpd}dpd_{mob}mob"))
        columns.append("label_def")
    return labels.select(*columns)


def started_before(loans: DataFrame, date: Column) -> DataFrame:
    """Cohort of loans old enough to have run their term."""
    return loans.filter(F.col("loan_start_date") < date)


def at_instalment(loans: DataFrame, number: int) -> DataFrame:
    return loans.filter(F.col("installment_num") == number)


def bad_rate(loans: DataFrame, by: str = "mob", cutoff: int = 30) -> DataFrame:
    """Share of bad rows per group; partial sums are combined before the shuffle."""
    return loans.groupBy(by).agg(
        F.count(F.lit(1)).alias("loans"), F.sum(bad_flag(cutoff)).alias("bads"), F.avg(bad_flag(cutoff)).alias("bad_rate")
    )


def label_distribution(labels: DataFrame, *by: str) -> DataFrame:
    return labels.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("loans"))


def base_rates(labelled: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share of bads per split."""
    return labelled.groupBy(split).agg(F.count(F.lit(1)).alias("rows"), F.avg("label").alias("base_rate"))
