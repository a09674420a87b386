"""Bronze to silver: one lazy function per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import fixed_values as fixed
from creditloom.functions import cleaning

KEY = ("Customer_ID", "snapshot_date")


def _with_date(df: DataFrame) -> DataFrame:
    return cleaning.cast_columns(cleaning.keyed(df, *KEY), {"snapshot_date": "date"})


def clean_financials(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed monthly statements: placeholders and stray characters removed, unknown payment behaviours dropped to
    NULL, loan types as a list."""
    df = cleaning.blank_tokens(df, fixed.NULL_TOKENS, skip=fixed.FINANCIAL_NUMBERS)
    df = cleaning.clean_numbers(df, fixed.FINANCIAL_NUMBERS)
    behaviour = F.col("Payment_Behaviour")
    return _with_date(
        df.withColumns(
            {
                "Payment_Behaviour": cleaning.only_if(behaviour.isin(fixed.PAYMENT_BEHAVIOURS), behaviour),
                "Loan_Types_Array": cleaning.loan_types(F.col("Type_of_Loan"), strict),
            }
        )
    )


def clean_attributes(df: DataFrame) -> DataFrame:
    """Ages in (0, 100) and well-formed identity numbers, else NULL."""
    df = cleaning.blank_tokens(df, fixed.ATTRIBUTE_NULL_TOKENS, skip=["Age"])
    df = cleaning.clean_numbers(df, {"Age": ("0-9", "int")})
    age, ssn = F.col("Age"), F.col("SSN")
    return _with_date(
        df.withColumns(
            {
                "Age": cleaning.only_if((age > 0) & (age < 100), age),
                "SSN": cleaning.only_if(ssn.rlike(fixed.SSN_PATTERN), ssn),
            }
        )
    )


def click_columns(df: DataFrame) -> list[str]:
    """The numbered feature family, in column order."""
    return [c for c in df.columns if c.startswith("fe_")]


def clean_clickstream(df: DataFrame) -> DataFrame:
    df = cleaning.blank_tokens(df, fixed.NULL_TOKENS)
    df = cleaning.cast_columns(df, {c: "int" for c in click_columns(df)})
    return _with_date(df)


def installments_missed(overdue: Column, due: Column) -> Column:
    """Overdue amount in started instalments; 0 where nothing was due."""
    return F.when(due.isNull() | (due == 0), F.lit(0)).otherwise(F.ceil(F.try_divide(overdue, due)).try_cast("int"))


def _arrears(df: DataFrame, missed: Column) -> DataFrame:
    """Month on book, missed instalments, first missed date and days past due.

    An overdue amount without a missed instalment (nothing was due) has unknown days past due.
    """
    return (
        df.withColumns({"mob": F.col("installment_num"), "installments_missed": missed})
        .withColumn(
            "first_missed_date",
            F.when(F.col("installments_missed") > 0, F.add_months("snapshot_date", -F.col("installments_missed"))),
        )
        .withColumn(
            "dpd",
            F.when(F.col("overdue_amt") > 0, F.datediff("snapshot_date", "first_missed_date")).otherwise(F.lit(0)),
        )
    )


def clean_loans(df: DataFrame) -> DataFrame:
    """Typed instalment ledger with arrears."""
    df = cleaning.keyed(cleaning.cast_columns(df, fixed.LEDGER_TYPES), *KEY)
    return _arrears(df, installments_missed(F.col("overdue_amt"), F.col("due_amt")))


def clean_loans_single_precision(df: DataFrame) -> DataFrame:
    """Second ledger flavour: money in single precision, and every missing number becomes 0 once the missed
    instalments are known (so a missing balance reads 0)."""
    types = {c: "float" if t == "double" else t for c, t in fixed.LEDGER_TYPES.items()}
    df = cleaning.cast_columns(df, types)
    missed = F.ceil(F.try_divide(F.col("overdue_amt"), F.col("due_amt"))).try_cast("int")
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    zeros = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in numbers}
    # The instalment count is taken before the zeros are filled in, in the same projection.
    df = df.withColumns(zeros | {"__missed": F.coalesce(missed, F.lit(0))})
    return _arrears(df, F.col("__missed")).drop("__missed")
