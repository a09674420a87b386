"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditloom import fixed_values as fixed


def ratio(top: Column, bottom: Column, offset: float = 1.0) -> Column:
    """``top / (bottom + offset)``; NULL where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double") + F.lit(float(offset)))


def share(condition: Column) -> Column:
    """Fraction of rows for which the condition holds (aggregate)."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def stable_round(column: Column, digits: int = 4) -> Column:
    """Half-even rounding, the rule of stored reports.  A first rounding six digits further keeps noise in the last
    bits, which depends on summation order, from deciding a tie."""
    return F.bround(F.round(column, digits + 6), digits)


def gini(auc: Column) -> Column:
    return stable_round(2 * auc - 1, 3)


def positive_class(probability: Column, cut: float = 0.5) -> Column:
    """1 when the probability is strictly above the cut."""
    return (probability > cut).cast("int")


def oot_rating(cv: Column) -> Column:
    """Rating of the spread of out-of-time scores; NULL in, NULL out."""
    rating = F
    for limit, name, _ in fixed.OOT_RATINGS:
        rating = rating.when(cv < limit, name)
    return rating.when(cv.isNotNull(), fixed.OOT_RATING_WORST[0])


def oot_explanation(rating: Column) -> Column:
    text = F.when(rating == fixed.OOT_RATING_WORST[0], fixed.OOT_RATING_WORST[1])
    for _, name, words in fixed.OOT_RATINGS:
        text = text.when(rating == name, words)
    return text


def age_group(age: Column, missing_as_oldest: bool = True) -> Column:
    """Age band.  Stored encodings count a missing age as the oldest band; otherwise it is ``Unknown``."""
    band = F if missing_as_oldest else F.when(age.isNull(), "Unknown")
    for limit, name in fixed.AGE_GROUPS:
        band = band.when(age < limit, name)
    return band.otherwise(fixed.AGE_GROUP_OLDEST)


def model_version(date: Column) -> Column:
    return F.concat(F.lit("credit_model_"), F.date_format(date, "yyyy_MM_dd"))


def model_stem(file: Column) -> Column:
    """Model file name without its four-character extension."""
    return F.regexp_replace(file, r".{4}$", "")


def model_file_date(file: Column) -> Column:
    """Date in ``credit_model_YYYYMMDD.pkl``; NULL for any other name."""
    digits = F.regexp_extract(file, r"credit_model_(\d{8})\.pkl", 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")
