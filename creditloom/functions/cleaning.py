"""Column expressions that turn dirty text into typed values.

ANSI mode stays on; every conversion that may meet malformed text is a ``try_`` form, so bad cells become NULL and
never stop a job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom import fixed_values as fixed


def blank_tokens(df: DataFrame, tokens: Iterable[str], skip: Iterable[str] = ()) -> DataFrame:
    """NULL for whole cells that hold a placeholder, in every text column but those in ``skip``.

    Columns that ``clean_numbers`` treats can be skipped: no placeholder has a digit, so it ends as NULL there too.
    """
    skip = set(skip)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    tokens = list(tokens)
    return df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in text})


def number_from_text(column: Column, keep: str, to: str) -> Column:
    """Drop every character outside the class ``keep``, then convert; anything still malformed is NULL."""
    return F.regexp_replace(column, f"[^{keep}]", "").try_cast(to)


def to_type(column: Column, source: T.DataType, to: str) -> Column:
    """Lenient conversion.  Text becomes an integer by way of a double, so ``'3.0'`` is 3; overflow is NULL."""
    if isinstance(source, T.StringType) and to in ("int", "bigint"):
        return column.try_cast("double").try_cast(to)
    return column.try_cast(to)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient conversion of the named columns that are present, in one projection."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_type(F.col(c), have[c], t) for c, t in types.items() if c in have})


def clean_numbers(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Apply ``number_from_text`` to text columns; columns that already are numbers are only converted.

    A number must not take the detour through text: 12345678.5 would print as ``1.23456785E7`` and lose its exponent.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cleaned = {}
    for name, (keep, to) in rules.items():
        if name not in have:
            continue
        if isinstance(have[name], T.StringType):
            cleaned[name] = number_from_text(F.col(name), keep, to)
        else:
            cleaned[name] = F.col(name).try_cast(to)
    return df.withColumns(cleaned)


def only_if(condition: Column, column: Column) -> Column:
    """The value where the condition holds, else NULL."""
    return F.when(condition, column)


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def loan_types(column: Column, strict: bool = True) -> Column:
    """``'A, B, and C'`` as a lower-case list.

    The stored lists were split on a pattern whose first alternative always wins, so a last element keeps its
    ``and``; ``strict`` keeps that form, otherwise the word goes too.  The list length is the same.
    """
    pattern = fixed.LOAN_TYPE_SEPARATOR if strict else fixed.LOAN_TYPE_SEPARATOR_CLEAN
    return F.transform(F.split(column, pattern), lambda item: F.lower(F.trim(item)))


def list_size(column: Column) -> Column:
    """Length of a list, -1 for a missing list."""
    return F.coalesce(F.size(column), F.lit(-1))


def history_months(column: Column) -> Column:
    """``'22 Years and 3 Months'`` as months; no years means unknown, no months means zero."""

    def part(unit: str) -> Column:
        return F.regexp_extract(column, rf"(\d+)\s+{unit}", 1).try_cast("int")

    return part("Years") * 12 + F.coalesce(part("Months"), F.lit(0))
