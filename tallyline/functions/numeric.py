"""Numeric coercion and null-safe arithmetic.

Missing is always NULL in this engine. NaN compares greater than every number in
Spark and poisons averages, so it is turned into NULL wherever data enters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the plain decimal notation accepted from text fields.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Every white space character of Unicode.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(c: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def finite_or_null(c: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(F.abs(nan_to_null(c)) < F.lit(float("inf")), c)


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """Apply :func:`nan_to_null` to every floating column of a table."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({name: nan_to_null(F.col(name).cast("double")) for name in floating})


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the denominator is 0 or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def at_least_zero(c: Column) -> Column:
    """Missing counts as 0, negatives are raised to 0."""
    filled = F.coalesce(nan_to_null(c.cast("double")), F.lit(0.0))
    return F.when(filled > 0, filled).otherwise(F.lit(0.0))
