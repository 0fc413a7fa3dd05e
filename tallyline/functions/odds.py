"""American odds, outcomes and profit units as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.numeric import strip, to_number

# Line bands, right-closed upper limits with their labels.
LINE_BANDS = ((4.5, "<=4.5"), (5.5, "4.5-5.5"), (6.5, "5.5-6.5"), (7.5, "6.5-7.5"))
LINE_BAND_ABOVE = "7.5+"
LINE_BAND_MISSING = "unknown"

# Accepted spellings of a settled result and their ledger form.
RESULT_SPELLINGS = {"w": "W", "win": "W", "l": "L", "loss": "L", "push": "Push"}


def implied_probability(price: Column) -> Column:
    p = price.cast("double")
    return F.when(p < 0, F.try_divide(-p, 100 - p)).otherwise(F.try_divide(F.lit(100.0), p + 100))


def win_units(price: Column) -> Column:
    """Profit of a won one-unit stake."""
    p = price.cast("double")
    return F.when(p > 0, p / 100).otherwise(F.try_divide(F.lit(100.0), F.abs(p)))


def graded_outcome(actual: Column, line: Column, side: Column) -> Column:
    """win / loss / push; every side that is not "over" is graded as an under."""
    margin = F.when(F.lower(side) == "over", actual - line).otherwise(line - actual)
    return F.when(margin > 0, "win").when(margin < 0, "loss").when(margin == 0, "push")


def outcome_units(price: Column, outcome: Column) -> Column:
    return (
        F.when(outcome == "push", F.lit(0.0))
        .when(outcome == "loss", F.lit(-1.0))
        .when(outcome == "win", win_units(price))
    )


def banded(value: Column, missing: str | None = LINE_BAND_MISSING) -> Column:
    """Label of the right-closed band a value falls in."""
    label = F.when(value.isNull(), F.lit(missing))
    for upper, name in LINE_BANDS:
        label = label.when(value <= upper, name)
    return label.otherwise(LINE_BAND_ABOVE)


def band_rank(label: Column) -> Column:
    """Position of a band label, for ordered output."""
    names = [name for _, name in LINE_BANDS] + [LINE_BAND_ABOVE]
    return F.array_position(F.array(*[F.lit(n) for n in names]), label)


def side_key(side: Column) -> Column:
    return F.coalesce(F.lower(strip(side)), F.lit(""))


def format_odds(price: Column) -> Column:
    """Signed whole-number text, blank when missing."""
    whole = price.cast("double").try_cast("long")
    text = F.concat(F.when(whole > 0, "+").otherwise(""), whole.cast("string"))
    return F.coalesce(text, F.lit(""))


def parse_odds(c: Column) -> Column:
    """Numeric odds from text; blank, malformed and 0 are missing."""
    return F.nullif(to_number(c), F.lit(0.0))


def settled_result(c: Column) -> Column:
    spelling = F.lower(strip(c))
    result = F.lit("")
    for text, code in reversed(RESULT_SPELLINGS.items()):
        result = F.when(spelling == text, code).otherwise(result)
    return result


def ledger_units(odds: Column, result: Column) -> Column:
    """Units won or lost by a settled ledger row, NULL when it cannot be graded."""
    return (
        F.when(result == "Push", F.lit(0.0))
        .when(result == "L", F.lit(-1.0))
        .when((result == "W") & odds.isNotNull(), win_units(odds))
    )
