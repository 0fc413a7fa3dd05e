"""Exact quantiles of a whole column without gathering it in one task.

``percentile`` keeps every distinct value of a group in one buffer. The wanted order
statistics are therefore always bracketed first: approximate
quantiles (small, mergeable digests) give a narrow value range around each, one pass
counts the rows below and inside the range, and only once a range holds few distinct
values are those, with their counts, ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS_AT_ONCE = 100_000
DIGEST_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, column: str, probabilities: list[float], *, max_rows: int = MAX_ROWS_AT_ONCE
) -> list[float | None]:
    """Linearly interpolated quantiles of the non-missing values. The table is read
    several times, so pass one that is cheap to read, such as a written copy."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    total = values.count()
    if total == 0:
        return [None] * len(probabilities)
    ranks = [(math.floor(p * (total - 1)), p * (total - 1)) for p in probabilities]
    # One pass for the brackets of all probabilities, one for the rows around them.
    slack = 2.0 / DIGEST_ACCURACY
    edges = [e for low, _ in ranks for e in (max(0.0, low / total - slack), min(1.0, (low + 2) / total + slack))]
    found = values.agg(F.percentile_approx("v", edges, DIGEST_ACCURACY)).first()[0]
    brackets = list(zip(found[::2], found[1::2], strict=True))
    counts = values.agg(
        *[F.count_if(F.col("v") < low).alias(f"under{i}") for i, (low, _) in enumerate(brackets)],
        *[F.count_if(F.col("v").between(*b)).alias(f"within{i}") for i, b in enumerate(brackets)],
    ).first()
    out = []
    for i, (rank, position) in enumerate(ranks):
        last = min(rank + 1, total - 1)
        under, within = counts[f"under{i}"], counts[f"within{i}"]
        if under <= rank and last < under + within:
            below, inside, rows = under, values.filter(F.col("v").between(*brackets[i])), within
        else:  # the bracket missed a rank
            below, inside, rows = 0, values, total
        low, high = _order_statistics(inside, rank, last, max_rows, below, rows)
        out.append(low + (high - low) * (position - rank))
    return out


def _order_statistics(
    inside: DataFrame, first: int, last: int, max_rows: int, below: int, rows: int
) -> tuple[float, float]:
    """The values at the 0-based ranks ``first`` and ``last`` (equal or adjacent) of all
    values, ``below`` of which lie below the ``rows`` values inside."""
    while rows > max_rows:
        # A bracket one digest error wide on both sides holds both ranks.
        slack = 2.0 / DIGEST_ACCURACY
        lower_p = max(0.0, (first - below) / rows - slack)
        upper_p = min(1.0, (last - below + 1) / rows + slack)
        low, high = inside.agg(
            F.percentile_approx("v", [lower_p, upper_p], DIGEST_ACCURACY)
        ).first()[0]
        counts = inside.agg(
            F.count_if(F.col("v") < low).alias("under"),
            F.count_if(F.col("v").between(low, high)).alias("within"),
        ).first()
        # Bounds that missed a rank open up to that side again.
        while below + counts["under"] > first or below + counts["under"] + counts["within"] <= last:
            if below + counts["under"] > first:
                low = -math.inf
            if below + counts["under"] + counts["within"] <= last:
                high = math.inf
            counts = inside.agg(
                F.count_if(F.col("v") < low).alias("under"),
                F.count_if(F.col("v").between(low, high)).alias("within"),
            ).first()
        if counts["within"] == rows:
            break
        inside = inside.filter(F.col("v").between(low, high))
        below, rows = below + counts["under"], counts["within"]
    # Equal values collapse in the map tasks before anything is ranked.
    tallied = inside.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    reached = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = tallied.withColumn("upto", F.lit(below) + reached)
    low, high = ranked.agg(
        F.min(F.when(F.col("upto") > first, F.col("v"))), F.min(F.when(F.col("upto") > last, F.col("v")))
    ).first()
    return low, high
