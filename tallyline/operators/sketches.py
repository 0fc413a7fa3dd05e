"""Error quantiles of any range of days from one sketch a day, without reading a row again.

The sketches are Spark's KLL sketches: of bounded size, mergeable, with a rank error that
their size fixes. They approximate; :mod:`tallyline.operators.quantiles` is exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.contracts import require_columns

# Items of the lowest level of a sketch. 200 keep the rank error of a quantile near 1.3%.
SIZE, RANK_ERROR = 200, 0.0165


def daily_sketches(results: DataFrame, column: str, *, day: str = "game_date", size: int = SIZE) -> DataFrame:
    """Rows (day, n, sketch) of a column's values; missing values are none of them. Built in
    the map tasks, so a day is a sketch for each of them by the time it is shuffled."""
    require_columns(results, (day, column), "results")
    known = results.select(F.col(day).alias(day), F.col(column).cast("double").alias("_value"))
    known = known.filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    sketch = F.kll_sketch_agg_double("_value", F.lit(size)).alias("sketch")
    return known.groupBy(day).agg(F.count(F.lit(1)).alias("n"), sketch)


def _between(day: str, start: str | None, end: str | None) -> Column:
    chosen = F.lit(True)
    if start is not None:
        chosen = chosen & (F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        chosen = chosen & (F.col(day) <= F.lit(end).cast("date"))
    return chosen


def range_quantiles(
    sketches: DataFrame,
    probabilities: Sequence[float],
    *,
    start: str | None = None,
    end: str | None = None,
    day: str = "game_date",
    size: int = SIZE,
) -> DataFrame:
    """Rows (probability, n, quantile) over the days of a closed range, from the stored
    sketches alone. A range without values has no rows."""
    merged = sketches.filter(_between(day, start, end)).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )
    # Spark takes a quantile's rank as a constant only.
    points = F.array(*[
        F.struct(
            F.lit(float(p)).alias("probability"),
            "n",
            F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile"),
        )
        for p in probabilities
    ])
    return merged.filter("n > 0").select(F.inline(points))


def rank_shares(results: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``values`` (probability, quantile) with the shares of the column's values that lie below
    and up to each: the exact answer beside a sketch's. One pass; the values are few."""
    points = {r["probability"]: r["quantile"] for r in values.select("probability", "quantile").collect()}
    known = results.select(F.col(column).cast("double").alias("_value")).filter("_value is not null")
    counts = [F.count(F.lit(1)).alias("_n")]
    for i, q in enumerate(points.values()):
        counts += [F.count_if(F.col("_value") < q).alias(f"_below_{i}"), F.count_if(F.col("_value") <= q).alias(f"_to_{i}")]
    one = known.agg(*counts)
    rows = F.array(*[
        F.struct(
            F.lit(p).alias("probability"),
            F.lit(q).alias("quantile"),
            (F.col(f"_below_{i}") / F.col("_n")).alias("below"),
            (F.col(f"_to_{i}") / F.col("_n")).alias("up_to"),
        )
        for i, (p, q) in enumerate(points.items())
    ])
    return one.select(F.inline(rows))
