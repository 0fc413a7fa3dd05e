"""Forecast evaluation, interval calibration and interval application."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.contracts import require_columns
from tallyline.functions.numeric import at_least_zero, to_number
from tallyline.functions.odds import band_rank, banded
from tallyline.operators.quantiles import MAX_ROWS_AT_ONCE, exact_quantiles
from tallyline.session import materialize

# Interval defaults and their documented names.
NOMINAL_COVERAGE = 0.8
STDDEV_COLUMN = "strikeouts_stddev_last10"
CALIBRATION_METHOD = "recent_stddev_scaled_by_empirical_residual_quantile"
UNCALIBRATED_METHOD = "recent_stddev_without_calibration"

ACTUAL = "actual_strikeouts"
PREDICTED = "predicted_strikeouts"


def prediction_results(scored: DataFrame, *, label: str = "strikeouts") -> DataFrame:
    """Scored rows with actual, signed error and absolute error. Label and forecast sit
    in the same row, so nothing is matched by position."""
    require_columns(scored, (label, PREDICTED), "scored")
    return (
        scored.withColumn(ACTUAL, F.col(label).cast("double"))
        .withColumn("error", F.col(PREDICTED) - F.col(ACTUAL))
        .withColumn("abs_error", F.abs("error"))
    )


def regression_metrics(results: DataFrame, *, max_rows: int = MAX_ROWS_AT_ONCE) -> DataFrame:
    """One row of error metrics with exact, linearly interpolated quantiles."""
    require_columns(results, (ACTUAL, PREDICTED), "prediction_results")
    error = F.col(PREDICTED).cast("double") - F.col(ACTUAL).cast("double")
    errors = materialize(
        results.select(
            F.col(PREDICTED).cast("double").alias("yhat"),
            F.col(ACTUAL).cast("double").alias("y"),
            error.alias("e"),
            F.abs(error).alias("a"),
        ),
        "errors",
    )
    median, p75, p90 = exact_quantiles(errors, "a", [0.5, 0.75, 0.9], max_rows=max_rows)
    return errors.agg(
        F.avg("a").alias("mae"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        F.lit(median).cast("double").alias("median_absolute_error"),
        F.avg("e").alias("bias"),
        F.lit(p75).cast("double").alias("abs_error_p75"),
        F.lit(p90).cast("double").alias("abs_error_p90"),
        F.min("yhat").alias("pred_min"),
        F.max("yhat").alias("pred_max"),
        F.min("y").alias("actual_min"),
        F.max("y").alias("actual_max"),
    )


def _base_stddev(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        return F.lit(0.0)
    return at_least_zero(to_number(F.col(column)))


def fit_intervals(
    results: DataFrame,
    *,
    stddev_column: str = STDDEV_COLUMN,
    nominal_coverage: float = NOMINAL_COVERAGE,
    max_rows: int = MAX_ROWS_AT_ONCE,
) -> dict:
    """The factor on the recent deviation whose interval reaches the nominal coverage on
    these rows. Rows without a positive deviation carry no information and are left out;
    without any usable row the factor is 1."""
    usable = results.select(
        F.abs(F.col(PREDICTED).cast("double") - F.col(ACTUAL).cast("double")).alias("a"),
        _base_stddev(results, stddev_column).alias("sd"),
    ).filter("sd > 0")
    scaled = materialize(usable.select((F.col("a") / F.col("sd")).alias("scaled")), "scaled-errors")
    rows = scaled.count()
    factor = exact_quantiles(scaled, "scaled", [nominal_coverage], max_rows=max_rows)[0]
    if factor is None or not 0 < factor < float("inf"):
        factor = 1.0
    return {
        "method": CALIBRATION_METHOD,
        "base_stddev_column": stddev_column,
        "nominal_coverage": float(nominal_coverage),
        "interval_multiplier": float(factor),
        "calibration_rows": rows,
        "documented_interpretation": (
            f"empirical central prediction interval targeting {nominal_coverage:.0%} coverage "
            "where a recent deviation is known"
        ),
    }


def add_base_uncertainty(scored: DataFrame, *, stddev_column: str = STDDEV_COLUMN) -> DataFrame:
    """``std_dev`` from the recent deviation: 0 where it is missing or negative."""
    return scored.withColumn("std_dev", _base_stddev(scored, stddev_column))


def apply_intervals(
    scored: DataFrame, config: Mapping | None = None, *, stddev_column: str = STDDEV_COLUMN
) -> DataFrame:
    """Interval bounds around the forecast. The unscaled deviation is kept in
    ``raw_std_dev`` and is the starting point of a later call, so applying a config to
    rows that already carry an interval does not scale twice."""
    require_columns(scored, (PREDICTED,), "scored")
    config = config or {}
    factor = float(config.get("interval_multiplier", 1.0))
    source = next((c for c in ("raw_std_dev", "std_dev", stddev_column) if c in scored.columns), None)
    raw = _base_stddev(scored, source) if source else F.lit(0.0)
    out = (
        scored.withColumn("raw_std_dev", raw)
        .withColumn("std_dev", F.col("raw_std_dev") * factor)
        .withColumns(
            {
                "lower_bound": F.greatest(F.col(PREDICTED) - F.col("std_dev"), F.lit(0.0)),
                "upper_bound": F.col(PREDICTED) + F.col("std_dev"),
            }
        )
    )
    if config:
        out = out.withColumns(
            {
                "interval_coverage_target": F.lit(float(config.get("nominal_coverage", NOMINAL_COVERAGE))),
                "interval_multiplier": F.lit(factor),
            }
        )
    return out


def apply_metadata_intervals(scored: DataFrame, metadata: Mapping | None) -> DataFrame:
    """Intervals as the training metadata configures them; unchanged without a config."""
    config = (metadata or {}).get("uncertainty_model")
    return apply_intervals(scored, config) if config else scored


def interval_coverage(
    results: DataFrame, config: Mapping | None = None, *, stddev_column: str = STDDEV_COLUMN
) -> DataFrame:
    """One row: hit rate, widths and miss rates of the intervals on these rows."""
    config = config or {}
    rows = apply_intervals(results, config, stddev_column=stddev_column)
    actual, lower, upper = F.col(ACTUAL), F.col("lower_bound"), F.col("upper_bound")

    def share(condition: Column) -> Column:
        return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))

    return rows.agg(
        F.lit(config.get("method", UNCALIBRATED_METHOD)).alias("interval_method"),
        F.lit(float(config.get("nominal_coverage", NOMINAL_COVERAGE))).alias("nominal_coverage"),
        share((actual >= lower) & (actual <= upper)).alias("empirical_coverage"),
        F.avg(upper - lower).alias("mean_interval_width"),
        F.avg("std_dev").alias("mean_half_width"),
        share(actual < lower).alias("miss_rate_below_lower_bound"),
        share(actual > upper).alias("miss_rate_above_upper_bound"),
        F.count(F.lit(1)).alias("rows"),
    )


def error_buckets(results: DataFrame, *, bucket_column: str = PREDICTED) -> DataFrame:
    """Errors by forecast band, in band order; bands without rows do not appear."""
    require_columns(results, (bucket_column, ACTUAL, PREDICTED, "error", "abs_error"), "prediction_results")
    return (
        results.filter(F.col(bucket_column).isNotNull())
        .groupBy(banded(F.col(bucket_column)).alias("error_bucket"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(ACTUAL).alias("mean_actual"),
            F.avg(PREDICTED).alias("mean_prediction"),
            F.avg("abs_error").alias("mae"),
            F.avg("error").alias("bias"),
        )
        .orderBy(band_rank(F.col("error_bucket")))
    )


def date_range(df: DataFrame, column: str = "game_date") -> DataFrame:
    """First and last day as text, missing for an empty table."""
    return df.agg(
        F.date_format(F.min(column), "yyyy-MM-dd").alias("start"),
        F.date_format(F.max(column), "yyyy-MM-dd").alias("end"),
    )
