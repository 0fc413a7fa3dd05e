"""Grading of picks and grouped backtest summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.contracts import check_contract, require_columns
from tallyline.functions.numeric import safe_ratio
from tallyline.functions.odds import banded, graded_outcome, outcome_units
from tallyline.operators.picks import DEFAULT_POLICY, PickPolicy, daily_picks
from tallyline.schemas import JOINED_CONTRACT

# The groupings of a backtest summary, "overall" first.
GROUPINGS = {
    "overall": None,
    "by_pick_type": "pick_type",
    "by_confidence_tier": "confidence_tier",
    "by_book": "book",
    "by_line_band": "line_band",
    "by_pick_side": "pick_side",
}
NO_OUTCOMES = "no_rows_with_realized_outcomes"
NO_LINES = "no_matching_historical_lines_for_projections"
ACTUAL = "actual_strikeouts"


def grade_picks(picks: DataFrame, *, actual_column: str = ACTUAL) -> DataFrame:
    """Picks with outcome, flags, profit units and line band."""
    require_columns(
        picks,
        ("player_name", "book", "pick_side", "line", "price", "pick_type", "confidence_tier", actual_column),
        "picks_backtest",
    )
    outcome = graded_outcome(F.col(actual_column).cast("double"), F.col("line"), F.col("pick_side"))
    graded = picks.withColumn("outcome", outcome)
    return graded.withColumns(
        {
            "is_win": F.col("outcome") == "win",
            "is_loss": F.col("outcome") == "loss",
            "is_push": F.col("outcome") == "push",
            "decision": F.col("outcome") != "push",
            "profit_units": outcome_units(F.col("price"), F.col("outcome")),
            "line_band": banded(F.col("line")),
        }
    )


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("picks"),
        F.count_if("is_win").alias("wins"),
        F.count_if("is_loss").alias("losses"),
        F.count_if("is_push").alias("pushes"),
        F.count_if("decision").alias("decisions"),
        F.avg("edge").alias("avg_edge"),
        F.avg("value_score").alias("avg_value_score"),
        F.coalesce(F.sum("profit_units"), F.lit(0.0)).alias("profit_units"),
    ]


def _with_rates(summary: DataFrame) -> DataFrame:
    return summary.withColumns(
        {
            "win_rate": safe_ratio(F.col("wins"), F.col("decisions")),
            "roi_per_pick": safe_ratio(F.col("profit_units"), F.col("picks")),
        }
    )


def summarize_backtest(graded: DataFrame) -> DataFrame:
    """All summaries in one pass by grouping sets: ``grouping`` names the summary and
    ``group_value`` its group. A missing group value stays a group of its own; the
    grouping id tells it from a rolled-up column."""
    columns = [c for c in GROUPINGS.values() if c]
    sets = [[F.col(c)] if c else [] for c in GROUPINGS.values()]
    grouped = graded.groupingSets(sets, *columns).agg(
        *_measures(), *[F.grouping(c).alias(f"_rolled_{c}") for c in columns]
    )
    grouping = F.lit("overall")
    value = F.lit(None).cast("string")
    for name, c in GROUPINGS.items():
        if c:
            grouping = F.when(F.col(f"_rolled_{c}") == 0, name).otherwise(grouping)
            value = F.when(F.col(f"_rolled_{c}") == 0, F.col(c)).otherwise(value)
    measures = ("picks", "wins", "losses", "pushes", "decisions", "avg_edge", "avg_value_score", "profit_units")
    labelled = grouped.select(grouping.alias("grouping"), value.alias("group_value"), *measures)
    # The global set yields a row even for no input; an empty backtest has no summaries.
    return _with_rates(labelled.filter("picks > 0"))


def summarize_one(graded: DataFrame, column: str) -> DataFrame:
    """Summary of a single grouping."""
    return _with_rates(graded.groupBy(column).agg(*_measures()))


def run_backtest(
    joined: DataFrame,
    policy: PickPolicy = DEFAULT_POLICY,
    *,
    actual_column: str = ACTUAL,
    group_keys: tuple[str, ...] = ("player_name_proj",),
    strict: bool = True,
) -> DataFrame:
    """Graded picks of the live selection run over rows with a realized outcome.

    ``group_keys`` defaults to the participant alone, as the live selection does; pass
    the date too to get one pick per participant and day."""
    check_contract(joined, JOINED_CONTRACT, strict=strict)
    require_columns(joined, (actual_column,), "joined_quotes_backtest")
    realized = joined.dropna(subset=[actual_column])
    picks = daily_picks(realized, policy, group_keys=group_keys, strict=False)
    return grade_picks(picks, actual_column=actual_column)


def backtest_status(joined: DataFrame, graded: DataFrame, *, actual_column: str = ACTUAL) -> DataFrame:
    """One row: whether a backtest is available, why not, and how many picks it has."""
    found = joined.agg(
        F.count(F.lit(1)).alias("_rows"), F.count(F.col(actual_column)).alias("_realized")
    )
    picks = graded.agg(F.count(F.lit(1)).alias("graded_pick_rows"))
    reason = F.when(F.col("_rows") == 0, NO_LINES).when(F.col("_realized") == 0, NO_OUTCOMES)
    return (
        found.withColumn("graded_pick_rows", picks.scalar())
        .select((F.col("_realized") > 0).alias("available"), reason.alias("reason"), "graded_pick_rows")
    )
