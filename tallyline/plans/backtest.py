"""Historical backtest: forecasts against curated lines through the live selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyline.operators.backtest import ACTUAL, backtest_status, run_backtest, summarize_backtest
from tallyline.operators.market import join_historical_lines
from tallyline.operators.picks import DEFAULT_POLICY, PickPolicy
from tallyline.session import materialize


@dataclass(frozen=True)
class Backtest:
    status: DataFrame
    summary: DataFrame
    graded: DataFrame


def historical_backtest(
    forecasts: DataFrame,
    lines: DataFrame,
    policy: PickPolicy = DEFAULT_POLICY,
    *,
    participant: str = "player_name",
    forecast_key: str = "player_name_norm",
    line_key: str = "player_name_norm",
    actual_column: str = ACTUAL,
    group_keys: tuple[str, ...] = ("player_name_proj",),
) -> Backtest:
    """Status (one row), grouped summary and graded picks. An empty join gives an
    unavailable status with its reason and no summary rows."""
    joined = join_historical_lines(
        forecasts, lines, participant=participant, forecast_key=forecast_key, line_key=line_key
    )
    # Status, summary and graded rows read the same rows, so each table is written once.
    joined = materialize(joined, "backtest-joined")
    # An empty join is an answer here, not a contract error.
    graded = run_backtest(joined, policy, actual_column=actual_column, group_keys=group_keys, strict=False)
    graded = materialize(graded, "backtest-graded")
    status = backtest_status(joined, graded, actual_column=actual_column)
    return Backtest(status, summarize_backtest(graded), graded)
