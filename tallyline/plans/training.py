"""Training build: history, lines, model, evaluation record and publishing as one version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.evaluate import (
    ACTUAL,
    PREDICTED,
    date_range,
    error_buckets,
    fit_intervals,
    interval_coverage,
    prediction_results,
    regression_metrics,
)
from tallyline.operators.backtest import GROUPINGS
from tallyline.operators.model import BoostParams, model_table, params_record, score, time_split, train_model
from tallyline.operators.rollup import starter_like
from tallyline.plans.backtest import historical_backtest
from tallyline.plans.history import entity_history
from tallyline.plans.lines import curated_lines_from
from tallyline.schemas import (
    EVENT_RANGE,
    MODEL_FEATURES,
    MODEL_LABEL,
    SELECTION_RULE,
    SPLIT_DATE,
    STARTER_MIN_BATTERS,
    STARTER_MIN_PITCHES,
)
from tallyline.session import materialize, scratch
from tallyline.sources import publish
from tallyline.sources.readers import read_events
from tallyline.sources.versions import Version


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    table: DataFrame
    metadata: dict


def _record(row_table: DataFrame) -> dict:
    return row_table.first().asDict()


def _backtest_record(test: DataFrame, lines: DataFrame | None) -> dict:
    """Summaries by grouping, without the graded rows themselves."""
    if lines is None or lines.isEmpty():
        return {"available": False, "reason": "historical_market_lines_not_provided"}
    forecasts = test.select("game_date", "player_name", PREDICTED, ACTUAL)
    result = historical_backtest(forecasts, lines)
    record = _record(result.status)
    groups: dict[str, list] = {name: [] for name in GROUPINGS}
    # One row per class, tier, book, band and side: bounded by the market, not the data.
    for row in result.summary.collect():
        entry = row.asDict()
        name, value = entry.pop("grouping"), entry.pop("group_value")
        if GROUPINGS[name]:
            entry[GROUPINGS[name]] = value
        groups[name].append(entry)
    return {**record, **groups}


def training_record(
    table: DataFrame,
    train: DataFrame,
    test: DataFrame,
    lines: DataFrame | None,
    *,
    params: BoostParams,
    split_date: str,
    event_range: tuple[str, str],
    lines_folder: str | None = None,
) -> dict:
    """The metadata record. ``train`` and ``test`` are scored rows with errors; the
    interval factor is fitted once, on the training rows."""
    intervals = fit_intervals(train)
    rows = {"train": train.count(), "test": test.count()}
    return {
        "target": MODEL_LABEL,
        "features": list(MODEL_FEATURES),
        "model_params": params_record(params),
        "training_window": {
            "events_start": event_range[0],
            "events_end": event_range[1],
            "split_date": split_date,
            "model_table_rows": table.count(),
            "train_rows": rows["train"],
            "test_rows": rows["test"],
            "train_date_range": _record(date_range(train)),
            "test_date_range": _record(date_range(test)),
        },
        "evaluation_metrics": {
            "regression": _record(regression_metrics(test)),
            "bucketed_error": {
                "bucket_by": PREDICTED,
                "buckets": [row.asDict() for row in error_buckets(test).collect()],
            },
            "uncertainty": _record(interval_coverage(test, intervals)),
            "workflow_backtest": _backtest_record(test, lines),
            "sample_sizes": {"train_rows": rows["train"], "test_rows": rows["test"]},
        },
        "uncertainty_model": intervals,
        "historical_lines": {
            "selection_rule": SELECTION_RULE,
            "source_directory": lines_folder,
            "rows": 0 if lines is None else lines.count(),
            "limitations": "one selected line per day, participant, book and side; no snapshot history",
        },
    }


def train_and_evaluate(
    history: DataFrame,
    lines: DataFrame | None = None,
    *,
    params: BoostParams = BoostParams(),
    split_date: str = SPLIT_DATE,
    event_range: tuple[str, str] = EVENT_RANGE,
    lines_folder: str | None = None,
) -> Trained:
    """Fit on rows before the split date, evaluate on the rest."""
    starters = starter_like(history, min_pitches=STARTER_MIN_PITCHES, min_batters=STARTER_MIN_BATTERS)
    # Training and every metric read the table again, so it is written once.
    table = materialize(model_table(starters), "model-table")
    train, test = time_split(table, split_date)
    model = train_model(train, params=params)
    scored = [
        materialize(prediction_results(score(model, part).drop("std_dev", "raw_std_dev")), label)
        for part, label in ((train, "scored-train"), (test, "scored-test"))
    ]
    metadata = training_record(
        table,
        *scored,
        lines,
        params=params,
        split_date=split_date,
        event_range=event_range,
        lines_folder=lines_folder,
    )
    return Trained(model, table, metadata)


def build_training_set(
    spark: SparkSession,
    events_path: str,
    lines_folder: str,
    root: str,
    *,
    params: BoostParams = BoostParams(),
    split_date: str = SPLIT_DATE,
    event_range: tuple[str, str] = EVENT_RANGE,
) -> Version:
    """Build all datasets, check and commit them as one version; returns it."""
    with scratch(spark):
        events = read_events(spark, events_path, *event_range)
        history = materialize(entity_history(events), "history")
        lines = materialize(curated_lines_from(spark, lines_folder), "lines")
        trained = train_and_evaluate(
            history, lines, params=params, split_date=split_date, event_range=event_range, lines_folder=lines_folder
        )
        return publish.publish_set(
            spark,
            root,
            history=history,
            table=trained.table,
            lines=lines,
            model=trained.model,
            metadata=trained.metadata,
        )
