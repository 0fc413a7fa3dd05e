"""Serving features of a slate with the opponent context as of its first day, or of each row's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyline.operators.serving import serving_features
from tallyline.operators.trailing import group_context


def slate_features(
    slate: DataFrame,
    history: DataFrame,
    *,
    strict: bool = True,
    observation: Observation | None = None,
    context_per_row: bool = False,
) -> DataFrame:
    """One context date for the whole slate, its earliest day; or, for a slate of many days,
    the day of each row."""
    if context_per_row:
        return serving_features(slate, history, strict=strict, observation=observation, context_per_row=True)
    first_day = slate.agg(F.min("game_date")).scalar()
    context = group_context(history, first_day)
    return serving_features(slate, history, context, strict=strict, observation=observation)
