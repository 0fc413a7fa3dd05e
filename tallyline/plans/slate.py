"""Slate build: schedule documents to a checked, saved slate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.operators.slate import checked_slate
from tallyline.sources.nested import flatten_schedule


def build_slate(schedule_documents: DataFrame) -> DataFrame:
    return checked_slate(flatten_schedule(schedule_documents))


def save_slate(slate: DataFrame, path: str) -> str:
    slate.orderBy("game_date", "game_pk", "is_home", "player_name").write.mode("overwrite").parquet(path)
    return path
