"""Curated lines from the raw snapshot log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.lines import curate_lines, normalize_snapshots
from tallyline.schemas import MARKET_KEY, SELECTION_RULE
from tallyline.sources import paths, publish
from tallyline.sources.snapshots import read_snapshots


def curated_lines(raw: DataFrame, *, market_key: str = MARKET_KEY, selection_rule: str = SELECTION_RULE) -> DataFrame:
    snapshots = normalize_snapshots(raw, market_key=market_key, selection_rule=selection_rule)
    return curate_lines(snapshots, selection_rule=selection_rule)


def curated_lines_from(spark: SparkSession, folder: str, **options) -> DataFrame:
    return curated_lines(read_snapshots(spark, folder), **options)


def lines_root(root: str) -> str:
    return paths.join(root, "lines")


def publish_lines(spark: SparkSession, folder: str, root: str) -> tuple[str, int]:
    """Rebuild the lines published by themselves, beside the sets, whose lines stay those
    of their model; returns their folder and number of rows."""
    latest = publish.publish_table(curated_lines_from(spark, folder), lines_root(root), publish.LINES)
    return latest.path(publish.LINES), spark.read.parquet(latest.path(publish.LINES)).count()
