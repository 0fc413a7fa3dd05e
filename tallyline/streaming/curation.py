"""Curation of the growing snapshot log as a stream of dropped files.

Curation is a maximum in a total order, so it can be done in steps: every micro-batch
is curated on its own and its winners are appended to a log; curating that log again
gives exactly the answer of curating all snapshots at once. The stream holds no state
and needs no watermark, so no late snapshot is dropped, and a batch that runs twice
after a failure only appends the same winners again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from tallyline.operators.lines import curate_lines, normalize_snapshots
from tallyline.schemas import MARKET_KEY, RAW_LINE_COLUMNS, layout

OPTIONAL_COLUMNS = (
    "bookmaker_key",
    "event_id",
    "commence_time",
    "pulled_at",
    "snapshot_type",
    "source",
    "selection_rule",
    "snapshot_rank",
)


def snapshot_layout(columns: tuple[str, ...] = RAW_LINE_COLUMNS + OPTIONAL_COLUMNS) -> StructType:
    return layout(*[(c, StringType()) for c in columns])


def snapshot_stream(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """Stream over the landed snapshot table (see ``land_snapshots``), whose columns
    are matched by name whatever the header order of the source files was."""
    return spark.readStream.schema(schema or snapshot_layout()).option("recursiveFileLookup", True).parquet(folder)


def curate_stream(
    snapshots: DataFrame, log: str, checkpoint: str, *, market_key: str = MARKET_KEY, trigger: dict | None = None
) -> StreamingQuery:
    """Append the winners of every micro-batch to the log, one folder per day."""

    def append(batch: DataFrame, batch_id: int) -> None:
        winners = curate_lines(normalize_snapshots(batch, market_key=market_key), strict=False)
        winners.write.mode("append").partitionBy("game_date").parquet(log)

    writer = snapshots.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def curated_from_log(spark: SparkSession, log: str) -> DataFrame:
    """Current curated lines. Writing this back as a new log compacts it."""
    winners = spark.read.parquet(log)
    return curate_lines(winners.withColumn("game_date", winners["game_date"].cast("string")))
