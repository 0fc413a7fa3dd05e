"""Curation of the snapshot stream with state: a watermark, a state store and an upsert.

The stream keeps the best snapshot of each key and day of pulling as state, and forgets a
day once the watermark has passed it, so its state is bounded by what can still arrive.
Every micro-batch hands on the keys whose best has changed; they are merged into a store of
curated lines by day (:mod:`tallyline.sources.versions`), one row a key, of which only the
days of the batch are written. A version notes its batch, so that a batch that runs twice is
merged once, and old versions are forgotten as new ones come.

Curation is a maximum in a total order, so the best of the bests is the best of all: within
the watermark the store holds what curating all snapshots at once gives. Snapshots behind the
watermark are dropped by the stream and counted (:func:`late_rows`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.lines import CURATION_KEYS, before_start, curate_lines, normalize_snapshots
from tallyline.schemas import CURATED_LINE, MARKET_KEY
from tallyline.session import materialize
from tallyline.sources import paths, versions
from tallyline.sources.readers import empty_table
from tallyline.sources.versions import Change

LINES, _DAY, _TIME = "curated_lines", "_day", "_time"
DELAY, SPAN = "2 days", "1 day"
KEEP_VERSIONS = 5


def _best(columns: list[str]) -> Column:
    """The order of curation as one value: its greatest is the row that curation keeps."""
    first = [before_start(), F.coalesce("pulled_at", "commence_time")]
    named = ["snapshot_rank", "line", "price", "event_id", "player_name"]
    rest = [c for c in columns if c not in named]
    return F.struct(*[c.alias(f"_{i}") for i, c in enumerate(first)], *named, *rest)


def best_by_day(snapshots: DataFrame, *, delay: str = DELAY, span: str = SPAN) -> DataFrame:
    """The best snapshot of each key and span of pulling, as stream state. A snapshot that
    does not say when it was pulled counts at its start, else at its day."""
    when = F.coalesce("pulled_at", "commence_time", F.to_timestamp("game_date"))
    present = F.lit(True)
    for k in CURATION_KEYS:
        present = present & F.col(k).isNotNull()
    stamped = snapshots.filter(present).withColumn(_TIME, when).withWatermark(_TIME, delay)
    best = stamped.groupBy(F.window(_TIME, span), *CURATION_KEYS).agg(F.max(_best(CURATED_LINE.names)).alias("_best"))
    return best.select(*[F.col("_best")[c].alias(c) for c in CURATED_LINE.names])


def merge_lines(spark: SparkSession, root: str, lines: DataFrame, batch: int) -> versions.Version:
    """Merge the lines of a micro-batch into the store and commit the days they are of."""

    def build(base: versions.Version) -> Change:
        if base.info.get("batch", -1) >= batch:
            return Change()
        # Bounded by the calendar.
        days = sorted(r["game_date"] for r in lines.select("game_date").distinct().collect())
        if not days:
            return Change(info={"batch": batch})
        known = base.under(LINES)
        stored = [known[d] for d in days if d in known]
        old = spark.read.schema(CURATED_LINE).parquet(*stored) if stored else empty_table(spark, CURATED_LINE)
        merged = curate_lines(old.unionByName(lines), strict=False)
        folder = versions.new_data(root, LINES)
        by_day = merged.withColumn(_DAY, F.col("game_date")).hint("rebalance", F.col(_DAY))
        by_day.write.partitionBy(_DAY).parquet(paths.join(root, folder))
        put = {f"{LINES}/{d}": f"{folder}/{_DAY}={d}" for d in days}
        return Change(put=put, info={"batch": batch}, reads=frozenset({*put}))

    return versions.commit(spark, root, build)


def curate_stateful(
    snapshots: DataFrame,
    root: str,
    checkpoint: str,
    *,
    market_key: str = MARKET_KEY,
    delay: str = DELAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Curate a stream of snapshots into the store at ``root``."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_lines(spark, root, materialize(batch, "batch"), batch_id)
        versions.expire(spark, root, keep=KEEP_VERSIONS)

    best = best_by_day(normalize_snapshots(snapshots, market_key=market_key), delay=delay)
    writer = best.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def current_lines(spark: SparkSession, root: str) -> DataFrame:
    """The curated lines of the newest version."""
    folders = list(versions.current(spark, root).under(LINES).values())
    return spark.read.schema(CURATED_LINE).parquet(*folders) if folders else empty_table(spark, CURATED_LINE)


def late_rows(query: StreamingQuery) -> int:
    """How many rows the stream has dropped behind its watermark, as far as its progress
    is still known."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """How many keys the stream holds as state after its last batch."""
    last = query.lastProgress
    return sum(s["numRowsTotal"] for s in last["stateOperators"]) if last else 0
