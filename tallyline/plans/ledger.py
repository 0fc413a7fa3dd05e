"""The ledger table: upsert of official picks and its profit reports.

The ledger is a store of its own (:mod:`tallyline.sources.versions`), cut into buckets by
a hash of its key. An upsert reads and writes the buckets that its keys fall into and
commits them together; all others keep the files they have. Two upserts at once that touch
different buckets both succeed; where they share one, the later one merges again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.ledger import (
    ledger_bucket,
    ledger_by_book,
    ledger_overall,
    ledger_rows,
    one_per_key,
    split_ledger,
    upsert_ledger,
)
from tallyline.schemas import LEDGER as LAYOUT
from tallyline.schemas import LEDGER_COLUMNS
from tallyline.session import materialize
from tallyline.sources import paths, publish, versions
from tallyline.sources.readers import empty_table
from tallyline.sources.versions import Change, Version

LEDGER = "ledger"
# Buckets of a new ledger. One bucket should be small beside a task's memory; a ledger that
# has outgrown them is written anew with more (:func:`replace_ledger`).
BUCKETS = 64
_BUCKET = "_bucket"


def ledger_root(root: str) -> str:
    """The ledger has a folder of its own beside the published sets: it outlives every
    training set."""
    return paths.join(root, LEDGER)


def bucket_folders(version: Version, buckets: Iterable[int] | None = None) -> list[str]:
    """Folders of some buckets, or of all; empty buckets have none."""
    there = version.under(LEDGER)
    return [f for name, f in there.items() if buckets is None or int(name) in set(buckets)]


def read_version(spark: SparkSession, version: Version, buckets: Iterable[int] | None = None) -> DataFrame:
    folders = bucket_folders(version, buckets)
    return spark.read.schema(LAYOUT).parquet(*folders) if folders else empty_table(spark, LAYOUT)


def read_current_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_version(spark, versions.current(spark, ledger_root(root)))


def _write_buckets(rows: DataFrame, store: str, buckets: int, touched: Iterable[int]) -> dict[str, str]:
    """Entries of the written buckets; the rows of a bucket are together in one file."""
    folder = versions.new_data(store, LEDGER)
    placed = rows.select(*LEDGER_COLUMNS, ledger_bucket(buckets).alias(_BUCKET))
    placed.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(paths.join(store, folder))
    return {f"{LEDGER}/{b}": f"{folder}/{_BUCKET}={b}" for b in touched}


def _touched(rows: DataFrame, buckets: int) -> list[int]:
    """The buckets of the rows: at most their fixed number."""
    return sorted(r[0] for r in rows.select(ledger_bucket(buckets)).distinct().collect())


def upsert_rows(spark: SparkSession, new_rows: DataFrame, root: str) -> Version:
    """Merge new rows into the ledger and commit the buckets they fall into."""
    store = ledger_root(root)
    new_rows = materialize(new_rows.select(*LEDGER_COLUMNS), "new-ledger-rows")

    def build(base: Version) -> Change:
        buckets = base.info.get("buckets", BUCKETS)
        touched = _touched(new_rows, buckets)
        if not touched:
            return Change()
        merged = upsert_ledger(read_version(spark, base, touched), new_rows)
        put = _write_buckets(merged, store, buckets, touched)
        return Change(put=put, info={"buckets": buckets}, reads=frozenset(put))

    return versions.commit(spark, store, build)


def replace_ledger(spark: SparkSession, ledger: DataFrame, root: str, *, buckets: int = BUCKETS) -> Version:
    """Write the whole ledger anew, for a first import or with another number of buckets."""
    store = ledger_root(root)
    rows = materialize(one_per_key(ledger), "ledger")

    def build(base: Version) -> Change:
        put = _write_buckets(rows, store, buckets, _touched(rows, buckets))
        drop = frozenset(n for n in base.entries if n.startswith(LEDGER + "/")) - frozenset(put)
        return Change(put=put, drop=drop, info={"buckets": buckets}, reads=frozenset({LEDGER + "/"}))

    return versions.commit(spark, store, build)


def persist_ledger(slate: DataFrame, picks: DataFrame, root: str) -> Version:
    """Upsert the official picks. Saving the same picks twice changes nothing."""
    return upsert_rows(slate.sparkSession, ledger_rows(slate, picks), root)


def ledger_report(ledger: DataFrame) -> dict[str, DataFrame]:
    graded, skipped = split_ledger(ledger)
    return {
        "graded": graded,
        "skipped": skipped,
        "by_book": ledger_by_book(graded),
        "overall": ledger_overall(ledger),
    }


def write_ledger_report(spark: SparkSession, version: Version, folder: str) -> tuple[str, ...]:
    """Write the report of one version of the ledger; returns the names of its tables."""
    report = ledger_report(read_version(spark, version))
    for name in ("graded", "skipped", "by_book"):
        report[name].write.parquet(paths.join(folder, f"ledger_{name}"))
    publish.write_row(report["overall"], paths.join(folder, "ledger_overall"))
    return tuple(f"ledger_{name}" for name in report)
