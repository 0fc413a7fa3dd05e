"""Entity history kept up to date by days: what a delivery of events changes, and no more.

The store holds the history and the form of the batting groups, a folder for each day and
each delivery that wrote it (:mod:`tallyline.sources.versions`). A delivery brings all
events of some days, new ones or corrected ones. Its events are rolled up; the entities and
groups that it touches, in what it brings or in what it replaces, resume their windows
from the last rows before their first touched day, up to the rows that the last touched
day still reaches; and only days that hold such a row are written again. The result is that
of one build over all events.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.contracts import ContractError
from tallyline.operators.rollup import (
    PERIOD_KEYS,
    add_event_flags,
    add_opponent_form,
    event_cells,
    group_periods,
    periods_of_sides,
    sides_of_cells,
)
from tallyline.operators.trailing import (
    ENTITY_DISPERSION,
    ENTITY_MEANS,
    GROUP_FORM,
    MAX_ROWS_PER_TASK,
    PERIOD_ORDER,
    Trailing,
    add_rates,
    add_trailing,
)
from tallyline.schemas import HISTORY_CONTRACT
from tallyline.session import materialize, scratch
from tallyline.sources import paths, versions
from tallyline.sources.checked import write_checked
from tallyline.sources.readers import empty_table
from tallyline.sources.versions import Change, Version

HISTORY, GROUPS = "history", "group_form"
_DAY, _FIRST, _LAST, _CONTEXT = "_day", "_first", "_last", "_context"


@dataclass(frozen=True)
class Update:
    """A committed delivery: what came, and what was written because of it."""

    version: Version
    days_delivered: int
    entities_touched: int
    groups_touched: int
    history_days_written: int
    group_days_written: int


def read_days(spark: SparkSession, version: Version, group: str, layout: StructType, days: Iterable[str] | None = None) -> DataFrame:
    """The stored rows of some days, or of all; one scan whatever wrote them."""
    there = version.under(group)
    folders = [f for day, f in there.items() if days is None or day in set(days)]
    return spark.read.schema(layout).parquet(*folders) if folders else empty_table(spark, layout)


def stored_history(spark: SparkSession, root: str) -> DataFrame:
    """The whole history as of the newest version."""
    version = versions.current(spark, root)
    if "layout" not in version.info:
        raise FileNotFoundError(f"no history under {root}")
    return read_days(spark, version, HISTORY, _layout(version, HISTORY))


def _layout(version: Version, group: str) -> StructType:
    return StructType.fromJson(version.info["layout"][group])


def _days(*tables: DataFrame) -> list[str]:
    """The days of some tables as text: bounded by the calendar."""
    found = reduce(DataFrame.unionByName, [t.select(F.col("game_date").cast("string").alias("d")) for t in tables])
    return sorted(r["d"] for r in found.distinct().collect())


def _of_days(column: str, days: Sequence[str]) -> Column:
    return F.col(column).isin([F.lit(d).cast("date") for d in days]) if days else F.lit(False)


def touched_keys(key: str, *sides: DataFrame) -> DataFrame:
    """Rows (key, first and last touched day) of what a delivery brings and what it replaces."""
    rows = reduce(DataFrame.unionByName, [s.select(key, "game_date") for s in sides]).filter(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.min("game_date").alias(_FIRST), F.max("game_date").alias(_LAST))


def resumed(
    stored: DataFrame, new: DataFrame, touched: DataFrame, key: str, stats: Sequence[Trailing], max_rows_per_task: int | None
) -> DataFrame:
    """The rows that a delivery changes, with new trailing statistics: of each touched key
    those from its first touched day to the last one that its last touched day reaches. The
    rows before them that their windows see only take part."""
    reach = max(s.rows for s in stats)
    raw = [c for c in new.columns]
    rows = stored.select(*raw).join(touched, key)
    before, after = F.col("game_date") < F.col(_FIRST), F.col("game_date") > F.col(_LAST)
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in PERIOD_ORDER])
    oldest = Window.partitionBy(key).orderBy(*PERIOD_ORDER)

    def nearest(side: Column, window) -> DataFrame:
        # A window group limit: each map task keeps so many rows of a key.
        ranked = rows.filter(side).withColumn("_rn", F.row_number().over(window))
        return ranked.filter(F.col("_rn") <= reach).drop("_rn")

    inside = rows.filter(~before & ~after).unionByName(new.join(touched, key))
    parts = [nearest(before, newest), inside, nearest(after, oldest)]
    whole = reduce(DataFrame.unionByName, parts).withColumn(_CONTEXT, before).select(*raw, _CONTEXT)
    # The search for hot keys and the windows read it.
    whole = materialize(whole, "resumed")
    formed = add_trailing(whole, (key,), PERIOD_ORDER, stats, max_rows_per_task=max_rows_per_task)
    return formed.filter(~F.col(_CONTEXT)).drop(_CONTEXT)


def _write_days(df: DataFrame, root: str, group: str, days: Sequence[str]) -> dict[str, str]:
    """Entries of the days that hold rows. The day stays a column of the files, too; AQE
    makes files of even size, a large day more than one."""
    folder = versions.new_data(root, group)
    by_day = df.withColumn(_DAY, F.col("game_date").cast("string")).hint("rebalance", F.col(_DAY))
    by_day.write.partitionBy(_DAY).parquet(paths.join(root, folder))
    return {f"{group}/{day}": f"{folder}/{_DAY}={day}" for day in days}


def update_history(
    spark: SparkSession,
    root: str,
    events: DataFrame,
    *,
    days: Iterable[str] | None = None,
    strict: bool = True,
    max_rows_per_task: int | None = MAX_ROWS_PER_TASK,
) -> Update:
    """Take in all events of some days and commit the history that follows. ``days`` names
    days that are delivered without any event, so that rows they had go away; the days of
    the events need not be named. Delivering the same events again changes no row."""
    with scratch(spark):
        # The delivery is read once; what it rolls up to serves every attempt to commit.
        cells = event_cells(add_event_flags(events)).filter("game_date is not null and game_pk is not null")
        cells = materialize(cells, "cells")
        periods = periods_of_sides(materialize(sides_of_cells(cells), "sides"), cells)
        if strict:
            periods = write_checked(periods, replace(HISTORY_CONTRACT, allow_empty=True)).good
        else:
            periods = materialize(periods, "periods")
        groups = materialize(group_periods(cells, strikeouts="strikeouts"), "groups")
        delivered = sorted({*_days(cells), *(days or ())})
        if strict and not delivered:
            raise ContractError("a delivery without events names no days")
        made: dict = {}

        def build(base: Version) -> Change:
            change, counts = _change(spark, base, periods, groups, delivered, max_rows_per_task)
            made.update(counts)
            return change

        version = versions.commit(spark, root, build)
    return Update(version, len(delivered), **made)


def _change(
    spark: SparkSession, base: Version, periods: DataFrame, groups: DataFrame, delivered: list[str], limit: int | None
) -> tuple[Change, dict]:
    stats = ENTITY_MEANS + ENTITY_DISPERSION
    if "layout" in base.info:
        layouts = {g: _layout(base, g) for g in (HISTORY, GROUPS)}
    else:
        # What the windows and the join add, from the plan alone.
        empty = add_trailing(groups.limit(0), ("batting_team",), PERIOD_ORDER, GROUP_FORM, max_rows_per_task=None)
        formed = add_trailing(periods.limit(0), ("pitcher",), PERIOD_ORDER, stats, max_rows_per_task=None)
        layouts = {HISTORY: add_rates(add_opponent_form(formed, empty)).schema, GROUPS: empty.schema}
    kept = {g: sorted(set(base.under(g)) - set(delivered)) for g in layouts}
    replaced = {g: read_days(spark, base, g, layouts[g], delivered) for g in layouts}
    stored = {g: read_days(spark, base, g, layouts[g], kept[g]) for g in layouts}

    entities = materialize(touched_keys("pitcher", periods, replaced[HISTORY]), "touched")
    teams = materialize(touched_keys("batting_team", groups, replaced[GROUPS]), "touched-groups")
    new_form = resumed(stored[GROUPS], groups, teams, "batting_team", GROUP_FORM, limit)
    new_form = materialize(new_form, "new-group-form")
    new_rows = materialize(resumed(stored[HISTORY], periods, entities, "pitcher", stats, limit), "new-rows")

    # Days with a row that changed by itself, or whose opponents' form did.
    group_days = _days(new_form)
    history_days = sorted({*_days(new_rows), *(d for d in group_days if d in kept[HISTORY])})
    group_key = ["game_date", "game_pk", "batting_team"]
    same_groups = read_days(spark, base, GROUPS, layouts[GROUPS], set(history_days + group_days) & set(kept[GROUPS]))
    form = same_groups.join(new_form.select(*group_key), group_key, "left_anti").unionByName(new_form)
    form = materialize(form, "group-form")
    same_rows = read_days(spark, base, HISTORY, layouts[HISTORY], set(history_days) & set(kept[HISTORY]))
    same_rows = same_rows.join(new_rows.select(*PERIOD_KEYS), list(PERIOD_KEYS), "left_anti")
    rows = same_rows.select(*new_rows.columns).unionByName(new_rows)
    history = add_rates(add_opponent_form(rows, form)).select(*layouts[HISTORY].names)

    put = _write_days(history, base.root, HISTORY, history_days) if history_days else {}
    if group_days:
        put |= _write_days(form.filter(_of_days("game_date", group_days)), base.root, GROUPS, group_days)
    emptied = {f"{g}/{d}" for g in layouts for d in delivered if f"{g}/{d}" in base.entries} - set(put)
    counts = {
        "entities_touched": entities.count(),
        "groups_touched": teams.count(),
        "history_days_written": len(history_days),
        "group_days_written": len(group_days),
    }
    layout = {g: s.jsonValue() for g, s in layouts.items()}
    change = Change(put, frozenset(emptied), {"layout": layout}, frozenset({HISTORY + "/", GROUPS + "/"}))
    return change, counts

