"""Market line snapshots: canonical form and curation to one line per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import check_contract, require_columns
from tallyline.functions.dates import day_text, instant_of
from tallyline.functions.names import quote_name
from tallyline.functions.numeric import blank_to_null, strip, to_number
from tallyline.schemas import (
    CURATED_LINE,
    LINE_SOURCE,
    LINES_CONTRACT,
    MARKET_KEY,
    RAW_LINE_COLUMNS,
    SELECTION_RULE,
    SNAPSHOT_TYPE,
)

CURATION_KEYS = ("game_date", "player_name_norm", "bookmaker", "side")


def optional(df: DataFrame, name: str, default=None, type_name: str = "string") -> Column:
    """A column of the table, or a typed literal where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(default).cast(type_name)


def _instant(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("timestamp")
    return instant_of(F.col(name), df.schema[name].dataType.typeName())


def _day(c: Column) -> Column:
    """The day as text. A value that is no date is an error, not a row less."""
    wrong = F.raise_error(F.concat(F.lit("game_date is no date: "), c.cast("string"))).cast("string")
    return F.coalesce(day_text(c), F.when(blank_to_null(c.cast("string")).isNotNull(), wrong))


def normalize_snapshots(
    raw: DataFrame,
    *,
    market_key: str = MARKET_KEY,
    selection_rule: str = SELECTION_RULE,
    default_source: str = LINE_SOURCE,
) -> DataFrame:
    """Snapshots of one market in the 17-column line layout."""
    require_columns(raw, RAW_LINE_COLUMNS, "raw_lines")
    book = strip(F.col("bookmaker"))
    name = strip(F.col("player_name"))
    chosen = {
        "game_date": _day(F.col("game_date")),
        "player_name": name,
        "player_name_norm": quote_name(name),
        "market_key": F.col("market_key"),
        "bookmaker": book,
        "bookmaker_key": F.coalesce(blank_to_null(optional(raw, "bookmaker_key")), book),
        "side": strip(F.col("side")),
        "line": to_number(F.col("line")),
        "price": to_number(F.col("price")),
        "event_id": optional(raw, "event_id").cast("string"),
        "commence_time": _instant(raw, "commence_time"),
        "selection_rule": F.coalesce(optional(raw, "selection_rule"), F.lit(selection_rule)),
        "source": F.coalesce(optional(raw, "source"), F.lit(default_source)),
        "pulled_at": _instant(raw, "pulled_at"),
        "snapshot_type": F.coalesce(optional(raw, "snapshot_type"), F.lit(SNAPSHOT_TYPE)),
        "is_closing_line": F.lit(False),
        "snapshot_rank": to_number(optional(raw, "snapshot_rank")),
    }
    of_market = raw.filter(F.col("market_key") == market_key)
    return of_market.select(*[chosen[c].alias(c) for c in CURATED_LINE.names])


def before_start() -> Column:
    """True for a snapshot pulled at or before the start of its game."""
    return F.coalesce(F.col("pulled_at") <= F.col("commence_time"), F.lit(False))


def curate_lines(
    snapshots: DataFrame,
    *,
    selection_rule: str = SELECTION_RULE,
    keys: Sequence[str] = CURATION_KEYS,
    strict: bool = True,
) -> DataFrame:
    """One line per key: the latest snapshot before the start, else the latest at all.

    Rows before the start sort first, so the winner itself tells whether the key had
    one. Only one row per key leaves a map task. The choice is a maximum in a total
    order: curating curated rows together with newer snapshots gives the same answer
    as curating everything at once.
    """
    require_columns(
        snapshots, ("line", "price", "selection_rule", "source", "player_name", *keys), "line_snapshots"
    )
    best = [
        before_start().desc(),
        F.coalesce("pulled_at", "commence_time").desc_nulls_last(),
        F.col("snapshot_rank").desc_nulls_last(),
        F.col("line").desc_nulls_last(),
        F.col("price").desc_nulls_last(),
        F.col("event_id").desc_nulls_last(),
        F.col("player_name").desc_nulls_last(),
    ]
    # Whatever else differs decides ties, so the answer never follows the order of the input.
    named = {"pulled_at", "commence_time", "snapshot_rank", "line", "price", "event_id", "player_name", *keys}
    best += [F.col(c).desc_nulls_last() for c in CURATED_LINE.names if c in snapshots.columns and c not in named]
    best += [F.col(c).desc_nulls_last() for c in ("pulled_at", "commence_time") if c in snapshots.columns]
    present = snapshots.filter(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    ranked = present.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*best)))
    curated = (
        ranked.filter("_rn = 1")
        .withColumns({"selection_rule": F.lit(selection_rule), "is_closing_line": before_start()})
        .select(*CURATED_LINE.names)
    )
    # The keys are unique by construction, so only the values are checked.
    return check_contract(curated, replace(LINES_CONTRACT, unique=()), strict=strict)
