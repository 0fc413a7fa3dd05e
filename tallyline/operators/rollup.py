"""Events to entity-period and group-period rows.

The distinct count of opponents is planned by Spark as a two-level aggregation (first
per key and opponent, then per key), so a hot entity is spread over tasks and combined
before each shuffle. Grouping keys that are NULL form no group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.contracts import require_columns
from tallyline.functions.numeric import nan_to_null, safe_ratio

# Event codes that count as a strikeout and as a whiff.
STRIKEOUT_EVENTS = ("strikeout", "strikeout_double_play")
WHIFF_DESCRIPTIONS = ("swinging_strike", "swinging_strike_blocked")

PERIOD_KEYS = ("game_date", "game_pk", "pitcher")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _present(*columns: str) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present


def add_event_flags(events: DataFrame) -> DataFrame:
    """0/1 columns ``is_k`` and ``is_whiff``; a missing code counts as 0."""
    require_columns(events, ("events", "description"), "events")
    return events.withColumns(
        {
            "is_k": _flag(F.col("events").isin(*STRIKEOUT_EVENTS)),
            "is_whiff": _flag(F.col("description").isin(*WHIFF_DESCRIPTIONS)),
        }
    )


def _in_top_half() -> Column:
    return F.coalesce(F.col("inning_topbot") == "Top", F.lit(False))


def fielding_group() -> Column:
    """The home side fields in the top half, otherwise the away side."""
    return F.when(_in_top_half(), F.col("home_team")).otherwise(F.col("away_team"))


def fielding_opponent() -> Column:
    return F.when(fielding_group() == F.col("home_team"), F.col("away_team")).otherwise(F.col("home_team"))


def batting_group() -> Column:
    return F.when(_in_top_half(), F.col("away_team")).otherwise(F.col("home_team"))


# What events are grouped by, here or later, besides the half of the inning.
CELL_KEYS = PERIOD_KEYS + ("player_name", "home_team", "away_team", "p_throws", "batter")


def event_cells(flagged: DataFrame, *, halves: bool = True) -> DataFrame:
    """Events counted by all that the rollups group by. Text is a key here and every buffer
    a number, so tasks hash the events and never sort them; what the rollups sort
    is one row per batter an entity met in a period. With ``halves`` the sides are known.

    Events are dealt by entity and period before they are counted. Most cells hold an event
    or two, so counting in the map tasks would fill their memory with nearly all the events
    of a file and spill. The cells of a period stay together, so what reads a written copy
    of them counts them down in its map tasks."""
    keys = CELL_KEYS + ("inning_topbot",) * halves
    counted = ("pitch_type", "is_k", "is_whiff", "release_speed", "release_spin_rate")
    require_columns(flagged, keys + counted, "events")
    velo, spin = nan_to_null(F.col("release_speed")), nan_to_null(F.col("release_spin_rate"))
    dealt = flagged.select(*keys, *counted).repartition(*PERIOD_KEYS)
    return dealt.groupBy(*keys).agg(
        F.count("pitch_type").alias("pitches"),
        F.sum("is_k").cast("long").alias("strikeouts"),
        F.sum("is_whiff").cast("long").alias("whiffs"),
        F.sum(velo).alias("sum_velo"),
        F.count(velo).alias("n_velo"),
        F.sum(spin).alias("sum_spin"),
        F.count(spin).alias("n_spin"),
    )


ENTITY_KEYS = PERIOD_KEYS + ("player_name",)


def _rolled_up(cells: DataFrame, *more: Column, batters: Column | None = None) -> DataFrame:
    periods = (
        cells.filter(_present(*ENTITY_KEYS))
        .groupBy(*ENTITY_KEYS)
        .agg(
            *[F.sum(c).alias(c) for c in ("pitches", "strikeouts", "whiffs")],
            safe_ratio(F.sum("sum_velo"), F.sum("n_velo")).alias("avg_velo"),
            safe_ratio(F.sum("sum_spin"), F.sum("n_spin")).alias("avg_spin"),
            (F.count_distinct("batter") if batters is None else batters).alias("batters_faced"),
            *[F.min(c).alias(c) for c in ("home_team", "away_team", "p_throws")],
            *more,
        )
    )
    return periods.withColumn("whiff_per_pitch", safe_ratio(F.col("whiffs"), F.col("pitches")))


def entity_periods(flagged: DataFrame) -> DataFrame:
    """One row per entity and period with its counts, means and whiff rate."""
    return _rolled_up(event_cells(flagged, halves=False))


def fielding_lookup(events: DataFrame) -> DataFrame:
    """Fielding and opposing group of every entity-period."""
    require_columns(events, PERIOD_KEYS + ("home_team", "away_team", "inning_topbot"), "events")
    sides = events.filter(_present(*PERIOD_KEYS)).select(
        *PERIOD_KEYS, fielding_group().alias("pitching_team"), fielding_opponent().alias("opponent_team")
    )
    # Counted first, which hashes, as text is a key there; the text minima, which sort, then
    # see a row or two per period. Spark would drop a distinct below a minimum.
    return (
        sides.groupBy(*sides.columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*PERIOD_KEYS)
        .agg(F.min("pitching_team").alias("pitching_team"), F.min("opponent_team").alias("opponent_team"))
    )


def add_group_info(periods: DataFrame, events: DataFrame) -> DataFrame:
    """Entity-periods with their groups, joined from the event table."""
    require_columns(periods, PERIOD_KEYS + ("player_name",), "entity_periods")
    return periods.join(fielding_lookup(events), list(PERIOD_KEYS), "left")


def _sides() -> list[Column]:
    return [F.min(fielding_group()).alias("pitching_team"), F.min(fielding_opponent()).alias("opponent_team")]


def periods_of_cells(cells: DataFrame) -> DataFrame:
    """Entity-periods with their groups from :func:`event_cells`: both group on the same keys,
    so the groups are two more aggregates, not a join."""
    return _rolled_up(cells, *_sides())


def sides_of_cells(cells: DataFrame) -> DataFrame:
    """:func:`event_cells` with halves, counted by all their keys but the batter: one row for
    nearly every entity-period. Text is a key here too, so the cells are hashed, not sorted.
    A batter has one cell in a side."""
    keys = [*(k for k in CELL_KEYS if k != "batter"), "inning_topbot"]
    sums = ("pitches", "strikeouts", "whiffs", "sum_velo", "n_velo", "sum_spin", "n_spin")
    counted = cells.filter(_present(*ENTITY_KEYS)).groupBy(*keys)
    return counted.agg(*[F.sum(c).alias(c) for c in sums], F.count("batter").alias("batters"))


def periods_of_sides(sides: DataFrame, cells: DataFrame) -> DataFrame:
    """:func:`periods_of_cells` from :func:`sides_of_cells`, both written copies. Batters of
    periods with several sides may stand in more than one; they are counted from the cells.
    One aggregate job looks for such periods."""
    periods = _rolled_up(sides, *_sides(), batters=F.sum("batters"))
    several = sides.groupBy(*ENTITY_KEYS).agg(F.count(F.lit(1)).alias("_sides")).filter("_sides > 1")
    if several.isEmpty():
        return periods
    met = cells.join(several, list(ENTITY_KEYS), "left_semi")
    recounted = met.groupBy(*ENTITY_KEYS).agg(F.count_distinct("batter").alias("_batters"))
    faced = F.coalesce("_batters", "batters_faced")
    return periods.join(recounted, list(ENTITY_KEYS), "left").withColumn("batters_faced", faced).drop("_batters")


def entity_periods_with_groups(flagged: DataFrame) -> DataFrame:
    """:func:`entity_periods` and :func:`add_group_info` in one pass over the events."""
    return periods_of_cells(event_cells(flagged))


def group_periods(flagged: DataFrame, *, strikeouts: str = "is_k") -> DataFrame:
    """One row per batting group and period: strikeouts, distinct batters, rate. The rows are
    events or, with their column of ``strikeouts``, :func:`event_cells`. They are dealt by
    group and period once: counting them by batter in the map tasks would merge few of them."""
    require_columns(
        flagged, ("game_date", "game_pk", "inning_topbot", "away_team", "home_team", strikeouts, "batter"), "events"
    )
    keys = ("game_date", "game_pk", "batting_team")
    grouped = (
        flagged.withColumn("batting_team", batting_group())
        .filter(_present(*keys))
        .select(*keys, "batter", F.col(strikeouts).alias("_k"))
        .repartition(*keys)
        .groupBy(*keys, "batter")
        .agg(F.sum("_k").alias("_k"))
        .groupBy(*keys)
        .agg(F.sum("_k").cast("long").alias("team_batter_strikeouts"), F.count("batter").alias("batters_faced"))
    )
    return grouped.withColumn("team_k_rate", safe_ratio(F.col("team_batter_strikeouts"), F.col("batters_faced")))


def add_opponent_form(periods: DataFrame, group_form: DataFrame) -> DataFrame:
    """Left join of the opponent's trailing form on (period, opponent). The right side
    is unique on the join key, so no row fans out."""
    require_columns(periods, ("game_date", "game_pk", "opponent_team"), "entity_periods")
    form = group_form.select(
        "game_date",
        "game_pk",
        F.col("batting_team").alias("opponent_team"),
        "opp_strikeouts_per_game_last10",
        "opp_k_rate_last10",
    )
    return periods.join(form, ["game_date", "game_pk", "opponent_team"], "left")


def starter_like(periods: DataFrame, *, min_pitches: int, min_batters: int) -> DataFrame:
    """Appearances with the workload of a starter."""
    require_columns(periods, ("pitches", "batters_faced"), "entity_periods")
    return periods.filter((F.col("pitches") >= min_pitches) | (F.col("batters_faced") >= min_batters))

