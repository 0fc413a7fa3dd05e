"""Trailing statistics over the prior rows of a key.

``rowsBetween(-n, -1)`` never sees the current row, so the features are leak-free. All
frames of one key and order share one shuffle, one sort and one window node.

A window puts all rows of a key into one task. A key with more rows than one task
should hold is therefore cut into consecutive blocks, and every block gets a copy of
the last ``n`` rows before it. The frames inside a block then see exactly the rows they
would see in the uncut key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import require_columns
from tallyline.functions.numeric import safe_ratio
from tallyline.session import materialize

MAX_ROWS_PER_TASK = 2_000_000
# Cuts of an oversized unit (a key on one day) for each block that its rows fill, and the
# most cuts of one; a block beyond that grows with its unit, and the sort of a task spills.
CUTS_PER_BLOCK, MOST_CUTS = 4, 10_000


@dataclass(frozen=True)
class Trailing:
    """One trailing statistic: ``kind`` is mean, std (population) or a quantile."""

    column: str
    output: str
    rows: int
    min_rows: int
    kind: str | float = "mean"


def _value(stat: Trailing, frame) -> Column:
    if stat.kind == "mean":
        value = F.avg(stat.column)
    elif stat.kind == "std":
        value = F.stddev_pop(stat.column)
    else:
        value = F.percentile(stat.column, float(stat.kind))
    return F.when(F.count(stat.column).over(frame) >= stat.min_rows, value.over(frame))


def _with_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str], stats: Sequence[Trailing]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({s.output: _value(s, window.rowsBetween(-s.rows, -1)) for s in stats})


def add_trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    stats: Sequence[Trailing],
    *,
    max_rows_per_task: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add trailing statistics per key.

    ``order`` is a total order inside a key; its first column is the calendar unit hot
    keys are cut on, its second a number that cuts an oversized unit further. One
    aggregate job looks for hot keys; ``max_rows_per_task=None`` skips it for keys
    whose size is known to be bounded.
    """
    require_columns(df, [*keys, *order, *(s.column for s in stats)], "trailing input")
    if max_rows_per_task is None:
        return _with_stats(df, keys, order, stats)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows_per_task)
    if hot.isEmpty():
        return _with_stats(df, keys, order, stats)
    return _blockwise(materialize(df, "trailing"), keys, order, stats, max_rows_per_task)


def _unit_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """(key, unit) -> ``_cuts``: the values of the second order column at which an
    oversized unit is cut, as many as the rows of the largest one ask for. Any cuts are
    correct; quantiles make them even. The digests are built in the map tasks, so no unit
    is gathered."""
    unit, sequence = order[0], order[1]
    place = [*keys, unit]
    counted = df.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    large = materialize(counted, "large-units")
    most = large.agg(F.max("_rows")).first()[0] or 0
    cuts = min(MOST_CUTS, max(2, CUTS_PER_BLOCK * -(-most // limit)))
    steps = [i / cuts for i in range(1, cuts)]
    digest = F.percentile_approx(sequence, steps, 10 * cuts).alias("_cuts")
    found = df.join(large.select(*place), place, "left_semi").groupBy(*place).agg(digest)
    return found.select(*place, F.array_distinct("_cuts").alias("_cuts"))


def _blockwise(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], stats: Sequence[Trailing], limit: int
) -> DataFrame:
    unit = order[0]
    columns = df.columns
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit).drop("_rows")

    if len(order) > 1:
        cuts = _unit_cuts(df.join(hot, list(keys), "left_semi"), keys, order, limit)
        located = df.join(cuts, [*keys, unit], "left").withColumn(
            "_part",
            F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col(order[1]))), F.lit(0)),
        ).drop("_cuts")
    else:
        located = df.withColumn("_part", F.lit(0))

    # Rows per (hot key, unit, part), a number of rows bounded by the calendar, then
    # consecutive parts are gathered into blocks of about ``limit`` rows.
    place = [*keys, unit, "_part"]
    before = Window.partitionBy(*keys).orderBy(unit, "_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        located.join(hot, list(keys), "left_semi")
        .groupBy(*place)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select(*place, F.floor(F.col("_before") / limit).cast("long").alias("_block"))
    )
    blocked = located.join(blocks, place, "left")

    # The last rows of every block travel on to the next blocks. The first of them in
    # each block looks back over the earlier blocks only.
    reach = max(s.rows for s in stats)
    in_hot = blocked.filter(F.col("_block").isNotNull())
    newest = Window.partitionBy(*keys, "_block").orderBy(*[F.col(c).desc() for c in order])
    tails = in_hot.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= reach)
    along = Window.partitionBy(*keys).orderBy("_block", F.col("_rn").desc())
    carried = (
        tails.withColumn("_carried", F.collect_list(F.struct(*columns)).over(along.rowsBetween(-reach, -1)))
        .withColumn("_first", F.lag("_block").over(along).isNull() | (F.lag("_block").over(along) < F.col("_block")))
        .filter("_first")
        .select(F.explode("_carried").alias("_row"), F.col("_block").alias("_into"))
        .select("_row.*", F.col("_into").alias("_block"), F.lit(True).alias("_copy"))
    )
    rows = blocked.select(*columns, F.coalesce("_block", F.lit(0)).alias("_block"), F.lit(False).alias("_copy"))
    together = rows.unionByName(carried.select(*rows.columns))
    done = _with_stats(together, [*keys, "_block"], order, stats)
    return done.filter(~F.col("_copy")).drop("_block", "_copy")


# The trailing features of the public data model.
ENTITY_MEANS = tuple(
    stat
    for column in ("strikeouts", "pitches", "batters_faced", "whiff_per_pitch", "avg_velo", "avg_spin")
    for stat in (Trailing(column, f"{column}_last3", 3, 1), Trailing(column, f"{column}_last10", 10, 3))
)
ENTITY_DISPERSION = (
    Trailing("strikeouts", "strikeouts_stddev_last10", 10, 3, "std"),
    Trailing("strikeouts", "strikeouts_p25_last10", 10, 3, 0.25),
    Trailing("strikeouts", "strikeouts_p75_last10", 10, 3, 0.75),
)
GROUP_FORM = (
    Trailing("team_batter_strikeouts", "opp_strikeouts_per_game_last10", 10, 3),
    Trailing("team_k_rate", "opp_k_rate_last10", 10, 3),
)
PERIOD_ORDER = ("game_date", "game_pk")


def add_entity_form(periods: DataFrame, **options) -> DataFrame:
    """Trailing means and dispersion of every entity."""
    return add_trailing(periods, ("pitcher",), PERIOD_ORDER, ENTITY_MEANS + ENTITY_DISPERSION, **options)


def add_group_form(group_periods: DataFrame, **options) -> DataFrame:
    """Trailing strikeout form of every batting group."""
    return add_trailing(group_periods, ("batting_team",), PERIOD_ORDER, GROUP_FORM, **options)


def add_rates(periods: DataFrame) -> DataFrame:
    """Rates of the trailing means."""
    require_columns(periods, ("strikeouts_last10", "pitches_last10", "batters_faced_last10"), "entity_periods")
    return periods.withColumns(
        {
            "k_per_pitch_last10": safe_ratio(F.col("strikeouts_last10"), F.col("pitches_last10")),
            "k_rate_last10": safe_ratio(F.col("strikeouts_last10"), F.col("batters_faced_last10")),
        }
    )


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key. Each map task keeps one row per key before the
    shuffle (window group limit)."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    present = df.filter(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    return present.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def group_context(periods: DataFrame, as_of) -> DataFrame:
    """Latest opponent form strictly before ``as_of`` (a date, text or column), one row
    per opponent. The winner is kept by a partial aggregate, missing values included."""
    columns = ("opponent_team", "opp_strikeouts_per_game_last10", "opp_k_rate_last10")
    require_columns(periods, (*PERIOD_ORDER, *columns), "entity_periods")
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return (
        periods.filter((F.col("game_date") < limit.cast("date")) & F.col("opponent_team").isNotNull())
        .groupBy("opponent_team")
        .agg(F.max_by(F.struct(*columns[1:]), F.struct(*PERIOD_ORDER, "pitcher")).alias("_last"))
        .select("opponent_team", "_last.*")
    )
