"""Serving features: every slate row gets the history strictly before its own date,
matched by entity id or, where the id has no earlier history, by normalized name.

The history is never paired with the slate rows. Each history row goes into one bucket
per key: the first slate date of that key after it. Bucket totals and the ten newest
rows of a bucket are all that crosses a shuffle (both are reduced in the map tasks), and
the answer for a slate date combines the buckets up to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyline.contracts import check_contract, require_columns
from tallyline.functions.dates import to_day
from tallyline.functions.names import entity_name
from tallyline.functions.numeric import nan_to_null, safe_ratio
from tallyline.operators.asof import join_as_of
from tallyline.operators.rollup import starter_like
from tallyline.operators.trailing import MAX_ROWS_PER_TASK
from tallyline.schemas import (
    GROUP_CONTEXT,
    HISTORY_CONTRACT,
    MIN_CAREER_STARTS,
    MODEL_FEATURES,
    SLATE,
    SLATE_CONTRACT,
    STARTER_MIN_BATTERS,
    STARTER_MIN_PITCHES,
)
from tallyline.session import materialize

MEASURES = ("strikeouts", "pitches", "batters_faced", "whiffs", "avg_velo", "avg_spin")
SPANS = (3, 5, 10)
LONGEST = max(SPANS)

# Rate features as (name, numerator, denominator); the career form of the
# last one carries its own name.
RATES = (
    ("k_per_pitch", "strikeouts", "pitches"),
    ("k_rate", "strikeouts", "batters_faced"),
    ("whiff_per_pitch", "whiffs", "pitches"),
)
CAREER_RATE_NAMES = {"whiff_per_pitch": "whiff_per_pitch_season"}
CAREER_MEAN_NAMES = {"avg_velo": "avg_velo_season", "avg_spin": "avg_spin_season"}


def _keys(entity: Column, name: Column) -> Column:
    """The one or two match keys of a row, best first."""
    by_id = F.when(entity.isNotNull(), F.concat(F.lit("id:"), entity.cast("string")))
    return F.array_compact(F.array(by_id, F.concat(F.lit("name:"), name)))


def _slate_dates(slate: DataFrame) -> DataFrame:
    """key -> its slate dates in order; bounded by the calendar, not by the slate."""
    return (
        slate.select(F.explode("_keys").alias("_key"), "game_date")
        .groupBy("_key")
        .agg(F.sort_array(F.collect_set("game_date")).alias("_dates"))
    )


def _salted(keyed: DataFrame, dates: DataFrame, max_rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt. A key over the limit gets as many salts as its counted rows
    ask for, every other key one; only the dates of hot keys are copied. The hot keys number
    at most the rows of the history divided by the limit."""
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows_per_task)
    hot = materialize(counts.select("_key", F.ceil(F.col("_n") / max_rows_per_task).alias("_salts")), "hot-keys")
    salts = F.coalesce(F.col("_salts"), F.lit(1).cast("long"))
    salt = F.pmod(F.xxhash64("game_date", "game_pk", "pitcher"), salts)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
    return (
        keyed.join(hot, "_key", "left").withColumn("_salt", salt).drop("_salts"),
        dates.join(hot, "_key", "left").withColumn("_salt", copies).drop("_salts"),
    )


def _bucketed_history(history: DataFrame, dates: DataFrame, max_rows_per_task: int) -> DataFrame:
    """History rows of slate keys with their bucket. The join is salted: a join on the
    key alone would leave a hot key in one task, and the grouping after it would need no
    shuffle, for which reason AQE would not split it."""
    keyed = history.select(
        F.explode(_keys(F.col("pitcher"), F.col("player_name_norm"))).alias("_key"),
        "game_date",
        "game_pk",
        "pitcher",
        *MEASURES,
    )
    keyed, dates = _salted(keyed, dates, max_rows_per_task)
    following = F.get(F.filter("_dates", lambda d: d > F.col("game_date")), F.lit(0))
    found = keyed.join(dates, ["_key", "_salt"]).withColumn("_bucket", following)
    # Totals and newest rows both read it.
    return materialize(found.filter("_bucket is not null").drop("_dates", "_salt"), "buckets")


def _career(bucketed: DataFrame) -> DataFrame:
    totals = [F.count(F.lit(1)).alias("_games"), F.max("game_date").alias("_last_date")]
    for m in MEASURES:
        totals += [F.sum(F.col(m).cast("double")).alias(f"_sum_{m}"), F.count(m).alias(f"_n_{m}")]
    return bucketed.groupBy("_key", "_bucket").agg(*totals)


def _recent(bucketed: DataFrame) -> DataFrame:
    """(key, bucket) -> the newest rows up to the bucket, oldest first."""
    order = ("game_date", "game_pk", "pitcher")
    newest = Window.partitionBy("_key", "_bucket").orderBy(*[F.col(c).desc() for c in order])
    kept = bucketed.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= LONGEST)
    along = Window.partitionBy("_key").orderBy(*order).rowsBetween(1 - LONGEST, 0)
    # Missing measures must stay in place, so whole rows are collected, not values.
    rows = F.collect_list(F.struct(*MEASURES)).over(along)
    return kept.withColumn("_rows", rows).filter("_rn = 1").select("_key", "_bucket", "_rows")


def _as_of(dates: DataFrame, bucketed: DataFrame) -> DataFrame:
    """(key, slate date) -> running totals and newest rows; dates without any earlier
    history are left out."""
    points = dates.select("_key", F.explode("_dates").alias("_bucket"))
    known = points.join(_career(bucketed), ["_key", "_bucket"], "left").join(
        _recent(bucketed), ["_key", "_bucket"], "left"
    )
    until = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = ["_games"] + [f"_{part}_{m}" for m in MEASURES for part in ("sum", "n")]
    running = {c: F.sum(c).over(until) for c in summed}
    running["_last_date"] = F.max("_last_date").over(until)
    running["_rows"] = F.last("_rows", ignorenulls=True).over(until)
    return known.withColumns(running).filter("_games is not null")


def _total(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda total, v: total + v))


def _mean(values: Column) -> Column:
    return safe_ratio(_total(values), F.size(values))


def _deviation(values: Column, mean: Column) -> Column:
    """Population standard deviation."""
    return F.sqrt(_mean(F.transform(values, lambda v: (v - mean) * (v - mean))))


def _quantile(ordered: Column, share: float) -> Column:
    """Interpolated between the two nearest places of sorted values."""
    place = (F.size(ordered) - 1) * F.lit(share)
    below = F.get(ordered, F.floor(place).cast("int"))
    above = F.get(ordered, F.ceil(place).cast("int"))
    return below + (above - below) * (place - F.floor(place))


def _with_spans(matched: DataFrame) -> DataFrame:
    """``matched`` with the features of its newest rows, at most LONGEST of them, which
    stay inside their row: no row is unfolded, grouped or joined back."""

    def held(span: int, measure: str) -> Column:
        rows = F.slice(F.reverse("_rows"), 1, span)
        return F.filter(F.transform(rows, lambda r: r.getField(measure)), lambda v: v.isNotNull())

    values = {f"_values_{m}_{span}": held(span, m) for span in SPANS for m in MEASURES}
    totals = {f"_total_{m}_{span}": _total(F.col(f"_values_{m}_{span}")) for span in SPANS for m in MEASURES}
    out = {}
    for span in SPANS:
        out[f"starts_last{span}_available"] = F.least(F.size("_rows"), F.lit(span)).cast("long")
        for m in MEASURES:
            out[f"{m}_last{span}"] = safe_ratio(F.col(f"_total_{m}_{span}"), F.size(f"_values_{m}_{span}"))
        for name, top, bottom in RATES:
            out[f"{name}_last{span}"] = safe_ratio(F.col(f"_total_{top}_{span}"), F.col(f"_total_{bottom}_{span}"))
    k = F.array_sort(f"_values_strikeouts_{LONGEST}")
    shape = {
        "strikeouts_stddev_last10": _deviation(k, F.col(f"strikeouts_last{LONGEST}")),
        "strikeouts_p25_last10": _quantile(k, 0.25),
        "strikeouts_p75_last10": _quantile(k, 0.75),
    }
    return matched.withColumns(values).withColumns(totals).withColumns(out).withColumns(shape).drop(*values, *totals)


SPAN_FEATURES = tuple(
    f"{name}_last{span}" if name != "starts" else f"starts_last{span}_available"
    for span in SPANS
    for name in ("starts", *MEASURES, *[r[0] for r in RATES])
) + ("strikeouts_stddev_last10", "strikeouts_p25_last10", "strikeouts_p75_last10")


def _career_features() -> dict[str, Column]:
    out = {"career_starts": F.col("_games")}
    for m in MEASURES:
        name = CAREER_MEAN_NAMES.get(m, f"{m}_per_game")
        out[name] = safe_ratio(F.col(f"_sum_{m}"), F.col(f"_n_{m}"))
    for name, top, bottom in RATES:
        out[CAREER_RATE_NAMES.get(name, name)] = safe_ratio(F.col(f"_sum_{top}"), F.col(f"_sum_{bottom}"))
    return out


def serving_features(
    slate: DataFrame,
    periods: DataFrame,
    context: DataFrame | None = None,
    *,
    min_career_starts: int = MIN_CAREER_STARTS,
    exact_names: bool = False,
    strict: bool = True,
    observation: Observation | None = None,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
    context_per_row: bool = False,
) -> DataFrame:
    """Features of every slate row with at least ``min_career_starts`` earlier starts.

    The opponent context is ``context``, one row per group for the whole slate, or with
    ``context_per_row`` what the history knew strictly before each row's own day. The number of slate rows left out for too little history is reported through
    ``observation`` under ``skipped``.
    """
    check_contract(slate, SLATE_CONTRACT, strict=strict)
    check_contract(periods, HISTORY_CONTRACT, strict=strict)
    require_columns(periods, MEASURES, "entity_periods")

    history = starter_like(periods, min_pitches=STARTER_MIN_PITCHES, min_batters=STARTER_MIN_BATTERS).select(
        to_day(F.col("game_date")).alias("game_date"),
        "game_pk",
        "pitcher",
        entity_name(F.col("player_name"), exact=exact_names).alias("player_name_norm"),
        *[nan_to_null(F.col(m).cast("double")).alias(m) for m in MEASURES],
    )
    rows = slate.withColumns(
        {
            "game_date": to_day(F.col("game_date")),
            "is_home": F.col("is_home").cast("int"),
            "player_name_norm": entity_name(F.col("player_name"), exact=exact_names),
        }
    ).withColumn("_keys", _keys(F.col("pitcher"), F.col("player_name_norm")))

    dates = _slate_dates(rows)
    as_of = _as_of(dates, _bucketed_history(history, dates, max_rows_per_task))

    # One row per slate row and match key, the first key with any history wins.
    slate_key = ("game_date", "game_pk", "player_name")
    found = rows.select("*", F.posexplode("_keys").alias("_rank", "_key")).join(
        as_of.withColumnRenamed("_bucket", "game_date"), ["_key", "game_date"], "left"
    )
    best = Window.partitionBy(*slate_key).orderBy(F.col("_games").isNull(), "_rank")
    matched = found.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1")
    enough = F.coalesce(F.col("_games"), F.lit(0)) >= min_career_starts
    if observation is not None:
        matched = matched.observe(observation, F.count_if(~enough).alias("skipped"))

    career = _with_spans(matched.filter(enough & F.col("_rows").isNotNull())).withColumns(_career_features())
    career = career.withColumn("days_rest", F.datediff("game_date", "_last_date"))
    base = [c for c in SLATE.names]
    extra = [c for c in slate.columns if c not in base]
    features = career.select(*base, *extra, "player_name_norm", *_career_features(), "days_rest", *SPAN_FEATURES)
    features = features.withColumns(
        {
            "k_trend_last3_vs_last10": F.col("strikeouts_last3") - F.col("strikeouts_last10"),
            "velo_trend_last3_vs_last10": F.col("avg_velo_last3") - F.col("avg_velo_last10"),
            "whiff_trend_last3_vs_last10": F.col("whiff_per_pitch_last3") - F.col("whiff_per_pitch_last10"),
        }
    )
    if context_per_row:
        features = add_context_per_row(features, periods, max_rows_per_task=max_rows_per_task)
    else:
        features = add_context(features, context)
    ordered = base + [c for c in features.columns if c not in base]
    features = features.select(*ordered)
    require_columns(features, MODEL_FEATURES, "serving_features")
    return features


def add_context(features: DataFrame, context: DataFrame | None) -> DataFrame:
    """Left join of the opponent context; both columns are NULL without one. The
    context holds one row per group; AQE broadcasts it after seeing its size."""
    form = GROUP_CONTEXT.names[1:]
    if context is None:
        return features.withColumns({c: F.lit(None).cast("double") for c in form})
    require_columns(context, GROUP_CONTEXT.names, "group_context")
    return features.join(
        context.select(F.col("opponent_team").alias("opponent"), *form), "opponent", "left"
    )


def add_context_per_row(
    features: DataFrame, periods: DataFrame, *, max_rows_per_task: int | None = MAX_ROWS_PER_TASK
) -> DataFrame:
    """The opponent context of every row as of its own day; NULL where its opponent has no
    earlier period. Ties inside a day go to the last period, as for a single day."""
    form = GROUP_CONTEXT.names[1:]
    require_columns(periods, ("game_date", "game_pk", "pitcher", "opponent_team", *form), "entity_periods")
    known = periods.select(
        F.col("opponent_team").alias("opponent"), to_day(F.col("game_date")).alias("_day"), "game_pk", "pitcher", *form
    )
    return join_as_of(
        features, known, ["opponent"], "game_date", ["_day", "game_pk", "pitcher"], form, max_rows_per_task=max_rows_per_task
    )
