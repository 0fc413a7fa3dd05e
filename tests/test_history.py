import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyline.contracts import ContractError
from tallyline.operators import rollup, trailing
from tallyline.plans.history import entity_history
from tallyline.schemas import EVENT, MODEL_FEATURES

DAY = datetime.date(2025, 4, 1)


def pitch(**over):
    row = dict(
        game_date=DAY, game_pk=1, pitcher=10, player_name="Doe, Jo", batter=1, pitch_type="FF", release_speed=95.0,
        release_spin_rate=2200.0, description="ball", events=None, inning=1, outs_when_up=0, home_team="TEX",
        away_team="SEA", stand="R", p_throws="R", inning_topbot="Top",
    )
    row.update(over)
    return row


def events(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in EVENT.names) for r in rows], EVENT)


def test_flags_and_rollup(spark):
    rows = [
        pitch(events="strikeout", description="swinging_strike"),
        pitch(batter=2, pitch_type=None, release_speed=float("nan")),
        pitch(batter=2, events="strikeout_double_play", release_speed=93.0),
        pitch(player_name=None),
    ]
    got = rollup.entity_periods_with_groups(rollup.add_event_flags(events(spark, rows))).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.pitches, row.strikeouts, row.whiffs, row.batters_faced) == (2, 2, 1, 2)
    assert row.avg_velo == 94.0 and row.whiff_per_pitch == 0.5
    assert (row.pitching_team, row.opponent_team) == ("TEX", "SEA")


def test_fielding_lookup_reverses_in_the_bottom_half(spark):
    rows = [pitch(), pitch(pitcher=11, inning_topbot="Bot"), pitch(pitcher=12, inning_topbot=None)]
    got = {r.pitcher: (r.pitching_team, r.opponent_team) for r in rollup.fielding_lookup(events(spark, rows)).collect()}
    assert got == {10: ("TEX", "SEA"), 11: ("SEA", "TEX"), 12: ("SEA", "TEX")}


def test_two_names_in_one_period_are_an_error(spark):
    with pytest.raises(ContractError):
        entity_history(events(spark, [pitch(), pitch(player_name="Other")]))


def periods(frame, counts):
    return frame(
        [
            dict(pitcher=1, game_date=DAY + datetime.timedelta(days=i), game_pk=i, strikeouts=k)
            for i, k in enumerate(counts)
        ],
        "pitcher long, game_date date, game_pk long, strikeouts long",
    )


def test_trailing_dispersion_golden(frame):
    got = trailing.add_trailing(
        periods(frame, [1, 3, 2, 4]), ("pitcher",), trailing.PERIOD_ORDER, trailing.ENTITY_DISPERSION
    ).orderBy("game_pk").collect()
    assert [r.strikeouts_stddev_last10 for r in got[:3]] == [None] * 3
    assert got[3].strikeouts_stddev_last10 == pytest.approx(0.8164965809)
    assert (got[3].strikeouts_p25_last10, got[3].strikeouts_p75_last10) == (1.5, 2.5)


def skewed(spark, seed=3):
    """One key with most rows, many of them on one day, beside small keys."""
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        day = 20 if i % 2 else rng.randrange(40)
        rows.append((1, DAY + datetime.timedelta(days=day), i, float(rng.randrange(12)) if i % 9 else None))
    for i in range(60):
        rows.append((2 + i % 5, DAY + datetime.timedelta(days=i), 1000 + i, float(rng.randrange(12))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "pitcher long, game_date date, game_pk long, strikeouts double")


STATS = (
    trailing.Trailing("strikeouts", "m3", 3, 1),
    trailing.Trailing("strikeouts", "m10", 10, 3),
    *trailing.ENTITY_DISPERSION,
)


@pytest.mark.parametrize("limit", [7, 25, 150])
def test_hot_key_in_blocks_equals_one_window(spark, limit):
    df = skewed(spark)
    plain = trailing.add_trailing(df, ("pitcher",), trailing.PERIOD_ORDER, STATS, max_rows_per_task=None)
    blocks = trailing.add_trailing(df, ("pitcher",), trailing.PERIOD_ORDER, STATS, max_rows_per_task=limit)
    assert blocks.columns == plain.columns
    key = ["pitcher", "game_pk"]
    a, b = (x.toPandas().sort_values(key).reset_index(drop=True) for x in (plain, blocks))
    pd.testing.assert_frame_equal(a, b)


def test_trailing_equals_brute_force(spark):
    got = trailing.add_trailing(skewed(spark), ("pitcher",), trailing.PERIOD_ORDER, STATS, max_rows_per_task=50)
    rows = sorted(got.collect(), key=lambda r: (r.pitcher, r.game_date, r.game_pk))
    for i, row in enumerate(rows):
        prior = [r.strikeouts for r in rows[max(0, i - 10):i] if r.pitcher == row.pitcher]
        known = [k for k in prior if k is not None]
        expected = sum(known) / len(known) if len(known) >= 3 else None
        assert row.m10 == (pytest.approx(expected) if expected is not None else None)


def test_group_context_is_strictly_before(frame):
    rows = [
        dict(game_date=DAY, game_pk=1, pitcher=1, opponent_team="A", a=1.0, b=None),
        dict(game_date=DAY + datetime.timedelta(days=1), game_pk=2, pitcher=1, opponent_team="A", a=None, b=0.5),
        dict(game_date=DAY + datetime.timedelta(days=2), game_pk=3, pitcher=1, opponent_team="A", a=9.0, b=9.0),
    ]
    df = frame(rows, "game_date date, game_pk long, pitcher long, opponent_team string, a double, b double")
    df = df.withColumnsRenamed({"a": "opp_strikeouts_per_game_last10", "b": "opp_k_rate_last10"})
    got = trailing.group_context(df, "2025-04-03").collect()
    assert [tuple(r) for r in got] == [("A", None, 0.5)]


def season(spark, games=14, pitchers=(10, 11)):
    rows = []
    rng = random.Random(1)
    for g in range(games):
        for p in pitchers:
            for b in range(15):
                rows.append(
                    pitch(
                        game_date=DAY + datetime.timedelta(days=5 * g), game_pk=100 + g, pitcher=p,
                        player_name=f"Name {p}", batter=b, inning_topbot="Top" if p == 10 else "Bot",
                        events="strikeout" if rng.random() < 0.3 else None,
                        description="swinging_strike" if rng.random() < 0.4 else "ball",
                        release_speed=90 + rng.random(), release_spin_rate=2000 + 100 * rng.random(),
                    )
                )
    return events(spark, rows)


def test_history_does_not_leak_and_ignores_input_order(spark):
    whole = season(spark)
    cut = whole.filter(F.col("game_date") <= DAY + datetime.timedelta(days=30))
    columns = ["pitcher", "game_pk", *MODEL_FEATURES]

    def table(df):
        return df.select(*columns).toPandas().sort_values(columns[:2]).reset_index(drop=True)

    full = table(entity_history(whole.orderBy(F.rand(5))))
    early = table(entity_history(cut))
    pd.testing.assert_frame_equal(early, full[full.game_pk <= 106].reset_index(drop=True))


def test_periods_of_sides_equal_those_of_cells(spark):
    """Also where an entity stands on several sides in a period and meets a batter on two."""
    rows = [pitch(pitcher=p, batter=b, inning_topbot=half, p_throws=hand)
            for p, b, half, hand in [
                (1, 7, "Top", "R"), (1, 8, "Top", "R"), (1, 8, "Top", "R"),
                (2, 7, "Top", "R"), (2, 7, "Bot", "R"), (2, 7, "Bot", "L"), (2, 9, "Bot", "L"), (2, None, "Bot", None),
                (3, None, "Top", "R"),
            ]]
    for chosen in (rows, rows[:3] + rows[-1:]):
        cells = rollup.event_cells(rollup.add_event_flags(events(spark, chosen)))
        sides = rollup.sides_of_cells(cells)
        assert "SortAggregate" not in sides._jdf.queryExecution().executedPlan().toString()
        found, known = rollup.periods_of_sides(sides, cells), rollup.periods_of_cells(cells)
        assert found.columns == known.columns
        assert found.orderBy("pitcher").collect() == known.orderBy("pitcher").collect()
    assert {r.pitcher: r.batters_faced for r in known.collect()} == {1: 2, 3: 0}


def test_events_are_dealt_before_they_are_counted(spark):
    """Counting in the map tasks holds nearly all events of a file in memory. Both rollups
    shuffle what they read once and hash it there."""
    rows = [pitch(batter=b, inning_topbot=half, pitcher=p) for p in (1, 2) for b in (3, 3, None) for half in ("Top", "Bot")]
    flagged = rollup.add_event_flags(events(spark, rows))
    for counted in (rollup.event_cells(flagged), rollup.group_periods(flagged)):
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Aggregate" not in plan.split("Exchange")[1]
    got = {r.batting_team: (r.team_batter_strikeouts, r.batters_faced) for r in rollup.group_periods(flagged).collect()}
    assert got == {"TEX": (0, 1), "SEA": (0, 1)}
