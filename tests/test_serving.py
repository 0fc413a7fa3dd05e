import datetime
import random
import statistics

import pytest
from pyspark.sql import Observation

from tallyline.contracts import ContractError
from tallyline.operators.serving import serving_features
from tallyline.operators import slate as slates
from tallyline.schemas import SLATE

DAY = datetime.date(2025, 4, 1)
HISTORY_DDL = (
    "game_date date, game_pk long, pitcher long, player_name string, pitching_team string, opponent_team string, "
    "strikeouts long, pitches long, batters_faced long, whiffs long, avg_velo double, avg_spin double"
)


def slate(spark, *rows):
    base = dict(
        game_date=DAY + datetime.timedelta(days=100), game_pk=1, pitcher=7, player_name="Jo Doe", team="A",
        opponent="B", home_team="A", away_team="B", is_home=1, p_throws="R",
    )
    return spark.createDataFrame([tuple({**base, **r}[n] for n in SLATE.names) for r in rows], SLATE)


def game(i, **over):
    row = dict(
        game_date=DAY + datetime.timedelta(days=i), game_pk=i, pitcher=7, player_name="Doe, Jo", pitching_team="A",
        opponent_team="B", strikeouts=i % 9, pitches=80 + i, batters_faced=20 + i % 5, whiffs=i % 7,
        avg_velo=90.0 + i, avg_spin=2000.0 + i,
    )
    row.update(over)
    return row


def test_enough_history_and_skipped_count(spark, frame):
    seen = Observation("serving")
    games = frame([game(i) for i in range(6)] + [game(i, pitcher=8, player_name="Al") for i in range(3)], HISTORY_DDL)
    rows = slate(spark, {}, dict(game_pk=2, pitcher=8, player_name="Al"))
    got = serving_features(rows, games, observation=seen).collect()
    assert [r.player_name for r in got] == ["Jo Doe"]
    assert seen.get["skipped"] == 1
    row = got[0]
    assert (row.career_starts, row.starts_last3_available, row.starts_last10_available) == (6, 3, 6)
    assert row.strikeouts_last3 == 4.0 and row.days_rest == 95
    assert row.k_per_pitch_last3 == pytest.approx(12 / (83 + 84 + 85))
    assert row.strikeouts_stddev_last10 == pytest.approx(statistics.pstdev(range(6)))
    assert (row.strikeouts_p25_last10, row.strikeouts_p75_last10) == (1.25, 3.75)
    assert row.opp_k_rate_last10 is None


def test_name_fallback_only_without_id_history(spark, frame):
    games = frame([game(i) for i in range(6)] + [game(i + 20, pitcher=9) for i in range(5)], HISTORY_DDL)
    rows = slate(spark, dict(pitcher=99), dict(game_pk=2, pitcher=None, player_name="JO  Doe"), dict(game_pk=3, player_name="x"))
    got = {r.game_pk: r.career_starts for r in serving_features(rows, games).collect()}
    assert got == {1: 11, 2: 11, 3: 6}


def test_short_outings_are_ignored(spark, frame):
    short = [game(50 + i, pitches=18 + 4 * i, batters_faced=4, strikeouts=99) for i in range(2)]
    got = serving_features(slate(spark, {}), frame([game(i) for i in range(6)] + short, HISTORY_DDL)).first()
    assert got.career_starts == 6 and got.strikeouts_last3 == 4.0


def test_many_slate_dates_equal_brute_force(spark, frame):
    rng = random.Random(4)
    games = [
        game(
            i, game_date=DAY + datetime.timedelta(days=rng.randrange(60)), pitcher=rng.choice([1, 1, 1, 2]),
            strikeouts=rng.choice([None, 1, 2, 3, 8]), avg_velo=rng.choice([None, 90.0, 95.0]),
            player_name=rng.choice(["A", "B"]),
        )
        for i in range(150)
    ]
    rows = [
        dict(game_pk=1000 + i, game_date=DAY + datetime.timedelta(days=rng.randrange(70)),
             pitcher=rng.choice([1, 2, 3, None]), player_name=f"{rng.choice(['A', 'B', 'C'])}")
        for i in range(40)
    ]
    got = {r.game_pk: r for r in serving_features(slate(spark, *rows), frame(games, HISTORY_DDL), strict=False).collect()}
    for row in rows:
        earlier = [g for g in games if g["game_date"] < row["game_date"]]
        history = [g for g in earlier if g["pitcher"] == row["pitcher"]]
        history = history or [g for g in earlier if g["player_name"] == row["player_name"]]
        history.sort(key=lambda g: (g["game_date"], g["game_pk"]))
        if len(history) < 5:
            assert row["game_pk"] not in got
            continue
        mine = got[row["game_pk"]]
        assert mine.career_starts == len(history)
        for n in (3, 5, 10):
            known = [g["strikeouts"] for g in history[-n:] if g["strikeouts"] is not None]
            assert getattr(mine, f"strikeouts_last{n}") == (pytest.approx(statistics.mean(known)) if known else None)
        velo = [g["avg_velo"] for g in history if g["avg_velo"] is not None]
        assert mine.avg_velo_season == pytest.approx(statistics.mean(velo))


def test_slate_contract_errors(spark, frame):
    games = frame([game(i) for i in range(6)], HISTORY_DDL)
    for bad in ([{}, {}], [dict(team=None)], [dict(is_home=2)], []):
        with pytest.raises(ContractError):
            serving_features(slate(spark, *bad), games)
    with pytest.raises(ContractError):
        serving_features(slate(spark, {}).drop("team"), games)


def test_checked_slate(spark):
    good = slates.checked_slate(slate(spark, dict(player_name=" J.D. O'Neil-Ax", team=" a", home_team="a ", opponent="b")))
    row = good.first()
    assert (row.player_name, row.team, row.home_team, row.opponent) == ("JD ONeil Ax", "A", "A", "B")
    with pytest.raises(ContractError):
        slates.checked_slate(slate(spark, dict(is_home=0)))
    copies = slate(spark, {}, dict(player_name="Jo B"), dict(game_pk=0))
    assert [(r.game_pk, r.player_name) for r in slates.prediction_base(copies).collect()] == [(0, "Jo Doe"), (1, "Jo B")]


def test_hot_keys_split_give_the_same_rows(spark, frame):
    games = frame(
        [game(i, avg_velo=None if i % 3 else 91.5) for i in range(40)]
        + [game(i, game_pk=100 + i, pitcher=8, player_name="Al", strikeouts=None) for i in range(0, 30, 5)],
        HISTORY_DDL,
    )
    days = [dict(game_date=DAY + datetime.timedelta(days=d), game_pk=d) for d in (4, 9, 25, 39, 60)]
    rows = slate(spark, *days, dict(game_pk=2, pitcher=8, player_name="Al"), dict(game_pk=3, pitcher=99))
    plain = serving_features(rows, games, min_career_starts=1)
    split = serving_features(rows, games, min_career_starts=1, max_rows_per_task=3)
    key = ("game_date", "game_pk")
    assert plain.count() == 7
    assert split.orderBy(*key).collect() == plain.orderBy(*key).collect()


def test_missing_measures_leave_their_place_empty(spark, frame):
    games = frame([game(i, strikeouts=None if i > 2 else i, whiffs=None) for i in range(6)], HISTORY_DDL)
    row = serving_features(slate(spark, {}), games).first()
    assert (row.starts_last3_available, row.strikeouts_last3, row.strikeouts_last5) == (3, None, 1.5)
    assert row.whiffs_last10 is None and row.whiff_per_pitch_last10 is None
    assert (row.strikeouts_stddev_last10, row.strikeouts_p25_last10) == (pytest.approx(statistics.pstdev([0, 1, 2])), 0.5)
