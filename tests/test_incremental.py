"""History in steps equals history at once."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyline.contracts import ContractError
from tallyline.plans import incremental
from tallyline.plans.history import entity_history
from tallyline.schemas import EVENT
from tallyline.sources import versions

DAY = datetime.date(2033, 4, 2)
TEAMS = ("AAA", "BBB", "CCC", "DDD")


def season(seed=5, days=30):
    """Events of a few teams, two starters each, who do not play every day."""
    draw = random.Random(seed)
    rows = []
    for d in range(days):
        for game, (home, away) in enumerate(draw.choice([(TEAMS[:2], TEAMS[2:]), (TEAMS[::2], TEAMS[1::2])])):
            for team, half in ((home, "Top"), (away, "Bot")):
                pitcher = 10 * TEAMS.index(team) + draw.randrange(2)
                for batter in range(draw.randint(2, 5)):
                    rows.append(
                        dict(
                            game_date=DAY + datetime.timedelta(days=d), game_pk=100 * d + game, pitcher=pitcher,
                            player_name=f"Name {pitcher}", batter=batter, pitch_type=draw.choice(["FF", None]),
                            release_speed=draw.choice([90.0 + draw.randrange(9), float("nan"), None]),
                            release_spin_rate=2000.0 + draw.randrange(300),
                            description=draw.choice(["ball", "swinging_strike", None]),
                            events=draw.choice(["strikeout", "field_out", None]), inning=1, outs_when_up=0,
                            home_team=home, away_team=away, stand="R", p_throws="L", inning_topbot=half,
                        )
                    )
    return rows


def events(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in EVENT.names) for r in rows], EVENT)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a, b = (
        x.select(*columns).toPandas().sort_values(["game_date", "game_pk", "pitcher"]).reset_index(drop=True)
        for x in (left, right)
    )
    pd.testing.assert_frame_equal(a, b)


def between(rows, a, b):
    return [r for r in rows if DAY + datetime.timedelta(days=a) <= r["game_date"] < DAY + datetime.timedelta(days=b)]


def test_five_steps_with_a_late_correction_equal_one_build(spark, tmp_path):
    root, rows = str(tmp_path / "store"), season()
    # Day 9 arrives with half of its events and another team's names first, and right at the end.
    wrong = [{**r, "events": "strikeout"} for r in between(rows, 9, 10)[::2]]
    steps = [between(rows, 0, 9) + wrong, between(rows, 10, 18), between(rows, 18, 19), between(rows, 19, 30)]
    updates = [incremental.update_history(spark, root, events(spark, s)) for s in steps]
    assert [u.days_delivered for u in updates] == [10, 8, 1, 11]
    # New days at the end leave the days before them alone.
    assert [u.history_days_written for u in updates] == [10, 8, 1, 11]
    same(incremental.stored_history(spark, root), entity_history(events(spark, sum(steps, []))))
    late = incremental.update_history(spark, root, events(spark, between(rows, 9, 10)))
    assert late.days_delivered == 1 and 1 < late.history_days_written < 30 and late.version.number == 5
    same(incremental.stored_history(spark, root), entity_history(events(spark, rows)))


def test_far_days_keep_their_files(spark, tmp_path):
    """A correction reaches ten appearances on, so much later days keep their folders."""
    root, rows = str(tmp_path / "store"), season(days=60)
    first = incremental.update_history(spark, root, events(spark, rows)).version
    corrected = [{**r, "batter": r["batter"] + 50} for r in between(rows, 4, 5)]
    after = incremental.update_history(spark, root, events(spark, corrected)).version
    kept = {n for n in first.entries if first.entries[n] == after.entries[n]}
    late = (DAY + datetime.timedelta(days=55)).isoformat()
    early = (DAY + datetime.timedelta(days=3)).isoformat()
    assert {f"history/{late}", f"group_form/{late}", f"history/{early}"} <= kept and len(kept) > 60
    expected = [r for r in rows if r not in between(rows, 4, 5)] + corrected
    same(incremental.stored_history(spark, root), entity_history(events(spark, expected)))


def test_days_in_any_order_and_days_that_go_away(spark, tmp_path):
    root, rows = str(tmp_path / "store"), season(1, days=16)
    for d in (8, 0, 12, 4):
        incremental.update_history(spark, root, events(spark, between(rows, d, d + 4)), max_rows_per_task=3)
    same(incremental.stored_history(spark, root), entity_history(events(spark, rows)))
    gone = [(DAY + datetime.timedelta(days=d)).isoformat() for d in (3, 4)]
    incremental.update_history(spark, root, events(spark, between(rows, 7, 8)), days=gone)
    left = [r for r in rows if r["game_date"].isoformat() not in gone]
    same(incremental.stored_history(spark, root), entity_history(events(spark, left)))
    assert not any(n.endswith(tuple(gone)) for n in versions.current(spark, root).entries)


def test_a_rival_delivery_is_taken_into_account(spark, tmp_path, monkeypatch):
    root, rows = str(tmp_path / "store"), season(days=12)
    incremental.update_history(spark, root, events(spark, between(rows, 0, 4)))
    publish, rivals = versions.publish, [between(rows, 4, 8)]

    def late(session, base, change):
        if rivals:
            incremental.update_history(session, root, events(session, rivals.pop()))
        return publish(session, base, change)

    monkeypatch.setattr(versions, "publish", late)
    incremental.update_history(spark, root, events(spark, between(rows, 8, 12)))
    same(incremental.stored_history(spark, root), entity_history(events(spark, rows)))


def test_empty_deliveries(spark, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        incremental.stored_history(spark, root)
    with pytest.raises(ContractError):
        incremental.update_history(spark, root, events(spark, []))
    incremental.update_history(spark, root, events(spark, []), days=["2033-04-02"])
    assert incremental.stored_history(spark, root).count() == 0
    undated = [{**r, "game_date": None} for r in season(days=1)]
    rows = undated + season(days=2)
    incremental.update_history(spark, root, events(spark, rows))
    same(incremental.stored_history(spark, root), entity_history(events(spark, season(days=2))))
    assert incremental.stored_history(spark, root).filter(F.col("game_date").isNull()).count() == 0
