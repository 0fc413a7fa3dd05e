"""As-of joins against brute force, with hot keys in several stretches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import asof
from tallyline.operators.serving import add_context
from tallyline.operators.trailing import group_context

DAY = datetime.date(2033, 5, 1)
POINTS = "k string, day date, n long"
VALUES = "k string, day date, seq long, a double, b string"


def day(i):
    return DAY + datetime.timedelta(days=i)


def random_sides(seed, hot=0.6):
    draw = random.Random(seed)

    def key():
        return "hot" if draw.random() < hot else draw.choice(["x", "y", "z", None])

    points = [(key(), draw.choice([day(draw.randrange(40)), None]) if draw.random() < 0.1 else day(draw.randrange(40)), i) for i in range(300)]
    values = [(key(), day(draw.randrange(40)), i, draw.choice([None, float(i)]), f"v{i}") for i in range(250)]
    return points + [("none", day(3), 900), points[0], points[0]], values + [("x", None, 999, 1.0, "undated")]


def brute(points, values):
    found = []
    for k, when, n in points:
        earlier = [v for v in values if v[0] == k and None not in (k, when, v[1]) and v[1] < when]
        last = max(earlier, key=lambda v: v[1:3]) if earlier else (None,) * 5
        found.append((k, when, n, last[3], last[4]))
    return sorted(found, key=str)


@pytest.mark.parametrize("limit", [None, 1, 40, 10_000])
def test_as_of_equals_brute_force(spark, limit):
    points, values = random_sides(4)
    got = asof.join_as_of(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(values, VALUES).repartition(7),
        ["k"],
        "day",
        ["day", "seq"],
        ["a", "b"],
        max_rows_per_task=limit,
    )
    assert got.columns == ["k", "day", "n", "a", "b"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(points, values)


def test_a_hot_key_is_spread_over_tasks(spark):
    """One key with all rows, most of them on one day, in stretches of several tasks."""
    points = [("hot", day(7 if i % 3 else i % 30), i) for i in range(2000)]
    values = [("hot", day(6 if i % 2 else i % 30), i, float(i), "v") for i in range(2000)]
    rows = spark.createDataFrame(values, VALUES)
    sizes = []
    stretches = asof._in_stretches

    def watched(df, keys):
        sizes.append(df.count())
        done = stretches(df, keys)
        return done

    original, asof._in_stretches = asof._in_stretches, watched
    try:
        got = asof.join_as_of(spark.createDataFrame(points, POINTS), rows, ["k"], "day", ["day", "seq"], ["a", "b"], max_rows_per_task=100)
        assert sorted(map(tuple, got.collect()), key=str) == brute(points, values)
    finally:
        asof._in_stretches = original
    assert sizes == [4000]


def test_empty_sides_and_clashes(spark):
    points, values = spark.createDataFrame([("a", DAY, 1)], POINTS), spark.createDataFrame([], VALUES)
    got = asof.join_as_of(points, values, ["k"], "day", ["day", "seq"], ["a", "b"])
    assert list(map(tuple, got.collect())) == [("a", DAY, 1, None, None)]
    assert asof.join_as_of(points.limit(0), values, ["k"], "day", ["day"], ["a"]).count() == 0
    with pytest.raises(ValueError):
        asof.join_as_of(points.withColumn("a", F.lit(1)), values, ["k"], "day", ["day"], ["a"])


def test_context_of_every_row_equals_the_context_of_its_day(frame):
    draw = random.Random(2)
    history = frame(
        [
            dict(game_date=day(draw.randrange(30)), game_pk=i, pitcher=i % 5, opponent_team=draw.choice("ABC"), f=draw.choice([None, float(i)]), g=float(i))
            for i in range(80)
        ],
        "game_date date, game_pk long, pitcher long, opponent_team string, f double, g double",
    ).withColumnsRenamed({"f": "opp_strikeouts_per_game_last10", "g": "opp_k_rate_last10"})
    slate = frame(
        [dict(game_date=day(d), opponent=t, n=i) for i, (d, t) in enumerate((d, t) for d in (0, 5, 11, 40) for t in ("A", "B", "D", None))],
        "game_date date, opponent string, n long",
    )
    from tallyline.operators.serving import add_context_per_row

    got = sorted(map(tuple, add_context_per_row(slate, history).collect()), key=str)
    expected = []
    for d in (0, 5, 11, 40):
        rows = add_context(slate.filter(F.col("game_date") == day(d)), group_context(history, str(day(d))))
        expected += map(tuple, rows.select("game_date", "opponent", "n", "opp_strikeouts_per_game_last10", "opp_k_rate_last10").collect())
    assert got == sorted(expected, key=str)
