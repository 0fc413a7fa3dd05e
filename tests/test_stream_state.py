"""Curation with stream state: equal to a batch, bounded, compact, and idempotent."""

import datetime

import pytest

from tallyline.operators.lines import curate_lines, normalize_snapshots
from tallyline.sources import versions
from tallyline.streaming import upsert
from tallyline.streaming.curation import snapshot_layout, snapshot_stream

START = datetime.datetime(2033, 9, 3, 17, 25)


def row(name, line, minutes, day=0, **over):
    start = START + datetime.timedelta(days=day)
    given = dict(
        game_date=start.date().isoformat(), player_name=name, market_key="pitcher_strikeouts", bookmaker="North",
        side="Over", line=str(line), price="140", commence_time=f"{start.isoformat()}Z",
        pulled_at=f"{(start + datetime.timedelta(minutes=minutes)).isoformat()}Z",
    )
    given.update(over)
    return tuple(given.get(c) for c in snapshot_layout().names)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("dropped", "store", "progress")]


def drop(spark, folders, rows, **options):
    dropped, store, progress = folders
    spark.createDataFrame(rows, snapshot_layout()).coalesce(1).write.mode("append").parquet(dropped)
    query = upsert.curate_stateful(snapshot_stream(spark, dropped), store, progress, **options)
    query.awaitTermination(180)
    return query


def same(spark, folders, rows):
    batch = curate_lines(normalize_snapshots(spark.createDataFrame(rows, snapshot_layout())), strict=False)
    assert sorted(map(str, upsert.current_lines(spark, folders[1]).collect())) == sorted(map(str, batch.collect()))


def test_stream_equals_batch_within_the_watermark(spark, folders):
    drops = [
        [row("Ida Fenn", 3.5, -95), row("Rui Sato", 2.5, 5), row("Lev Ohm", 7, -9, pulled_at=None)],
        [row("ida FENN", 8.5, 0), row("Rui Sato", 1.5, 50), row("Ida Fenn", 9.5, 1), row("Kim Vo", 4, -5, day=1)],
        [row("Ida Fenn", 1.5, -200), row("Lev Ohm", 6, -5), row("Kim Vo", 5, -2, day=1, market_key="outs")],
    ]
    seen = []
    for rows in drops:
        seen += rows
        query = drop(spark, folders, rows)
        assert upsert.late_rows(query) == 0
        same(spark, folders, seen)
    version = versions.current(spark, folders[1])
    assert set(version.under(upsert.LINES)) == {"2033-09-03", "2033-09-04"}
    # One row a key, however many versions came before; the old ones are forgotten.
    assert upsert.current_lines(spark, folders[1]).count() == 4


def test_late_rows_are_counted_and_state_is_bounded(spark, folders):
    early, states = [row("Ida Fenn", 3.5, -95)], []
    drop(spark, folders, early, delay="1 day")
    for day in range(3, 20, 3):
        early.append(row("Kim Vo", day, -5, day=day))
        states.append(upsert.state_rows(drop(spark, folders, early[-1:], delay="1 day")))
    late = drop(spark, folders, [row("Ida Fenn", 9.0, -5)], delay="1 day")
    assert upsert.late_rows(late) == 1
    same(spark, folders, early)
    assert max(states) <= 3
    assert len(versions.numbers(spark, folders[1])) <= upsert.KEEP_VERSIONS + 1


def test_a_batch_that_runs_twice_is_merged_once(spark, folders):
    store = folders[1]
    lines = curate_lines(normalize_snapshots(spark.createDataFrame([row("Ida Fenn", 3.5, -95)], snapshot_layout())))
    first = upsert.merge_lines(spark, store, lines, 0)
    assert upsert.merge_lines(spark, store, lines, 0) == first
    assert upsert.merge_lines(spark, store, lines.limit(0), 1).info["batch"] == 1
    assert upsert.current_lines(spark, store).count() == 1
    assert upsert.current_lines(spark, folders[0]).count() == 0
