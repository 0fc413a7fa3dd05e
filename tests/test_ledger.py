import pytest

from tallyline.operators import ledger
from tallyline.plans.ledger import (
    bucket_folders,
    ledger_report,
    ledger_root,
    persist_ledger,
    read_current_ledger,
    read_version,
    replace_ledger,
    upsert_rows,
    write_ledger_report,
)
from tallyline.schemas import LEDGER, LEDGER_COLUMNS
from tallyline.sources import paths, versions

SLATE_DDL = "player_name string, team string, opponent string, game_date string, game_pk long"
PICK_DDL = (
    "player_name string, team string, opponent string, book string, pick_side string, line double, price double, "
    "predicted_strikeouts double, edge double, confidence_tier string, pick_type string"
)


def rows(spark, *given):
    return spark.createDataFrame([tuple(r.get(c, "") for c in LEDGER_COLUMNS) for r in given], LEDGER)


def settled(key, **over):
    return {**dict(pick_key=key, player_name=key, book="X", pick_type="official"), **over}


GRADED = [
    settled("a", odds="-110", result="W"),
    settled("b", odds="", price="120", result="L"),
    settled("c", result="push", book="Y"),
    settled("d", result="W"),
    settled("e", odds="-110", result=""),
    settled("f", odds="-110", result="W", pick_type="lean"),
]


def test_grading_golden(spark):
    report = ledger_report(rows(spark, *GRADED))
    graded = {r.pick_key: (r.units_risked, r.units_result) for r in report["graded"].collect()}
    assert graded == {"a": (1.0, pytest.approx(100 / 110)), "b": (1.0, -1.0), "c": (0.0, 0.0)}
    assert {r.pick_key for r in report["skipped"].collect()} == {"d", "e"}
    overall = report["overall"].first()
    assert (overall.books, overall.picks, overall.wins, overall.losses, overall.pushes) == (2, 3, 1, 1, 1)
    assert (overall.decisions, overall.units_risked, overall.skipped_rows) == (2, 2.0, 2)
    assert overall.roi == pytest.approx((100 / 110 - 1) / 2) and overall.win_rate == 0.5
    assert [r.book for r in report["by_book"].collect()] == ["Y", "X"]


def test_empty_ledger(spark):
    overall = ledger.ledger_overall(rows(spark)).first()
    assert (overall.books, overall.picks, overall.units_profit, overall.roi, overall.skipped_rows) == (0, 0, 0.0, None, 0)


def pick(**over):
    row = dict(
        player_name="Ana  McVale", team="TEX", opponent="SEA", book="DK", pick_side="over", line=6.5, price=120.0,
        predicted_strikeouts=6.7, edge=0.8, confidence_tier="high", pick_type="official",
    )
    row.update(over)
    return row


def test_new_rows_resolve_their_day(frame):
    slate = frame(
        [
            dict(player_name="Ana  McVale", team="TEX", opponent="SEA", game_date="2031-05-13", game_pk=1),
            dict(player_name="Ana  McVale", team="TEX", opponent="SEA", game_date="2031-05-14", game_pk=2),
        ],
        SLATE_DDL,
    )
    picks = frame([pick(), pick(player_name="Other"), pick(pick_type="lean")], PICK_DDL)
    got = {r.pick_key: r for r in ledger.ledger_rows(slate, picks).collect()}
    assert set(got) == {"2031-05-14|ana mcvale", "|other"}
    row = got["2031-05-14|ana mcvale"]
    assert (row.odds, row.result, row.record_source) == ("+120", "", "run_daily_card")
    sole = ledger.ledger_rows(slate.filter("game_pk = 1"), picks).filter("player_name = 'Other'").first()
    assert sole.game_date == "2031-05-13"


def test_days_of_the_slate_never_pass_through_the_driver(frame):
    slate = frame([dict(player_name="A", team="T", opponent="O", game_date="2031-05-14", game_pk=1)], SLATE_DDL)
    made = ledger.ledger_rows(slate, frame([pick(player_name="A", team="T", opponent="O")], PICK_DDL))
    assert [r.pick_key for r in made.collect()] == ["2031-05-14|a"]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan


def test_saving_twice_keeps_settled_fields(spark, frame, tmp_path):
    root = str(tmp_path)
    slate = frame([dict(player_name="A", team="T", opponent="O", game_date="2031-05-14", game_pk=1)], SLATE_DDL)
    persist_ledger(slate, frame([pick(player_name="A", team="T", opponent="O")], PICK_DDL), root)
    old = read_current_ledger(spark, root).first().asDict()
    other = settled("legacy", record_source="manual_seed")
    replace_ledger(spark, rows(spark, {**old, "result": "W", "actual_strikeouts": "7"}, other), root)
    again = frame([pick(player_name="A", team="T", opponent="O", predicted_strikeouts=6.8)], PICK_DDL)
    for _ in range(2):
        persist_ledger(slate, again, root)
        got = {r.pick_key: r for r in read_current_ledger(spark, root).collect()}
        assert set(got) == {"2031-05-14|a", "legacy"}
        row = got["2031-05-14|a"]
        assert (row.result, row.actual_strikeouts, row.predicted_strikeouts) == ("W", "7", "6.8")
    target = str(tmp_path / "out")
    write_ledger_report(spark, versions.current(spark, ledger_root(root)), target)
    assert spark.read.json(paths.join(target, "ledger_overall")).first().wins == 1


def test_copies_of_a_key_count_once(spark):
    settled_row = settled("a", result="W", actual_strikeouts="7")
    blank = settled("a", result="", actual_strikeouts="")
    got = ledger.upsert_ledger(rows(spark, blank, settled_row, settled("b")), rows(spark, blank, blank)).collect()
    assert sorted((r.pick_key, r.result) for r in got if r.pick_key == "a") == [("a", "W")]
    assert len(got) == 2


def seeded(spark, root, n, **options):
    return replace_ledger(spark, rows(spark, *[settled(f"key{i}", odds="-110") for i in range(n)]), root, **options)


def test_an_upsert_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    root = str(tmp_path)
    before = seeded(spark, root, 500)
    new = [settled(f"key{i}", result="W") for i in range(5)] + [settled(f"new{i}") for i in range(5)]
    after = upsert_rows(spark, rows(spark, *new), root)
    kept = set(bucket_folders(before)) & set(bucket_folders(after))
    assert len(bucket_folders(before)) == 64 and 54 <= len(kept) < 64
    got = {r.pick_key: r.result for r in read_current_ledger(spark, root).collect()}
    assert len(got) == 505 and {k for k, v in got.items() if v == "W"} == {f"key{i}" for i in range(5)}
    # The version before is still whole.
    assert read_version(spark, before).filter("result = 'W'").count() == 0
    assert upsert_rows(spark, rows(spark), root) == after


def test_two_upserts_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    seeded(spark, root, 40, buckets=4)
    publish, rivals = versions.publish, [settled("key1", result="L"), settled("rival")]

    def late(session, base, change):
        """Another writer commits between the merge of this one and its commit."""
        if rivals:
            given = rows(spark, *rivals)
            rivals.clear()
            upsert_rows(spark, given, root)
        return publish(session, base, change)

    monkeypatch.setattr(versions, "publish", late)
    upsert_rows(spark, rows(spark, settled("key1", actual_strikeouts="7"), settled("mine")), root)
    got = {r.pick_key: r for r in read_current_ledger(spark, root).collect()}
    assert len(got) == 42 and {"mine", "rival"} <= set(got)
    assert (got["key1"].result, got["key1"].actual_strikeouts) == ("L", "7")


def test_more_buckets(spark, tmp_path):
    root = str(tmp_path)
    seeded(spark, root, 60, buckets=2)
    version = replace_ledger(spark, read_current_ledger(spark, root), root, buckets=8)
    assert len(bucket_folders(version)) == 8 and read_current_ledger(spark, root).count() == 60
    upsert_rows(spark, rows(spark, settled("late")), root)
    assert read_current_ledger(spark, root).count() == 61
