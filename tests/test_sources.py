import json

import pytest
from pyspark.sql import functions as F

from tallyline.contracts import ContractError, check_contract, contract_report
from tallyline.operators.lines import curate_lines, normalize_snapshots
from tallyline.plans.lines import curated_lines_from, lines_root, publish_lines
from tallyline.schemas import CURATED_LINE, EVENT, HISTORY_CONTRACT, QUOTE, SLATE, Contract
from tallyline.sources import nested, publish, readers, snapshots, versions
from tallyline.streaming.curation import curate_stream, curated_from_log, snapshot_stream

HEADER = "game_date,player_name,market_key,bookmaker,side,line,price,commence_time,pulled_at"
LONG = "source," + HEADER


def line_row(line, pulled, side="Over"):
    """One snapshot of a game that starts at 17:25, pulled at the given time of its day."""
    fields = ("2033-09-03", "Ida Fenn", "pitcher_strikeouts", "Northbook", side, line, 140, "2033-09-03T17:25:00Z")
    return ",".join(map(str, (*fields, f"2033-09-03T{pulled}Z")))


EARLY, LAST_BEFORE, AFTER = line_row(3.5, "15:50:00"), "feed," + line_row(8.5, "17:25:00"), line_row(9.5, "17:26:00")


@pytest.fixture
def log(tmp_path):
    folder = tmp_path / "raw"
    for name, lines in {"a/one.csv": [HEADER, EARLY, AFTER], "b/c/two.csv": [LONG, LAST_BEFORE]}.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    return folder


def test_snapshots_with_different_headers(spark, log, tmp_path):
    df = snapshots.read_snapshots(spark, str(log))
    assert df.count() == 3 and {r.source for r in df.collect()} == {None, "feed"}
    row = curated_lines_from(spark, str(log)).first()
    assert (row.line, row.source, row.is_closing_line) == (8.5, "feed", True)
    assert snapshots.read_snapshots(spark, str(tmp_path / "none")).count() == 0
    assert curated_lines_from(spark, str(tmp_path / "none")).columns == CURATED_LINE.names


def test_landing(spark, log, tmp_path):
    target = str(tmp_path / "landed")
    landed = snapshots.land_snapshots(spark, str(log), target)
    assert {r.relative_path for r in landed.select("relative_path").collect()} == {"a/one.csv", "b/c/two.csv"}
    assert snapshots.land_snapshots(spark, str(log), target).count() == 3
    dotted = log.parent / "raw.v1"
    log.rename(dotted)
    assert snapshots.land_snapshots(spark, str(dotted), str(tmp_path / "other")).count() == 3
    dotted.rename(log)
    (log / "bad.csv").write_text("game_date,price\n1,2\n")
    with pytest.raises(ContractError):
        snapshots.land_snapshots(spark, str(log), target)
    with pytest.raises(FileNotFoundError):
        snapshots.land_snapshots(spark, str(tmp_path / "none"), target)
    (tmp_path / "x.txt").write_text("1")
    with pytest.raises(ContractError):
        snapshots.land_snapshots(spark, str(tmp_path / "x.txt"), target)


def test_stream_equals_batch(spark, log, tmp_path):
    landed, out, check = (str(tmp_path / n) for n in ("landed", "log", "check"))
    batch = curate_lines(normalize_snapshots(snapshots.read_snapshots(spark, str(log))))
    snapshots.land_snapshots(spark, str(log / "a"), landed)
    curate_stream(snapshot_stream(spark, landed), out, check).awaitTermination(120)
    assert curated_from_log(spark, out).first().line == 3.5
    snapshots.land_snapshots(spark, str(log / "b"), landed)
    curate_stream(snapshot_stream(spark, landed), out, check).awaitTermination(120)
    stepwise = curated_from_log(spark, out).select(*batch.columns)
    assert list(map(tuple, stepwise.collect())) == list(map(tuple, batch.collect()))


def test_publish_lines_keeps_the_version_before(spark, log, tmp_path):
    root = str(tmp_path / "published")
    assert publish_lines(spark, str(log), root)[1] == 1
    (log / "three.csv").write_text("\n".join([HEADER, line_row(3.5, "15:50:00", side="Under")]) + "\n")
    assert publish_lines(spark, str(log), root)[1] == 2
    store = lines_root(root)
    before = versions.at(spark, store, versions.numbers(spark, store)[-2])
    assert spark.read.parquet(before.path(publish.LINES)).count() == 1


def test_slate_and_ledger_readers(spark, tmp_path):
    slate = tmp_path / "slate.csv"
    slate.write_text("p_throws,game_date,game_pk,pitcher,player_name,team,opponent,home_team,away_team,is_home\n"
                     "R ,2026-04-17,900001,1,Jo Doe,A,B,B,A,0\n")
    row = readers.read_slate(spark, str(slate)).first()
    assert (row.game_pk, row.pitcher, row.is_home, str(row.game_date)) == (900001, 1, 0, "2026-04-17")
    slate.write_text("game_date\n2026-04-17\n")
    with pytest.raises(ContractError):
        readers.read_slate(spark, str(slate))
    ledger = tmp_path / "ledger.csv"
    ledger.write_text("pick_key\nx\n")
    with pytest.raises(ContractError):
        readers.read_ledger(spark, str(ledger))
    assert readers.read_ledger(spark, str(tmp_path / "none.csv")).count() == 0


def test_events_are_pruned_by_date(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.range(10).select(
        *[
            (F.date_add(F.lit("2025-04-01").cast("date"), F.col("id").cast("int")) if f.name == "game_date"
             else F.lit(float("nan")) if f.name == "release_speed" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in EVENT.fields
        ]
    )
    rows.write.partitionBy("game_date").parquet(path)
    df = readers.read_events(spark, path, "2025-04-02", "2025-04-04")
    assert df.count() == 3 and df.filter("release_speed is not null").count() == 0
    assert "PartitionFilters: [isnotnull(game_date" in df._jdf.queryExecution().toString()


QUOTES = [
    {
        "id": "evt", "commence_time": "t", "home_team": "H", "away_team": "A",
        "bookmakers": [
            {"key": "williamhill_us", "last_update": "u", "markets": [
                {"key": "m", "outcomes": [{"name": "Over", "description": "J.D. O'Neil", "point": 5.5, "price": -110}]},
                {"key": "none", "outcomes": []},
            ]},
            {"key": "local", "markets": []},
        ],
    },
    {"id": "", "bookmakers": [{"key": "x"}]},
    {"id": "empty", "bookmakers": []},
]


def test_quote_documents(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps(QUOTES))
    documents = nested.read_quote_documents(spark, str(tmp_path / "q.json"))
    assert nested.market_documents(documents).count() == 1
    got = nested.flatten_quotes(documents)
    assert got.columns == QUOTE.names
    rows = got.collect()
    assert [(r.bookmaker, r.bookmaker_key, r.player_name_norm, r.line, r.price) for r in rows] == [
        ("Caesars", "williamhill_us", "jd oneil", 5.5, -110.0)
    ]


def side(team, **starter):
    return {"team": {"abbreviation": team}, **({"probablePitcher": starter} if starter else {})}


SCHEDULE = {"dates": [{"date": "2025-04-01", "games": [
    {"gamePk": 1, "teams": {"away": side("A", id=5, fullName="Jo", pitchHand={"code": "L"}), "home": side("H")}},
    {"gamePk": 2, "teams": {"away": side("B", id=6, fullName="Al"), "home": side("C", id=7, fullName="Bo")}},
]}]}


def test_schedule_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(SCHEDULE))
    got = nested.flatten_schedule(nested.read_schedule_documents(spark, str(tmp_path / "s.json")))
    assert got.columns == SLATE.names
    assert [(r.game_pk, r.pitcher, r.team, r.opponent, r.is_home, r.p_throws) for r in got.orderBy("pitcher").collect()] == [
        (1, 5, "A", "H", 0, "L"), (2, 6, "B", "C", 0, None), (2, 7, "C", "B", 1, None),
    ]
    (tmp_path / "e.json").write_text("{}")
    assert nested.flatten_schedule(nested.read_schedule_documents(spark, str(tmp_path / "e.json"))).count() == 0


def test_contract_report(frame):
    rows = [dict(a=1, f=0), dict(a=1, f=2), dict(a=None, f=None)]
    contract = Contract("t", ("a", "f"), ("a",), ("a",), ("f",))
    got = {(r.check_name, r.column_name): r.bad_rows for r in contract_report(frame(rows, "a int, f int"), contract).collect()}
    assert got == {("non_empty", "*"): 0, ("non_null", "a"): 1, ("zero_one", "f"): 1, ("unique", "a"): 2}
    with pytest.raises(ContractError):
        check_contract(frame(rows, "a int, f int"), HISTORY_CONTRACT)


def test_records(spark, tmp_path):
    publish.write_record(spark, {"a": 1, "b": [None, "x"]}, str(tmp_path / "r"))
    assert publish.read_record(spark, str(tmp_path / "r")) == {"a": 1, "b": [None, "x"]}
    with pytest.raises(FileNotFoundError):
        publish.resolve_set(spark, str(tmp_path))
