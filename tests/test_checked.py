"""Checked writes and malformed input."""

import json

import pytest
from pyspark.sql import functions as F

from tallyline import contracts
from tallyline.contracts import ContractError
from tallyline.plans.history import entity_history
from tallyline.schemas import EVENT, Contract
from tallyline.sources import checked, nested, readers, snapshots

DDL = "a int, f int, t string"
CONTRACT = Contract("t", ("a", "f"), ("a",), ("a",), ("f",))


def test_good_and_bad_rows_and_their_counts(frame):
    rows = [dict(a=1, f=0, t="x"), dict(a=1, f=2, t="y"), dict(a=None, f=1, t="z"), dict(a=4, f=None, t="w"), dict(a=5, f=1)]
    made = checked.write_checked(
        frame(rows, DDL), CONTRACT, more={"no text": F.col("t").isNull()}, strict=False
    )
    assert [tuple(r) for r in made.good.collect()] == [(4, None, "w")]
    bad = {r["t"]: sorted(r["problems"]) for r in made.bad.collect()}
    assert bad == {
        "x": ["duplicate a"], "y": ["duplicate a", "not 0 or 1: f"], "z": ["null a"], None: ["no text"],
    }
    assert dict(made.counts) == {
        "rows": 5, "bad_rows": 4, "null a": 1, "not 0 or 1: f": 1, "duplicate a": 2, "no text": 1,
    }
    assert made.good.columns == ["a", "f", "t"]


def test_strict_writes_raise(frame, spark):
    with pytest.raises(ContractError, match="null a"):
        checked.write_checked(frame([dict(a=None, f=0)], DDL), CONTRACT)
    with pytest.raises(ContractError, match="empty"):
        checked.write_checked(frame([], DDL), CONTRACT)
    none = checked.write_checked(frame([], DDL), CONTRACT, strict=False)
    assert none.good.count() == none.bad.count() == 0 and none.counts["rows"] == 0
    with pytest.raises(ContractError, match="missing"):
        checked.write_checked(spark.range(3), CONTRACT)


def test_history_and_slate_run_no_check_of_their_own(spark, monkeypatch):
    def forbidden(*_):
        raise AssertionError("a separate check job")

    monkeypatch.setattr(contracts, "_value_checks", forbidden)
    monkeypatch.setattr(contracts, "_duplicates", forbidden)
    row = dict(
        game_pk=1, pitcher=10, player_name="Doe, Jo", batter=1, pitch_type="FF", inning=1, outs_when_up=0,
        home_team="T", away_team="S", inning_topbot="Top",
    )
    table = spark.createDataFrame([tuple(row.get(n) for n in EVENT.names)], EVENT)
    dated = table.withColumn("game_date", F.lit("2033-04-01").cast("date"))
    assert entity_history(dated).count() == 1
    with pytest.raises(ContractError, match="empty"):
        entity_history(dated.limit(0))
    slate = nested.flatten_schedule(nested.parse_documents(spark.createDataFrame([(json.dumps(DAY),)], "x string"), "x", nested.SCHEDULE_DOCUMENT))
    from tallyline.plans.slate import build_slate

    assert slate.count() == 2
    assert build_slate(spark.createDataFrame([(json.dumps(DAY),)], "x string").select(F.from_json("x", nested.SCHEDULE_DOCUMENT).alias("d")).select("d.*")).count() == 2


def team(code, pitcher):
    return {"team": {"abbreviation": code}, "probablePitcher": {"id": pitcher, "fullName": f"P {pitcher}"}}


DAY = {"dates": [{"date": "2033-04-01", "games": [{"gamePk": 1, "teams": {"home": team("A", 1), "away": team("B", 2)}}]}]}
QUOTE = {"id": "e", "bookmakers": [{"key": "k", "markets": [{"key": "m", "outcomes": [{"name": "Over", "description": "P 1", "point": 3.5}]}]}]}


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_broken_document_costs_itself_only(spark, tmp_path, multi_line):
    texts = [json.dumps(QUOTE), json.dumps(QUOTE)[:-7], json.dumps({**QUOTE, "bookmakers": 7}), "", json.dumps(QUOTE)]
    if multi_line:
        for i, t in enumerate(texts):
            (tmp_path / f"{i}.json").write_text(t)
    else:
        (tmp_path / "all.json").write_text("\n".join(texts))
    read = nested.read_quote_documents(spark, str(tmp_path), multi_line=multi_line, corrupt=checked.CORRUPT)
    made = checked.set_aside(read)
    assert nested.flatten_quotes(nested.market_documents(made.good)).count() == 2
    broken = sorted(r[checked.CORRUPT] for r in made.bad.collect())
    assert broken == sorted(texts[1:3]) and made.counts["bad_rows"] == 2
    assert checked.CORRUPT not in made.good.columns
    plain = nested.read_quote_documents(spark, str(tmp_path), multi_line=multi_line)
    assert nested.flatten_quotes(nested.market_documents(plain)).count() == 2


def test_broken_lines_of_a_csv(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text('b,a,c\n1,2,3\n4,5\n6,7,8,9\n"x, y",2,\n')
    made = checked.set_aside(readers.read_csv_records(spark, path, ["a", "b"], corrupt=checked.CORRUPT))
    assert sorted(map(tuple, made.good.collect())) == [("2", "1"), ("2", "x, y")]
    assert sorted(r[checked.CORRUPT] for r in made.bad.collect()) == ["4,5", "6,7,8,9"]
    with pytest.raises(ContractError):
        readers.read_csv_records(spark, path, ["a", "z"], corrupt=checked.CORRUPT)


HEADER = "game_date,player_name,market_key,bookmaker,side,line,price"


def test_broken_lines_of_the_snapshot_log(spark, tmp_path):
    log, target, aside = tmp_path / "log", str(tmp_path / "landed"), str(tmp_path / "aside")
    log.mkdir()
    good = '2033-09-03,"Fenn, Ida",m,North,Over,3.5,140'
    (log / "one.csv").write_text("\n".join([HEADER, good, "2033-09-03,cut off", "", good + ",more", good]) + "\n")
    (log / "two.csv").write_text("\n".join(["note," + HEADER, '"a ""word""",' + good, good]) + "\n")
    landed = snapshots.land_snapshots(spark, str(log), target, quarantine=aside)
    assert landed.count() == 3 and {r.player_name for r in landed.collect()} == {"Fenn, Ida"}
    assert {r.note for r in landed.collect()} == {None, 'a "word"'}
    bad = spark.read.parquet(aside).filter("_bad = 'true'")
    assert sorted(r[checked.CORRUPT] for r in bad.collect()) == sorted(["2033-09-03,cut off", good + ",more", good])
    whole = snapshots.read_snapshots(spark, str(log))
    assert whole.count() == 6 and checked.CORRUPT not in whole.columns
    assert snapshots.read_snapshots(spark, str(log), with_corrupt=True).filter(F.col(checked.CORRUPT).isNotNull()).count() == 3


def test_the_log_is_parsed_in_one_pass(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    for i in range(4):
        (log / f"{i}.csv").write_text("\n".join([f"extra{i}," + HEADER, "x,2033-09-03,P,m,B,Over,1.5,100"]) + "\n")
    df = snapshots.read_snapshots(spark, str(log))
    plan = df._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan text") == 1
    assert df.count() == 4 and {"extra0", "extra3"} <= set(df.columns)
