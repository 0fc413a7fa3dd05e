import dataclasses
import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyline.contracts import ContractError
from tallyline.operators.model import BoostParams
from tallyline.plans import daily_card as card
from tallyline.plans.ledger import ledger_root, read_current_ledger, read_version
from tallyline.plans.slate import build_slate
from tallyline.plans.training import build_training_set
from tallyline.schemas import EVENT
from tallyline.sources import nested, paths, publish, versions
from tallyline.sources.paths import exists

DAY = datetime.date(2025, 4, 1)
TEAMS = {10: ("TEX", "Top"), 11: ("SEA", "Bot")}


def write_events(spark, path):
    rng = random.Random(1)
    rows = []
    for g in range(20):
        for pitcher, (_, half) in TEAMS.items():
            for b in range(14):
                rows.append((
                    DAY + datetime.timedelta(days=5 * g), 100 + g, pitcher, f"Name{pitcher}, Jo", b, "FF",
                    90 + rng.random(), 2000 + 100 * rng.random(),
                    "swinging_strike" if rng.random() < 0.4 else "ball",
                    "strikeout" if rng.random() < 0.35 else None, 1, 0, "TEX", "SEA", "R", "R", half,
                ))
    spark.createDataFrame(rows, EVENT).write.partitionBy("game_date").parquet(path)


def write_lines(folder):
    folder.mkdir(parents=True)
    header = "game_date,player_name,market_key,bookmaker,side,line,price,commence_time,pulled_at\n"
    lines = [
        f"{DAY + datetime.timedelta(days=5 * g)},\"Name{p}, Jo\",pitcher_strikeouts,DK,{side},4.5,-110,,\n"
        for g in range(12, 20) for p in TEAMS for side in ("Over", "Under")
    ]
    (folder / "lines.csv").write_text(header + "".join(lines))


def schedule():
    def side(team, pitcher):
        return {"team": {"abbreviation": team}, "probablePitcher": {"id": pitcher, "fullName": f"Jo Name{pitcher}"}}

    game = {"gamePk": 900, "teams": {"home": side("TEX", 10), "away": side("SEA", 11)}}
    return {"dates": [{"date": "2025-08-01", "games": [game]}]}


def quotes():
    outcomes = [
        {"name": s, "description": f"Jo Name{p}", "point": line, "price": -110}
        for p in TEAMS for s, line in (("Over", 3.5), ("Under", 5.5))
    ]
    return [{"id": "e", "commence_time": "2025-08-01T23:00:00Z",
             "bookmakers": [{"key": "draftkings", "markets": [
                 {"key": "pitcher_strikeouts", "outcomes": outcomes},
                 {"key": "pitcher_outs", "outcomes": [{**o, "point": 0.5} for o in outcomes]},
             ]}]}]


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("job")
    write_events(spark, str(base / "events"))
    write_lines(base / "raw")
    (base / "schedule.json").write_text(json.dumps(schedule()))
    (base / "quotes.json").write_text(json.dumps(quotes()))
    options = dict(params=BoostParams(rounds=3), split_date="2025-06-10", event_range=("2025-04-01", "2025-07-10"))
    root = str(base / "published")
    build_training_set(spark, str(base / "events"), str(base / "raw"), root, **options)
    return base, root


def test_training_set(spark, published):
    _, root = published
    published = publish.resolve_set(spark, root)
    assert set(publish.DATASETS) <= set(published.entries)
    metadata = publish.load_metadata(spark, published)
    window = metadata["training_window"]
    assert window["train_rows"] + window["test_rows"] == window["model_table_rows"] > 20
    assert window["test_date_range"]["start"] >= "2025-06-10"
    metrics = metadata["evaluation_metrics"]
    assert metrics["workflow_backtest"]["available"] and metrics["workflow_backtest"]["graded_pick_rows"] == 2
    assert metrics["regression"]["mae"] < 3 and metrics["uncertainty"]["rows"] == window["test_rows"]
    assert metadata["uncertainty_model"]["interval_multiplier"] > 0
    assert metadata["historical_lines"]["rows"] == 32


def test_readers_fall_back_to_the_set_before(spark, published):
    _, root = published
    whole = publish.resolve_set(spark, root)
    with pytest.raises(FileNotFoundError):
        publish.check_set(spark, root)
    damaged = {name: "data/none" for name in (publish.MODEL, publish.METADATA)}
    assert versions.commit(spark, root, lambda base: versions.Change(put=damaged)).number > whole.number
    assert publish.resolve_set(spark, root).number == whole.number
    versions.commit(spark, root, lambda base: versions.Change(put=dict(whole.entries)))
    assert publish.resolve_set(spark, root).entries == whole.entries


def test_daily_card(spark, published):
    base, root = published
    schedule_documents = nested.read_schedule_documents(spark, str(base / "schedule.json"))
    run = card.daily_card(
        spark, root, schedule_documents, lambda: nested.read_quote_documents(spark, str(base / "quotes.json"))
    )
    assert run.status == "success" and run.forecasts.count() == 2 and run.joined.count() == 4
    assert {r.line for r in run.joined.collect()} == {3.5, 5.5}
    assert {r.player_name for r in run.picks.collect()} == {"Jo Name10", "Jo Name11"}
    assert 1 <= run.postable.count() <= 2
    target = str(base / "out")
    for _ in range(2):
        saved = card.save_card(spark, run, root, target)
    status = publish.read_record(spark, saved.path("run_status"))
    assert (status["status"], status["message"]) == ("success", "")
    assert versions.current(spark, target) == saved and saved.number == 2
    shown = versions.at(spark, ledger_root(root), status["ledger_version"])
    keys = [r.pick_key for r in read_version(spark, shown).collect()]
    assert len(keys) == len(set(keys)) and all(k.startswith("2025-08-01|jo name") for k in keys)
    # New training sets leave the ledger alone.
    kept = read_current_ledger(spark, root).count()
    again = dict(publish.resolve_set(spark, root).entries)
    for _ in range(3):
        versions.commit(spark, root, lambda base: versions.Change(put=again))
    versions.expire(spark, root, keep=1)
    assert read_current_ledger(spark, root).count() == kept == len(keys)
    assert set(saved.entries) == {*card.OUTPUTS, *(f"ledger_{n}" for n in ("graded", "skipped", "by_book", "overall"))}
    assert all(exists(spark, saved.path(n)) for n in saved.entries)


STEPS = ("ledger", "slate", "forecasts", "postable", "report", "status", "manifest")


def test_a_card_that_dies_leaves_the_outputs_before_it(spark, frame, tmp_path, monkeypatch):
    """Killed between any two steps: readers see the first card whole, and saving again works."""
    root, target = str(tmp_path / "root"), str(tmp_path / "out")

    def made(day, name):
        day = f"2033-09-{day:02d}"
        row = dict(
            player_name=name, team="T", opponent="O", game_date=day, game_pk=1, is_home=1, pick_type="official", price=120,
            value_score=1,
        )
        ddl = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in row.items())
        table = frame([row], ddl)
        return card.Card(table, table, table, table, table, message=name)

    class Killed(Exception):
        pass

    def dying(*_, **__):
        raise Killed

    first = card.save_card(spark, made(3, "First"), root, target)
    second = made(4, "Second")
    broken = second.slate.withColumn("x", F.raise_error(F.lit("killed")).cast("string"))
    places = {
        "ledger": (card, "persist_ledger"),
        "slate": (card, "save_slate"),
        "report": (card, "write_ledger_report"),
        "status": (publish, "write_record"),
        "manifest": (paths, "publish_if_absent"),
    }
    for step in STEPS:
        given = second
        with monkeypatch.context() as patch:
            if step in places:
                patch.setattr(*places[step], dying)
            else:
                given = dataclasses.replace(second, **{step: broken})
                patch.setattr(card, "persist_ledger", lambda *_: versions.current(spark, ledger_root(root)))
            with pytest.raises(Exception, match="killed" if step not in places else None):
                card.save_card(spark, given, root, target)
        seen = versions.current(spark, target)
        names = {n: {r.player_name for r in spark.read.parquet(seen.path(n)).collect()} for n in ("slate", "joined", "picks")}
        assert seen == first and set(map(tuple, names.values())) == {("First",)}, step
        assert publish.read_record(spark, seen.path("run_status"))["message"] == "First"
    after = card.save_card(spark, second, root, target)
    assert {r.player_name for r in spark.read.parquet(after.path("picks")).collect()} == {"Second"}
    assert sorted(r.player_name for r in read_current_ledger(spark, root).collect()) == ["First", "Second"]


def test_market_and_hooks_of_the_daily_card(spark, published):
    base, root = published
    run = card.daily_card(
        spark,
        root,
        nested.read_schedule_documents(spark, str(base / "schedule.json")),
        lambda: nested.read_quote_documents(spark, str(base / "quotes.json")),
        market="pitcher_outs",
        hooks=card.Hooks(filter_picks=lambda picks: picks.filter("player_name = 'Jo Name10'")),
    )
    assert {r.line for r in run.joined.collect()} == {0.5}
    assert run.picks.count() == 2 and {r.player_name for r in run.postable.collect()} <= {"Jo Name10"}


def test_daily_card_degrades_without_quotes(spark, published):
    base, root = published

    def unavailable():
        raise card.QuotesUnavailable("no service")

    schedule_documents = nested.read_schedule_documents(spark, str(base / "schedule.json"))
    run = card.daily_card(spark, root, schedule_documents, unavailable)
    assert run.status == "degraded" and "no service" in run.message
    assert run.forecasts.count() == 2 and run.picks.count() == 0
    card.save_card(spark, run, root, str(base / "degraded"))


def test_no_starters_is_an_error(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"dates": []}')
    with pytest.raises(ContractError):
        build_slate(nested.read_schedule_documents(spark, str(tmp_path / "s.json")))
