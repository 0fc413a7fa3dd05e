import datetime
import json

import pytest
from pyspark.sql import functions as F

from tallyline.contracts import ContractError
from tallyline.operators import backtest, lines, market, picks
from tallyline.plans.backtest import historical_backtest
from tallyline.schemas import QUOTES_DOCUMENT
from tallyline.sources.nested import flatten_quotes, market_documents, parse_documents

JOINED_DDL = (
    "player_name_proj string, predicted_strikeouts double, bookmaker string, side string, line double, price double, "
    "actual_strikeouts double"
)
LINE_DDL = (
    "game_date string, player_name string, market_key string, bookmaker string, bookmaker_key string, side string, "
    "line string, price string, event_id string, commence_time string, pulled_at string, snapshot_rank string"
)


DAY = datetime.date(2033, 9, 3)
START = datetime.datetime(2033, 9, 3, 17, 25)


def snapshot(minutes, **over):
    """A snapshot pulled so many minutes after the start of its game."""
    row = dict(
        game_date=str(DAY), player_name="Ida Fenn", market_key="pitcher_strikeouts", bookmaker="Northbook",
        bookmaker_key="north", side="Over", line="3.5", price="140", event_id="match-4",
        commence_time=f"{START.isoformat()}Z", pulled_at=f"{(START + datetime.timedelta(minutes=minutes)).isoformat()}Z",
    )
    row.update(over)
    return row


def with_line(minutes, line, **over):
    return snapshot(minutes, line=str(line), **over)


# One participant for each rule of the choice; the winner of each is the row marked.
SNAPSHOTS = [
    with_line(-95, 3.5),
    with_line(-20, 4.0, player_name=" IDA FENN"),
    with_line(0, 8.5, player_name="Ida FENN"),  # at the start still counts as before it
    with_line(1, 9.5),
    with_line(5, 2.5, player_name="Rui Sato", side="Under"),
    with_line(50, 1.5, player_name="Rui Sato", side="Under"),  # only later rows: the latest
    with_line(-8, 11.0, player_name="Lev Ohm", snapshot_rank="2"),  # a tie in time: the higher rank
    with_line(-8, 12.0, player_name="Lev Ohm", snapshot_rank="1"),
    with_line(-3, 13.5, player_name="Lev Ohm", market_key="outs"),
    with_line(-3, 14.5, player_name="Lev Ohm", bookmaker="Southbook"),  # another book is another key
]


def test_curation_follows_its_rules(frame):
    curated = lines.curate_lines(lines.normalize_snapshots(frame(SNAPSHOTS, LINE_DDL)))
    got = curated.orderBy("player_name_norm", "bookmaker").collect()
    assert [(r.player_name_norm, r.bookmaker, r.line, r.is_closing_line) for r in got] == [
        ("ida fenn", "Northbook", 8.5, True),
        ("lev ohm", "Northbook", 11.0, True),
        ("lev ohm", "Southbook", 14.5, True),
        ("rui sato", "Northbook", 1.5, False),
    ]
    assert {(r.selection_rule, r.source) for r in got} == {(lines.SELECTION_RULE, lines.LINE_SOURCE)}


def test_curation_in_steps(frame):
    snapshots = lines.normalize_snapshots(frame(SNAPSHOTS, LINE_DDL))
    whole = sorted(map(tuple, lines.curate_lines(snapshots).collect()))
    for cut in (2.0, 8.0, 11.5, 14.0):
        first = lines.curate_lines(snapshots.filter(F.col("line") < cut))
        stepwise = lines.curate_lines(first.unionByName(snapshots.filter(F.col("line") >= cut)))
        assert sorted(map(tuple, stepwise.collect())) == whole


def test_curation_rejects_missing_prices(frame):
    with pytest.raises(ContractError):
        lines.curate_lines(lines.normalize_snapshots(frame([snapshot(-1, price="EVEN")], LINE_DDL)))


def quote(name, predicted, side, line, price, book="DK", actual=None):
    return dict(
        player_name_proj=name, predicted_strikeouts=predicted, bookmaker=book, side=side, line=line, price=price,
        actual_strikeouts=actual,
    )


def only(frame, rows, **options):
    policy = options.get("policy", picks.DEFAULT_POLICY)
    return picks.daily_picks(frame(rows, JOINED_DDL), **options).orderBy(*policy.order()).collect()


def test_best_quotes_per_side(frame):
    rows = [quote("A", 6.0, s, l, p) for s, l, p in (
        ("over", 5.5, -120.0), ("Over", 5.5, 100.0), ("over ", 6.5, 150.0),
        ("under", 5.5, -110.0), ("UNDER", 6.5, -125.0), ("under", 6.5, 105.0), ("yes", 1.0, 900.0),
    )]
    best = picks.best_side_quotes(frame(rows, JOINED_DDL)).filter("side_norm <> 'yes'").orderBy("side_norm")
    assert [(r._quote.line, r._quote.price) for r in best.collect()] == [(5.5, 100.0), (6.5, 105.0)]


def test_line_beats_price(frame):
    row = only(frame, [quote("A", 6.8, "over", 6.5, -120.0), quote("A", 6.8, "over", 5.5, -140.0)])[0]
    assert row.line == 5.5 and row.edge == pytest.approx(1.3) and row.pick_type == "official"


def test_tie_preference(frame):
    rows = [quote("A", 6.0, "over", 5.5, 100.0), quote("A", 6.0, "under", 6.5, 100.0)]
    assert only(frame, rows)[0].pick_side == "over"
    under = only(frame, rows, policy=picks.PickPolicy(tie_side="under"))[0]
    assert under.pick_side == "under" and under.edge == 0.5


def test_value_outranks_edge_and_missing_price_is_thin(frame):
    rows = [
        quote("Big", 6.3, "over", 5.5, -300.0), quote("Value", 6.26, "over", 5.5, 150.0),
        quote("None", 9.0, "over", 5.5, None), quote("Lean", 6.0, "over", 5.5, 100.0),
        quote("Negative", 4.0, "over", 5.5, 100.0), quote("Pass", 5.6, "over", 5.5, 100.0),
    ]
    got = only(frame, rows)
    assert [r.player_name for r in got] == ["Negative", "Value", "Big", "None", "Lean", "Pass"]
    assert {r.player_name: r.confidence_tier for r in got}["None"] == "thin"
    assert got[0].edge == -1.5 and got[0].pick_type == "official"


def test_classes_and_tiers_are_inclusive(frame):
    df = frame([dict(e=e) for e in (0.75, 0.40, 0.39, -0.75, 0.5, 0.3, 0.15, 0.14)], "e double")
    policy = picks.DEFAULT_POLICY
    got = df.select(policy.pick_class(F.col("e")), policy.tier(F.col("e"))).collect()
    assert [r[0] for r in got[:4]] == ["official", "lean", "pass", "official"]
    assert [r[1] for r in got[4:]] == ["high", "medium", "low", "thin"]


def test_caps(frame):
    rows = [quote(f"o{i}", 8.0 + i, "over", 5.5, 100.0) for i in range(6)]
    rows += [quote(f"l{i}", 6.0 + i / 100, "over", 5.5, 100.0) for i in range(4)]
    df = picks.daily_picks(frame(rows, JOINED_DDL))
    assert [r.player_name for r in picks.postable_picks(df).collect()] == ["o5", "o4", "o3", "o2", "l3", "l2"]
    assert picks.postable_picks(df, official=1, lean=0).count() == 1


def test_null_side_is_a_contract_error(frame):
    with pytest.raises(ContractError):
        only(frame, [quote("A", 6.0, None, 5.5, 100.0)])
    assert only(frame, []) == []


FORECAST_DDL = "game_date string, player_name string, predicted_strikeouts double, actual_strikeouts double"


def test_joins(frame):
    forecasts = frame([dict(player_name="Ana McVale", predicted_strikeouts=7.0, game_date="2031-05-14")], FORECAST_DDL)
    quotes = frame(
        [dict(player_name="Ana Mcvale", k="ana mcvale", bookmaker="DK", side="Over", line=5.5, price=100.0)],
        "player_name string, k string, bookmaker string, side string, line double, price double",
    )
    row = market.join_quotes(forecasts, quotes.withColumnRenamed("k", "player_name_norm")).first()
    assert (row.player_name_proj, row.player_name_odds, row.edge) == ("Ana McVale", "Ana Mcvale", 1.5)
    other = market.join_quotes(forecasts.withColumn("key", F.lit("ana mcvale")), quotes, forecast_key="key", quote_key="k")
    assert other.count() == 1
    kept = forecasts.withColumn("player_name_norm", F.lit("someone else"))
    assert market.join_quotes(kept, quotes.withColumnRenamed("k", "player_name_norm")).count() == 0
    with pytest.raises(ContractError):
        market.join_quotes(forecasts, quotes, forecast_key="other")


def test_best_over_takes_first_known_value_per_column(frame):
    rows = [
        dict(player_name_proj="A", side="Over", edge=2.0, bookmaker="X", price=None),
        dict(player_name_proj="A", side="over", edge=1.0, bookmaker="Y", price=100.0),
        dict(player_name_proj="A", side=None, edge=9.0, bookmaker="Z", price=1.0),
        dict(player_name_proj="B", side="over", edge=3.0, bookmaker="X", price=5.0),
        dict(player_name_proj="C", side="under", edge=3.0, bookmaker="X", price=5.0),
    ]
    got = market.best_over(frame(rows, "player_name_proj string, side string, edge double, bookmaker string, price double"))
    assert [(r.player_name_proj, r.edge, r.bookmaker, r.price) for r in got.orderBy(F.desc("edge")).collect()] == [
        ("B", 3.0, "X", 5.0), ("A", 2.0, "X", 100.0),
    ]


def test_backtest_counts_each_outcome(frame):
    """(forecast, side, line, price, book, realized): a win on either side, a loss on either
    side, a push, and a row without outcome; "Cleared" has a worse line at another book."""
    rows = [
        quote("Cleared", 9.1, "Over", 8.0, 130.0, "Northbook", 11.0),
        quote("Cleared", 9.1, "Over", 8.5, 155.0, "Southbook", 11.0),
        quote("Ducked", 1.9, "under", 3.0, 170.0, "Eastbook", 0.0),
        quote("Level", 3.45, "Under ", 4.0, -140.0, "Southbook", 4.0),
        quote("Missed", 7.3, "over", 7.0, -105.0, "Northbook", 2.0),
        quote("Sank", 6.55, "UNDER", 7.5, -180.0, "Eastbook", 10.0),
        quote("Scratched", 5.2, "over", 4.2, -130.0, "Northbook", None),
    ]
    joined = frame(rows, JOINED_DDL)
    graded = backtest.run_backtest(joined)
    summary = {(r.grouping, r.group_value): r for r in backtest.summarize_backtest(graded).collect()}
    overall = summary["overall", None]
    assert (overall.picks, overall.wins, overall.losses, overall.pushes, overall.decisions) == (5, 2, 2, 1, 4)
    assert overall.profit_units == pytest.approx(1.3 + 1.7 - 2) and overall.win_rate == 0.5
    assert {v: r.picks for (g, v), r in summary.items() if g == "by_line_band"} == {"<=4.5": 2, "6.5-7.5": 2, "7.5+": 1}
    assert {v: r.picks for (g, v), r in summary.items() if g == "by_book"} == {"Northbook": 2, "Southbook": 1, "Eastbook": 2}
    one = {r.pick_type: (r.wins, r.losses) for r in backtest.summarize_one(graded, "pick_type").collect()}
    assert one == {"official": (2, 1), "lean": (0, 0), "pass": (0, 1)}
    status = backtest.backtest_status(joined, graded).first()
    assert (status.available, status.reason, status.graded_pick_rows) == (True, None, 5)


def test_a_missing_group_value_is_a_group_of_its_own(frame):
    rows = [quote("A", 7.0, "Over", 6.0, -110.0, None, 8.0), quote("B", 7.0, "Over", 6.0, -110.0, "X", 8.0)]
    graded = backtest.run_backtest(frame(rows, JOINED_DDL), strict=False)
    got = backtest.summarize_backtest(graded).filter("grouping = 'by_book'").collect()
    assert {(r.group_value, r.picks) for r in got} == {(None, 1), ("X", 1)}


def test_historical_backtest(frame):
    forecasts = frame(
        [
            dict(game_date=str(DAY), player_name="Ida Fenn", predicted_strikeouts=10.2, actual_strikeouts=12.0),
            dict(game_date=str(DAY), player_name="Rui Sato", predicted_strikeouts=0.4, actual_strikeouts=3.0),
        ],
        FORECAST_DDL,
    )
    curated = lines.curate_lines(lines.normalize_snapshots(frame(SNAPSHOTS, LINE_DDL)))
    result = historical_backtest(forecasts, curated)
    overall = result.summary.filter("grouping = 'overall'").first()
    assert (overall.picks, overall.wins, overall.losses) == (2, 1, 1)
    none = historical_backtest(forecasts.withColumn("game_date", F.lit("2033-09-04")), curated)
    status = none.status.first()
    assert (status.available, status.reason) == (False, backtest.NO_LINES)
    assert none.summary.count() == 0


def test_names_meet_by_collation(frame):
    forecasts = frame(
        [dict(player_name=n, predicted_strikeouts=5.0, game_date="x") for n in ("José Núñez", "Ana  Li", " ", None, "Zoë")],
        FORECAST_DDL,
    )
    quotes = frame(
        [dict(player_name=n, bookmaker="B", side="Over", line=3.5, price=1.0) for n in ("JOSE NUNEZ", "Jose Nuñez ", "", None, "zoe", "Zo")],
        "player_name string, bookmaker string, side string, line double, price double",
    )
    joined = market.join_quotes_by_collation(forecasts, quotes)
    assert sorted((r.player_name_proj, r.player_name_odds, r.edge) for r in joined.collect()) == [
        ("José Núñez", "JOSE NUNEZ", 1.5), ("José Núñez", "Jose Nuñez ", 1.5), ("Zoë", "zoe", 1.5),
    ]
    plan = joined._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "translate" not in plan


def test_quotes_never_pass_through_the_driver(spark, frame, tmp_path):
    """Quotes of documents with long lists, which are planned as a row each."""
    book = {"key": "north", "markets": [{"key": "outs", "outcomes": [
        {"name": "Over", "description": "Ida Fenn", "point": float(i), "price": 100.0} for i in range(3000)
    ]}]}
    texts = [(json.dumps({"id": f"match-{i}", "bookmakers": [book]}),) for i in range(4)]
    spark.createDataFrame(texts, "text string").write.parquet(str(tmp_path / "documents"))
    documents = parse_documents(spark.read.parquet(str(tmp_path / "documents")), "text", QUOTES_DOCUMENT)
    quotes = flatten_quotes(market_documents(documents))
    forecasts = frame([dict(player_name="Ida Fenn", predicted_strikeouts=5.0)], "player_name string, predicted_strikeouts double")
    for join in (market.join_quotes, market.join_quotes_by_collation):
        joined = join(forecasts, quotes)
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 12_000


def test_forecasts_of_the_picks_never_pass_through_the_driver(frame):
    """However small they prove when the query runs."""
    rows = [quote(f"Player {i}", 6.0, side, 5.5, -110.0) for i in range(20) for side in ("over", "under")]
    chosen = picks.daily_picks(frame(rows, JOINED_DDL))
    assert len(chosen.collect()) == 20
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan
