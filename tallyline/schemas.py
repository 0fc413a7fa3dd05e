"""Table layouts and the data contracts checked between stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def layout(*columns: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


_text, _long, _int, _double, _date = StringType(), LongType(), IntegerType(), DoubleType(), DateType()

# The column names below are the public data model.
EVENT = layout(
    ("game_date", _date),
    ("game_pk", _long),
    ("pitcher", _long),
    ("player_name", _text),
    ("batter", _long),
    ("pitch_type", _text),
    ("release_speed", _double),
    ("release_spin_rate", _double),
    ("description", _text),
    ("events", _text),
    ("inning", _int),
    ("outs_when_up", _int),
    ("home_team", _text),
    ("away_team", _text),
    ("stand", _text),
    ("p_throws", _text),
    ("inning_topbot", _text),
)

SLATE = layout(
    ("game_date", _date),
    ("game_pk", _long),
    ("pitcher", _long),
    ("player_name", _text),
    ("team", _text),
    ("opponent", _text),
    ("home_team", _text),
    ("away_team", _text),
    ("is_home", _int),
    ("p_throws", _text),
)

GROUP_CONTEXT = layout(
    ("opponent_team", _text),
    ("opp_strikeouts_per_game_last10", _double),
    ("opp_k_rate_last10", _double),
)

SCHEDULE_SIDE = layout(
    ("team", layout(("abbreviation", _text))),
    ("probablePitcher", layout(("id", _long), ("fullName", _text), ("pitchHand", layout(("code", _text))))),
)

SCHEDULE_DOCUMENT = layout(
    (
        "dates",
        ArrayType(
            layout(
                ("date", _text),
                (
                    "games",
                    ArrayType(
                        layout(
                            ("gamePk", _long),
                            ("teams", layout(("away", SCHEDULE_SIDE), ("home", SCHEDULE_SIDE))),
                        )
                    ),
                ),
            )
        ),
    ),
)

QUOTES_DOCUMENT = layout(
    ("id", _text),
    ("commence_time", _text),
    ("home_team", _text),
    ("away_team", _text),
    (
        "bookmakers",
        ArrayType(
            layout(
                ("key", _text),
                ("last_update", _text),
                (
                    "markets",
                    ArrayType(
                        layout(
                            ("key", _text),
                            (
                                "outcomes",
                                ArrayType(
                                    layout(
                                        ("name", _text),
                                        ("description", _text),
                                        ("point", _double),
                                        ("price", _double),
                                    )
                                ),
                            ),
                        )
                    ),
                ),
            )
        ),
    ),
)

QUOTE = layout(
    ("event_id", _text),
    ("commence_time", _text),
    ("home_team", _text),
    ("away_team", _text),
    ("bookmaker", _text),
    ("bookmaker_key", _text),
    ("book_last_update", _text),
    ("market_key", _text),
    ("player_name", _text),
    ("player_name_norm", _text),
    ("side", _text),
    ("line", _double),
    ("price", _double),
)

CURATED_LINE = layout(
    ("game_date", _text),
    ("player_name", _text),
    ("player_name_norm", _text),
    ("market_key", _text),
    ("bookmaker", _text),
    ("bookmaker_key", _text),
    ("side", _text),
    ("line", _double),
    ("price", _double),
    ("event_id", _text),
    ("commence_time", TimestampType()),
    ("selection_rule", _text),
    ("source", _text),
    ("pulled_at", TimestampType()),
    ("snapshot_type", _text),
    ("is_closing_line", BooleanType()),
    ("snapshot_rank", _double),
)

RAW_LINE_COLUMNS = ("game_date", "player_name", "market_key", "bookmaker", "side", "line", "price")

JOINED = layout(
    ("player_name_proj", _text),
    ("predicted_strikeouts", _double),
    ("bookmaker", _text),
    ("side", _text),
    ("line", _double),
    ("price", _double),
)

PICK = layout(
    ("player_name", _text),
    ("book", _text),
    ("pick_side", _text),
    ("line", _double),
    ("price", _double),
    ("edge", _double),
    ("pick_type", _text),
    ("implied_probability", _double),
    ("value_score", _double),
    ("confidence_tier", _text),
)

PICK_FIRST_COLUMNS = (
    "player_name",
    "team",
    "opponent",
    "predicted_strikeouts",
    "lower_bound",
    "upper_bound",
    "std_dev",
    "book",
    "pick_side",
    "line",
    "price",
    "edge",
    "implied_probability",
    "value_score",
    "confidence_tier",
    "pick_type",
)

LEDGER_COLUMNS = (
    "pick_key",
    "game_date",
    "player_name",
    "team",
    "opponent",
    "book",
    "odds",
    "price",
    "pick_side",
    "line",
    "predicted_strikeouts",
    "edge",
    "confidence_tier",
    "pick_type",
    "result",
    "actual_strikeouts",
    "record_source",
)

LEDGER = layout(*[(name, _text) for name in LEDGER_COLUMNS])

LEDGER_REPORT = StructType(
    LEDGER.fields
    + layout(
        ("result_normalized", _text),
        ("odds_numeric", _double),
        ("units_risked", _double),
        ("units_result", _double),
    ).fields
)

LEDGER_BY_BOOK = layout(
    ("book", _text),
    ("picks", _long),
    ("wins", _long),
    ("losses", _long),
    ("pushes", _long),
    ("decisions", _long),
    ("units_risked", _double),
    ("units_profit", _double),
    ("win_rate", _double),
    ("roi", _double),
)

# Model inputs, label and split of the workload.
MODEL_FEATURES = (
    "pitches_last3",
    "pitches_last10",
    "whiff_per_pitch_last3",
    "avg_velo_last3",
    "avg_spin_last3",
    "k_per_pitch_last10",
    "k_rate_last10",
    "opp_strikeouts_per_game_last10",
    "opp_k_rate_last10",
)
MODEL_LABEL = "strikeouts"
UNCERTAINTY_COLUMNS = ("strikeouts_stddev_last10", "strikeouts_p25_last10", "strikeouts_p75_last10")
SPLIT_DATE = "2025-08-01"
EVENT_RANGE = ("2023-03-27", "2025-09-30")
MARKET_KEY = "pitcher_strikeouts"
STARTER_MIN_PITCHES = 40
STARTER_MIN_BATTERS = 12
MIN_CAREER_STARTS = 5
SELECTION_RULE = "latest_pregame_snapshot_per_game_player_book_side"
LINE_SOURCE = "native_raw_historical_lines"
SNAPSHOT_TYPE = "raw_snapshot"
BOOK_NAMES = {
    "draftkings": "DraftKings",
    "fanduel": "FanDuel",
    "betmgm": "BetMGM",
    "williamhill_us": "Caesars",
}


@dataclass(frozen=True)
class Contract:
    """What a table must satisfy at a stage boundary."""

    name: str
    required: tuple[str, ...]
    non_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    zero_one: tuple[str, ...] = ()
    allow_empty: bool = False


SLATE_CONTRACT = Contract(
    name="slate",
    required=tuple(SLATE.names),
    non_null=("game_date", "game_pk", "player_name", "team", "opponent", "home_team", "away_team", "is_home"),
    unique=("game_date", "game_pk", "player_name"),
    zero_one=("is_home",),
)

HISTORY_CONTRACT = Contract(
    name="entity_periods",
    required=("game_date", "game_pk", "pitcher", "player_name", "pitching_team", "opponent_team"),
    non_null=("game_date", "game_pk", "pitcher", "player_name"),
    unique=("game_date", "game_pk", "pitcher"),
)

JOINED_CONTRACT = Contract(
    name="joined_quotes",
    required=tuple(JOINED.names),
    non_null=("player_name_proj", "predicted_strikeouts", "bookmaker", "side", "line"),
)

PICKS_CONTRACT = Contract(
    name="picks",
    required=tuple(PICK.names),
    non_null=("player_name", "book", "pick_side", "line", "edge", "pick_type"),
)

LINES_CONTRACT = Contract(
    name="curated_lines",
    required=(
        "game_date",
        "player_name",
        "player_name_norm",
        "market_key",
        "bookmaker",
        "side",
        "line",
        "price",
        "selection_rule",
        "source",
    ),
    non_null=(
        "game_date",
        "player_name",
        "player_name_norm",
        "market_key",
        "bookmaker",
        "side",
        "line",
        "price",
        "selection_rule",
        "source",
    ),
    unique=("game_date", "player_name_norm", "bookmaker", "side"),
    allow_empty=True,
)
