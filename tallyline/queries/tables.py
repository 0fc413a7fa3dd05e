"""The given tables seen through the engine's data model.

Every view is a projection of one table (no filter, no sample): names map to SQL
expressions that mean the same in Spark and in the checking engine. Missing values, NaN,
blanks and accented names are put in on purpose, so that the null rules are exercised.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as it lies there."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class View:
    source: str
    columns: dict[str, str]
    # Expressions that need another spelling in the checking engine.
    sql_columns: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, self.source).selectExpr(*[f"{e} AS {n}" for n, e in self.columns.items()])

    def sql(self) -> str:
        chosen = {**self.columns, **self.sql_columns}
        return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in chosen.items()) + f" FROM {self.source}"


# ---- events: lineitem rows, supplier = entity, quarter = period ---------------------

_game = "CAST(floor(l_suppkey / 2) AS BIGINT)"
_quarter = "(year(l_shipdate) * 4 + quarter(l_shipdate))"
_home = f"'T' || lpad(CAST(({_game} + {_quarter}) % 30 AS STRING), 2, '0')"
_away = f"'T' || lpad(CAST(({_game} + {_quarter} + 1 + {_game} % 29) % 30 AS STRING), 2, '0')"

EVENTS = View(
    "lineitem",
    {
        "game_date": "CAST(date_trunc('quarter', l_shipdate) AS DATE)",
        "game_pk": f"CAST({_quarter} AS BIGINT) * 10000000 + {_game}",
        "pitcher": "l_suppkey",
        "player_name": "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
        "ELSE 'O''Brién-' || CAST(l_suppkey AS STRING) || ',  José' END",
        "batter": "CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_partkey % 40 END",
        "pitch_type": "CASE WHEN l_tax > 0.075 THEN NULL ELSE l_returnflag END",
        "release_speed": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END",
        "release_spin_rate": "CASE WHEN l_linenumber = 6 THEN CAST('NaN' AS DOUBLE) "
        "ELSE CAST(floor(l_extendedprice / 100) AS DOUBLE) END",
        "description": "CASE WHEN l_returnflag = 'R' THEN 'swinging_strike' "
        "WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'swinging_strike_blocked' "
        "WHEN l_linenumber = 2 THEN NULL ELSE 'ball' END",
        "events": "CASE WHEN l_linestatus = 'O' AND l_linenumber <= 2 THEN 'strikeout' "
        "WHEN l_linestatus = 'F' AND l_linenumber = 3 THEN 'strikeout_double_play' "
        "WHEN l_linenumber = 4 THEN 'field_out' ELSE NULL END",
        "inning": "l_linenumber",
        "outs_when_up": "l_linenumber % 3",
        "home_team": _home,
        "away_team": _away,
        "stand": "CASE WHEN l_partkey % 2 = 0 THEN 'L' ELSE 'R' END",
        "p_throws": "CASE WHEN l_suppkey % 3 = 0 THEN 'L' ELSE 'R' END",
        "inning_topbot": "CASE WHEN l_suppkey % 2 = 0 THEN 'Top' ELSE 'Bot' END",
    },
    {
        "release_spin_rate": "CASE WHEN l_linenumber = 6 THEN NULL "
        "ELSE CAST(floor(l_extendedprice / 100) AS DOUBLE) END",
    },
)

# ---- slates ------------------------------------------------------------------------

# Fifteen customers per supplier, each with a slate date of its own; some with an
# unknown or missing id, which only the name can match.
_entity = "CAST(floor(c_custkey / 15) AS BIGINT)"
SLATE = View(
    "customer",
    {
        "game_date": "DATE '1995-03-01' + CAST((c_custkey * 37) % 2400 AS INT)",
        "game_pk": "900000000 + c_custkey",
        "pitcher": f"CASE WHEN c_custkey % 10 = 3 THEN -1 - c_custkey WHEN c_custkey % 10 = 7 THEN NULL "
        f"ELSE {_entity} END",
        "player_name": f"' Jose  O''Brien-' || CAST({_entity} AS STRING)",
        "team": "'T' || lpad(CAST(c_nationkey % 30 AS STRING), 2, '0')",
        "opponent": "'T' || lpad(CAST((c_nationkey + 4) % 30 AS STRING), 2, '0')",
        "home_team": "CASE WHEN c_custkey % 2 = 1 THEN 'T' || lpad(CAST(c_nationkey % 30 AS STRING), 2, '0') "
        "ELSE 'T' || lpad(CAST((c_nationkey + 4) % 30 AS STRING), 2, '0') END",
        "away_team": "CASE WHEN c_custkey % 2 = 0 THEN 'T' || lpad(CAST(c_nationkey % 30 AS STRING), 2, '0') "
        "ELSE 'T' || lpad(CAST((c_nationkey + 4) % 30 AS STRING), 2, '0') END",
        "is_home": "CAST(c_custkey % 2 AS INT)",
        "p_throws": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'R' END",
    },
)

# A slate as it arrives: untidy names and codes, several copies of a (date, game, entity).
RAW_SLATE = View(
    "orders",
    {
        "game_date": "CAST(o_orderdate AS DATE)",
        "game_pk": "o_custkey",
        "pitcher": "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END",
        "player_name": "' J.D. O''Neil-' || CAST(o_orderkey AS STRING) || ' '",
        "team": "' t' || CAST(o_custkey % 30 AS STRING)",
        "opponent": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'u' || CAST(o_custkey % 30 AS STRING) || ' ' END",
        "home_team": "CASE WHEN o_orderkey % 29 = 0 THEN 'z' WHEN o_orderkey % 2 = 1 THEN 't' ELSE 'u' END "
        "|| CAST(o_custkey % 30 AS STRING)",
        "away_team": "CASE WHEN o_orderkey % 2 = 0 THEN 't' ELSE 'u' END || CAST(o_custkey % 30 AS STRING)",
        "is_home": "CAST(CASE WHEN o_orderkey % 43 = 0 THEN 2 ELSE o_orderkey % 2 END AS INT)",
        "p_throws": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'R' END",
    },
)

# ---- quotes, lines and forecasts: events of users ----------------------------------

_user = "'Jr. O''Neil-' || CAST(user_id AS STRING)"
_line = "CAST(floor(value / 4) AS DOUBLE) / 2"
_k = "CAST(get_json_object(props, '$.k') AS INT)"
_k_sql = "CAST(json_extract_string(props, '$.k') AS INT)"
_price = "CASE WHEN {k} < 50 THEN -(100.0 + {k}) ELSE 100.0 + {k} END"
_book = (
    "CASE (event_id + {shift}) % 5 WHEN 0 THEN 'draftkings' WHEN 1 THEN 'fanduel' "
    "WHEN 2 THEN 'betmgm' WHEN 3 THEN 'williamhill_us' ELSE 'localbook' END"
)


def _with_k(columns: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """Columns that read the JSON property, in both spellings."""
    return (
        {n: e.replace("{k}", _k) for n, e in columns.items()},
        {n: e.replace("{k}", _k_sql) for n, e in columns.items()},
    )


_quote_columns, _quote_columns_sql = _with_k(
    {
        "event_id": "event_id",
        "event_day": "CAST(ts AS DATE)",
        "user_id": "user_id",
        "player_name": _user,
        "line": _line,
        "price": f"CAST({_price} AS DOUBLE)",
        "book_a": _book.replace("{shift}", "0"),
        "book_b": _book.replace("{shift}", "2"),
    }
)
QUOTE_SEEDS = View("events", _quote_columns, _quote_columns_sql)

_raw_columns, _raw_columns_sql = _with_k(
    {
        "game_date": "CAST(CAST(ts AS DATE) AS STRING)",
        "player_name": f"' ' || {_user} || ' '",
        "market_key": "CASE WHEN event_id % 7 = 0 THEN 'batter_hits' ELSE 'pitcher_strikeouts' END",
        "bookmaker": "event_type || ' '",
        "bookmaker_key": "CASE event_id % 3 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE upper(event_type) END",
        "side": "CASE WHEN {k} % 2 = 0 THEN 'Over' ELSE ' Under' END",
        "line": f"CAST({_line} AS STRING)",
        "price": f"CAST(CAST({_price} AS DOUBLE) AS STRING)",
        "event_id": "'evt_' || CAST(event_id AS STRING)",
        "commence_time": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) || 'T18:00:00Z' END",
        "pulled_at": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE substr(CAST(ts AS STRING), 1, 19) END",
        "source": "CASE WHEN event_id % 2 = 0 THEN 'feed' ELSE NULL END",
        "snapshot_rank": "CASE WHEN {k} % 4 = 0 THEN NULL ELSE CAST({k} AS STRING) END",
    }
)
RAW_LINES = View("events", _raw_columns, _raw_columns_sql)

# The same snapshots with text in numeric fields, for the coercion rules.
DIRTY_LINES = View(
    "events",
    {
        **_raw_columns,
        "line": f"CASE WHEN event_id % 31 = 0 THEN 'n/a' ELSE {_raw_columns['line']} END",
        "price": f"CASE WHEN event_id % 37 = 0 THEN 'EVEN' ELSE {_raw_columns['price']} END",
        "pulled_at": f"CASE WHEN event_id % 29 = 0 THEN 'soon' ELSE {_raw_columns['pulled_at']} END",
    },
    {
        **_raw_columns_sql,
        "line": f"CASE WHEN event_id % 31 = 0 THEN 'n/a' ELSE {_raw_columns_sql['line']} END",
        "price": f"CASE WHEN event_id % 37 = 0 THEN 'EVEN' ELSE {_raw_columns_sql['price']} END",
        "pulled_at": f"CASE WHEN event_id % 29 = 0 THEN 'soon' ELSE {_raw_columns_sql['pulled_at']} END",
    },
)

# ---- ledger: orders ----------------------------------------------------------------

_odds = "o_orderkey % 200 - 100"
LEDGER = View(
    "orders",
    {
        "pick_key": "CAST(o_orderkey AS STRING)",
        "game_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
        "player_name": "'Order ' || CAST(o_orderkey AS STRING)",
        "team": "''",
        "opponent": "''",
        "book": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END",
        "odds": "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'even' "
        f"WHEN {_odds} > 0 THEN '+' || CAST({_odds} + 100 AS STRING) WHEN {_odds} = 0 THEN '0' "
        f"ELSE CAST({_odds} - 100 AS STRING) END",
        "price": "CASE WHEN o_orderkey % 22 = 0 THEN '-110' ELSE '' END",
        "pick_side": "CASE WHEN o_orderkey % 2 = 0 THEN 'over' ELSE 'under' END",
        "line": "CAST(o_custkey % 10 AS STRING)",
        "predicted_strikeouts": "''",
        "edge": "''",
        "confidence_tier": "'high'",
        "pick_type": "CASE WHEN o_orderkey % 6 = 0 THEN 'lean' ELSE 'official' END",
        "result": "CASE o_orderstatus WHEN 'F' THEN ' win' WHEN 'O' THEN 'L' ELSE "
        "CASE WHEN o_orderkey % 3 = 0 THEN 'PUSH' ELSE '' END END",
        "actual_strikeouts": "CASE o_orderstatus WHEN 'P' THEN '' ELSE CAST(o_custkey % 12 AS STRING) END",
        "record_source": "'manual_seed'",
    },
)

# New rows for the upsert: one per order that has line items, with keys that reach past
# the ledger's, so that some rows are new, some replace and some stay untouched.
NEW_LEDGER_KEYS = View(
    "lineitem",
    {
        "pick_key": "CAST(l_orderkey + 5000 AS STRING)",
        "quantity": "CAST(l_quantity AS BIGINT)",
    },
)
