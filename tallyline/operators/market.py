"""Forecast-to-quote joins and the best over quote per participant.

No side is broadcast by hand. Quotes come out of nested documents, whose lists the planner
takes for a row each: it would send millions of quotes through the driver as a small table.
They are joined by sort and merge, which splits a hot name, one that the quote side repeats
while the forecasts hold it once per game. Lines are as large as they are planned; AQE
broadcasts a side of theirs whose measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.contracts import ContractError, check_contract, require_columns
from tallyline.functions.dates import day_text
from tallyline.functions.names import quote_name
from tallyline.schemas import Contract

DEFAULT_PARTICIPANT = "player_name"
DEFAULT_KEY = "player_name_norm"


def with_join_key(
    forecasts: DataFrame, *, participant: str = DEFAULT_PARTICIPANT, join_key: str = DEFAULT_KEY, strict: bool = True
) -> DataFrame:
    """Forecasts with their join key: an existing key is kept, the default key is
    computed from the default name, any other missing key is an error."""
    needed = (participant, "predicted_strikeouts")
    check_contract(forecasts, Contract("forecasts", needed), strict=strict)
    if join_key in forecasts.columns:
        return forecasts
    if (participant, join_key) != (DEFAULT_PARTICIPANT, DEFAULT_KEY):
        raise ContractError(f"forecasts lack the configured join key '{join_key}'")
    return forecasts.withColumn(join_key, quote_name(F.col(participant)))


def _suffixed_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], suffixes: tuple[str, str]
) -> DataFrame:
    """Inner join on pairs of columns. A key of the same name on both sides appears
    once; every other shared column gets its side's suffix. The first pair holds names."""
    merged_keys = {a for a, b in pairs if a == b}
    shared = (set(left.columns) & set(right.columns)) - merged_keys
    # Missing names are blank; a blank name is nobody's and pairs with no other.
    left = left.filter(F.col(pairs[0][0]).cast("string") != "")
    right = right.filter(F.col(pairs[0][1]).cast("string") != "")
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in merged_keys})
    condition = None
    for a, b in pairs:
        own = a + suffixes[0] if a in shared else a
        other = f"_right_{b}" if b in merged_keys else b + suffixes[1] if b in shared else b
        term = F.col(own) == F.col(other)
        condition = term if condition is None else condition & term
    return left.join(right, condition, "inner").drop(*[f"_right_{c}" for c in merged_keys])


def _with_edge(joined: DataFrame) -> DataFrame:
    return joined.withColumn("edge", F.col("predicted_strikeouts") - F.col("line"))


def _never_broadcast(quotes: DataFrame) -> DataFrame:
    """Quotes that no estimate of their size may send through the driver."""
    return quotes.hint("merge")


def join_quotes(
    forecasts: DataFrame,
    quotes: DataFrame,
    *,
    participant: str = DEFAULT_PARTICIPANT,
    forecast_key: str = DEFAULT_KEY,
    quote_key: str = DEFAULT_KEY,
    strict: bool = True,
) -> DataFrame:
    """Forecasts with every quote of the same participant, and the edge over the line."""
    keyed = with_join_key(forecasts, participant=participant, join_key=forecast_key, strict=strict)
    require_columns(quotes, (quote_key, "bookmaker", "side", "line", "price"), "quotes")
    pairs = [(forecast_key, quote_key)]
    return _with_edge(_suffixed_join(keyed, _never_broadcast(quotes), pairs, ("_proj", "_odds")))


# Names that differ in case and accents alone are equal under it.
NAME_COLLATION = "UNICODE_CI_AI"


def join_quotes_by_collation(
    forecasts: DataFrame, quotes: DataFrame, *, participant: str = DEFAULT_PARTICIPANT, name: str = "player_name"
) -> DataFrame:
    """Forecasts with every quote whose participant's name is the same but for case and
    accents, and the edge over the line. The names themselves are joined, under a collation;
    no folded copy of them is made. Shared columns get ``_proj`` and ``_odds``; blank names
    pair with nothing."""
    require_columns(forecasts, (participant, "predicted_strikeouts"), "forecasts")
    require_columns(quotes, (name, "bookmaker", "side", "line", "price"), "quotes")
    shared = set(forecasts.columns) & set(quotes.columns)
    left = forecasts.filter(F.trim(participant) != "").withColumnsRenamed({c: f"{c}_proj" for c in shared})
    right = quotes.filter(F.trim(name) != "").withColumnsRenamed({c: f"{c}_odds" for c in shared})
    own = f"{participant}_proj" if participant in shared else participant
    other = f"{name}_odds" if name in shared else name
    same = F.collate(F.trim(own), NAME_COLLATION) == F.collate(F.trim(other), NAME_COLLATION)
    return _with_edge(left.join(_never_broadcast(right), same))


def join_historical_lines(
    forecasts: DataFrame,
    lines: DataFrame,
    *,
    participant: str = DEFAULT_PARTICIPANT,
    forecast_key: str = DEFAULT_KEY,
    line_key: str = DEFAULT_KEY,
    forecast_date: str = "game_date",
    line_date: str = "game_date",
    strict: bool = True,
) -> DataFrame:
    """Forecasts with the curated lines of the same participant and day."""
    keyed = with_join_key(forecasts, participant=participant, join_key=forecast_key, strict=strict)
    require_columns(lines, (line_key, line_date, "bookmaker", "side", "line", "price"), "curated_lines")
    require_columns(keyed, (forecast_date,), "forecasts")
    keyed = keyed.withColumn(forecast_date, day_text(F.col(forecast_date)))
    lines = lines.withColumn(line_date, day_text(F.col(line_date)))
    pairs = [(forecast_key, line_key), (forecast_date, line_date)]
    return _with_edge(_suffixed_join(keyed, lines, pairs, ("_proj", "_line")))


def best_over(joined: DataFrame, *, group_key: str = "player_name_proj") -> DataFrame:
    """Per participant the first known value of every column among its over quotes in
    descending edge order. Each column is one partial ``max_by``, so a participant's
    quotes are never gathered."""
    require_columns(joined, ("side", "edge", group_key), "joined_quotes")
    ties = [c for c in ("bookmaker", "line", "price") if c in joined.columns]
    rank = F.struct(F.col("edge").isNotNull(), "edge", *ties)
    others = [c for c in joined.columns if c != group_key]
    overs = joined.filter((F.lower("side") == "over") & F.col(group_key).isNotNull())
    # max_by passes over rows whose ordering is NULL, here those without a value.
    firsts = [F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in others]
    return overs.groupBy(group_key).agg(*firsts)
