"""Edges: quote documents joined to forecasts, and the best over per participant."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.operators.market import best_over, join_quotes
from tallyline.schemas import MARKET_KEY
from tallyline.sources.nested import flatten_quotes, market_documents


def edges(
    forecasts: DataFrame,
    quote_documents: DataFrame,
    *,
    participant: str = "player_name",
    forecast_key: str = "player_name_norm",
    quote_key: str = "player_name_norm",
    market: str = MARKET_KEY,
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(joined, best over) of one market; no quotes give two empty tables."""
    quotes = flatten_quotes(market_documents(quote_documents), market=market)
    joined = join_quotes(
        forecasts,
        quotes,
        participant=participant,
        forecast_key=forecast_key,
        quote_key=quote_key,
        strict=strict,
    )
    return joined, best_over(joined, group_key=f"{participant}_proj")
