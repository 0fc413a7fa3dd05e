"""Flattening of nested schedule and quote documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyline.functions.names import quote_name
from tallyline.schemas import BOOK_NAMES, QUOTE, QUOTES_DOCUMENT, SCHEDULE_DOCUMENT, SLATE


def _read_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool, corrupt: str | None) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    if corrupt:
        # A document that is no JSON, or whose values do not fit, stays whole in this column.
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).json(path)


def read_quote_documents(
    spark: SparkSession, path: str, *, multi_line: bool = True, corrupt: str | None = None
) -> DataFrame:
    """Landed quote documents: one JSON object or array of objects per file, or with
    ``multi_line=False`` one object per line, which Spark can split. ``corrupt`` names a
    column for broken documents (see ``set_aside``); without it they are rows of NULL, which
    have no id and drop out later."""
    return _read_json(spark, path, QUOTES_DOCUMENT, multi_line, corrupt)


def read_schedule_documents(
    spark: SparkSession, path: str, *, multi_line: bool = True, corrupt: str | None = None
) -> DataFrame:
    return _read_json(spark, path, SCHEDULE_DOCUMENT, multi_line, corrupt)


def parse_documents(df: DataFrame, column: str, layout: StructType, *, corrupt: str | None = None) -> DataFrame:
    """Documents held as JSON text in a column. The generator keeps later filters from
    being merged into the parse, which would then run once per use of a field. ``corrupt``
    names a column for the text of broken documents."""
    options = {}
    if corrupt:
        layout = StructType([*layout.fields, StructField(corrupt, StringType())])
        options = {"columnNameOfCorruptRecord": corrupt}
    return df.select(F.inline(F.array(F.from_json(column, layout, options))))


def market_documents(documents: DataFrame) -> DataFrame:
    """Documents that have an id and at least one bookmaker."""
    return documents.filter((F.coalesce(F.col("id"), F.lit("")) != "") & (F.size("bookmakers") > 0))


def flatten_quotes(documents: DataFrame, *, market: str | None = None) -> DataFrame:
    """One row per outcome, of one market if it is named. Empty lists at any level yield no
    row."""
    names = F.create_map(*[F.lit(x) for pair in BOOK_NAMES.items() for x in pair])
    books = documents.select(
        F.col("id").alias("event_id"), "commence_time", "home_team", "away_team", F.explode("bookmakers").alias("b")
    )
    markets = books.select("*", F.explode("b.markets").alias("m"))
    if market is not None:
        markets = markets.filter(F.col("m.key") == market)
    outcomes = markets.select("*", F.explode("m.outcomes").alias("o"))
    flat = {
        "event_id": F.col("event_id"),
        "commence_time": F.col("commence_time"),
        "home_team": F.col("home_team"),
        "away_team": F.col("away_team"),
        "bookmaker": F.coalesce(F.try_element_at(names, F.col("b.key")), F.col("b.key")),
        "bookmaker_key": F.col("b.key"),
        "book_last_update": F.col("b.last_update"),
        "market_key": F.col("m.key"),
        "player_name": F.col("o.description"),
        "player_name_norm": quote_name(F.col("o.description")),
        "side": F.col("o.name"),
        "line": F.col("o.point"),
        "price": F.col("o.price"),
    }
    return outcomes.select(*[flat[c].alias(c) for c in QUOTE.names])


def _schedule_side(side: str, other: str, is_home: int) -> Column:
    mine = f"g.teams.{side}"
    codes = {s: F.col(f"g.teams.{s}.team.abbreviation") for s in ("home", "away")}
    return F.struct(
        F.col(f"{mine}.probablePitcher").alias("probable"),
        codes[side].alias("team"),
        codes[other].alias("opponent"),
        codes["home"].alias("home_team"),
        codes["away"].alias("away_team"),
        F.lit(is_home).alias("is_home"),
    )


def flatten_schedule(documents: DataFrame) -> DataFrame:
    """Raw slate rows: two sides per game, sides without a probable starter drop out."""
    games = documents.select(F.explode("dates").alias("d")).select(
        F.col("d.date").cast("date").alias("game_date"), F.explode("d.games").alias("g")
    )
    sides = games.select(
        "game_date",
        F.col("g.gamePk").alias("game_pk"),
        F.inline(F.array(_schedule_side("away", "home", 0), _schedule_side("home", "away", 1))),
    )
    return sides.filter("probable is not null").select(
        "game_date",
        "game_pk",
        F.col("probable.id").alias("pitcher"),
        F.col("probable.fullName").alias("player_name"),
        "team",
        "opponent",
        "home_team",
        "away_team",
        "is_home",
        F.col("probable.pitchHand.code").alias("p_throws"),
    ).select(*SLATE.names)
