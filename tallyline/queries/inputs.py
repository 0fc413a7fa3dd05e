"""Intermediate inputs several registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.evaluate import prediction_results
from tallyline.operators.lines import normalize_snapshots
from tallyline.operators.model import model_table
from tallyline.operators.rollup import add_event_flags, entity_periods, entity_periods_with_groups
from tallyline.plans.history import entity_history
from tallyline.queries import tables
from tallyline.schemas import LEDGER_COLUMNS, QUOTES_DOCUMENT, SCHEDULE_DOCUMENT
from tallyline.sources.nested import parse_documents


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return add_event_flags(tables.EVENTS.read(spark, sf))


def periods(spark: SparkSession, sf: str) -> DataFrame:
    return entity_periods(flagged(spark, sf))


def periods_with_groups(spark: SparkSession, sf: str) -> DataFrame:
    return entity_periods_with_groups(flagged(spark, sf))


def history(spark: SparkSession, sf: str) -> DataFrame:
    return entity_history(tables.EVENTS.read(spark, sf), strict=False)


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Model rows with a closed-form forecast: the trailing mean of the label."""
    label = F.col("k_per_pitch_last10") * F.col("pitches_last10")
    scored = model_table(history(spark, sf)).withColumn("predicted_strikeouts", label)
    return prediction_results(scored)


def quote_texts(spark: SparkSession, sf: str, *, alternates: bool = False) -> DataFrame:
    """Rows (event_id, text): one JSON quote document per event with two books, one market
    with two outcomes and one without any, or with one if there are ``alternates``; some
    documents have no books or no id."""
    seeds = tables.QUOTE_SEEDS.read(spark, sf)

    def outcome(side, line, price):
        return F.struct(
            F.lit(side).alias("name"), F.col("player_name").alias("description"),
            line.alias("point"), price.alias("price"),
        )

    def market(key, *outcomes):
        empty = F.array().cast("array<struct<name:string,description:string,point:double,price:double>>")
        return F.struct(F.lit(key).alias("key"), (F.array(*outcomes) if outcomes else empty).alias("outcomes"))

    def book(key, over, under):
        more = [outcome("Over", F.col("line") + 10, F.col("price"))] if alternates else []
        return F.struct(
            F.col(key).alias("key"),
            F.date_format("event_day", "yyyy-MM-dd").alias("last_update"),
            F.array(market("pitcher_strikeouts", over, under), market("alternates", *more)).alias("markets"),
        )

    line, price = F.col("line"), F.col("price")
    missing = F.lit(None).cast("double")
    books = F.array(
        book("book_a", outcome("Over", line, price), outcome(" UNDER", line, -price)),
        book("book_b", outcome("over", line + 0.5, price - 5), outcome("Under", line - 0.5, missing)),
    )
    document = F.struct(
        F.when(F.col("event_id") % 17 == 0, "").otherwise(F.concat(F.lit("evt_"), F.col("event_id"))).alias("id"),
        F.concat(F.date_format("event_day", "yyyy-MM-dd"), F.lit("T18:00:00Z")).alias("commence_time"),
        F.lit("HOM").alias("home_team"),
        F.lit("AWY").alias("away_team"),
        F.when(F.col("event_id") % 11 == 0, F.slice(books, 1, 0)).otherwise(books).alias("bookmakers"),
    )
    return seeds.select("event_id", F.to_json(document).alias("text"))


def quote_documents(spark: SparkSession, sf: str, **options) -> DataFrame:
    return parse_documents(quote_texts(spark, sf, **options), "text", QUOTES_DOCUMENT)


def broken_quote_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The quote documents as they may arrive: some cut off, some with a word for a list."""
    texts = quote_texts(spark, sf)
    cut = F.expr("substring(text, 1, length(text) - 9)")
    wrong = F.lit('{"id": "x", "bookmakers": "none"}')
    text = F.when(F.col("event_id") % 19 == 0, cut).when(F.col("event_id") % 23 == 0, wrong).otherwise(F.col("text"))
    return texts.select(text.alias("text"))


def schedule_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON schedule document per order: a day with two games, some sides without a
    probable starter, some starters without a hand."""
    orders = tables.table(spark, sf, "orders")
    key = F.col("o_orderkey")

    def side(code, shift):
        hand = F.when((key + shift) % 5 != 0, F.struct(F.lit("R").alias("code")))
        probable = F.struct(
            (key * 4 + shift).alias("id"),
            F.concat(F.lit("Starter "), key * 4 + shift).alias("fullName"),
            hand.alias("pitchHand"),
        )
        return F.struct(
            F.struct(F.concat(F.lit(code), F.col("o_custkey") % 30).alias("abbreviation")).alias("team"),
            F.when((key + shift) % 7 != 0, probable).alias("probablePitcher"),
        )

    def game(number):
        return F.struct(
            (key * 2 + number).alias("gamePk"),
            F.struct(side("a", 2 * number).alias("away"), side("h", 2 * number + 1).alias("home")).alias("teams"),
        )

    day = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.array(game(0), game(1)).alias("games")
    )
    document = F.struct(F.array(day).alias("dates"))
    return parse_documents(orders.select(F.to_json(document).alias("text")), "text", SCHEDULE_DOCUMENT)


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """One forecast per user: the mean of its lines; the realized value is a whole number."""
    seeds = tables.QUOTE_SEEDS.read(spark, sf)
    return seeds.groupBy("user_id", "player_name").agg(
        F.avg("line").alias("predicted_strikeouts"),
        F.floor(F.avg("line") + F.col("user_id") % 3 - 1).cast("double").alias("actual_strikeouts"),
        F.min("event_day").alias("game_date"),
    ).select(
        "player_name",
        F.concat(F.lit("T"), F.col("user_id") % 30).alias("team"),
        F.concat(F.lit("T"), (F.col("user_id") + 7) % 30).alias("opponent"),
        "predicted_strikeouts",
        "actual_strikeouts",
        "game_date",
    )


def user_slate(spark: SparkSession, sf: str) -> DataFrame:
    """The slate rows the forecasts belong to, once more on a later day for some."""
    rows = forecasts(spark, sf).select("player_name", "team", "opponent", "game_date")
    later = rows.withColumn("game_date", F.date_add("game_date", 3))
    return rows.unionByName(later).withColumn("game_pk", F.lit(1).cast("long"))


def daily_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts per user and day: the mean line of the day against its largest line."""
    seeds = tables.QUOTE_SEEDS.read(spark, sf)
    return seeds.groupBy("player_name", F.col("event_day").alias("game_date")).agg(
        F.avg("line").alias("predicted_strikeouts"),
        F.floor(F.max("line")).cast("double").alias("actual_strikeouts"),
    )


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_snapshots(tables.RAW_LINES.read(spark, sf))


def new_ledger_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.NEW_LEDGER_KEYS.read(spark, sf).groupBy("pick_key").agg(F.sum("quantity").alias("quantity"))
    made = {
        "pick_key": F.col("pick_key"),
        "predicted_strikeouts": F.col("quantity").cast("string"),
        "result": F.when(F.col("quantity") % 5 == 0, "L").otherwise(""),
        "pick_type": F.lit("official"),
        "record_source": F.lit("run_daily_card"),
    }
    return rows.select(*[made.get(c, F.lit("")).alias(c) for c in LEDGER_COLUMNS])
