"""The keyed pick ledger: new rows, upsert and profit reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.contracts import require_columns
from tallyline.functions.dates import day_text
from tallyline.functions.names import collapsed_lower
from tallyline.functions.numeric import safe_ratio
from tallyline.functions.odds import format_odds, ledger_units, parse_odds, settled_result
from tallyline.schemas import LEDGER_BY_BOOK, LEDGER_COLUMNS, LEDGER_REPORT

RECORD_SOURCE = "run_daily_card"
KEPT_WHEN_BLANK = ("result", "actual_strikeouts", "record_source")


def pick_key(game_date: Column, name: Column) -> Column:
    return F.concat_ws("|", F.coalesce(game_date, F.lit("")), collapsed_lower(name))


def ledger_rows(slate: DataFrame, picks: DataFrame) -> DataFrame:
    """Ledger rows of the official picks. The day comes from the pick itself, else from
    the slate row of the same participant (and groups), else from a slate of one day. The
    slate has a row for each participant and more, so no estimate may broadcast it."""
    official = picks.filter(F.col("pick_type") == "official")
    keys = ["player_name"]
    if {"team", "opponent"} <= set(official.columns):
        keys += ["team", "opponent"]
    lookup = (
        slate.groupBy(*keys)
        .agg(F.max_by(day_text(F.col("game_date")), F.struct("game_date", "game_pk")).alias("_slate_day"))
    )
    days = slate.agg(
        F.min(day_text(F.col("game_date"))).alias("first"), F.max(day_text(F.col("game_date"))).alias("last")
    )
    only_day = days.select(F.when(F.col("first") == F.col("last"), F.col("first"))).scalar()
    own_day = F.col("game_date").cast("string") if "game_date" in official.columns else F.lit(None).cast("string")
    rows = official.join(lookup.hint("merge"), keys, "left").withColumn(
        "game_date", F.coalesce(own_day, F.col("_slate_day"), only_day, F.lit(""))
    )
    made = {
        "pick_key": pick_key(F.col("game_date"), F.col("player_name")),
        "odds": format_odds(F.col("price")),
        "result": F.lit(""),
        "actual_strikeouts": F.lit(""),
        "record_source": F.lit(RECORD_SOURCE),
    }
    for c in LEDGER_COLUMNS:
        if c not in made:
            made[c] = F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    return rows.select(*[made[c].alias(c) for c in LEDGER_COLUMNS])


def one_per_key(rows: DataFrame) -> DataFrame:
    """One row per pick key: a settled one before an open one, then the greatest by its
    columns in their order."""
    settled = (F.coalesce(F.col("result"), F.lit("")) != "").alias("_settled")
    best = F.max(F.struct(settled, *[c for c in LEDGER_COLUMNS if c != "pick_key"])).alias("_best")
    return rows.groupBy("pick_key").agg(best).select("pick_key", "_best.*").select(*LEDGER_COLUMNS)


def ledger_bucket(buckets: int) -> Column:
    """The bucket of a row: its key's hash, in one form for every engine."""
    return F.conv(F.substring(F.md5(F.col("pick_key").cast("binary")), 1, 8), 16, 10).cast("long") % buckets


def upsert_ledger(ledger: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The ledger with new rows in place of old rows of the same key. A new row that
    leaves a settled field blank keeps the old one; other rows stay untouched. Of several
    rows of a key, on either side, one counts (:func:`one_per_key`)."""
    require_columns(ledger, LEDGER_COLUMNS, "ledger")
    require_columns(new_rows, LEDGER_COLUMNS, "ledger_rows")
    ledger, new_rows = one_per_key(ledger), one_per_key(new_rows)
    old = ledger.select("pick_key", *[F.col(c).alias(f"_old_{c}") for c in KEPT_WHEN_BLANK])
    kept = {
        c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(f"_old_{c}"), F.lit("")), F.lit(""))
        for c in KEPT_WHEN_BLANK
    }
    merged = new_rows.join(old, "pick_key", "left").withColumns(kept).select(*LEDGER_COLUMNS)
    untouched = ledger.select(*LEDGER_COLUMNS).join(new_rows.select("pick_key"), "pick_key", "left_anti")
    return untouched.unionByName(merged)


def graded_ledger(ledger: DataFrame) -> DataFrame:
    """Official ledger rows with their normalized result, odds and units, and the flag
    ``gradeable``: settled, and with valid odds unless it is a push."""
    require_columns(ledger, LEDGER_COLUMNS, "ledger")
    result = F.col("result_normalized")
    official = (
        ledger.filter(F.col("pick_type") == "official")
        .withColumn("result_normalized", settled_result(F.col("result")))
        .withColumn("odds_numeric", F.coalesce(parse_odds(F.col("odds")), parse_odds(F.col("price"))))
        .withColumn(
            "gradeable",
            result.isin("W", "L", "Push") & (F.col("odds_numeric").isNotNull() | (result == "Push")),
        )
    )
    risked = F.when(F.col("gradeable") & (result != "Push"), 1.0).otherwise(0.0)
    units = F.when(F.col("gradeable"), ledger_units(F.col("odds_numeric"), result))
    return official.withColumns({"units_risked": risked, "units_result": units})


def split_ledger(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(graded, skipped) official rows in the report layout."""
    rows = graded_ledger(ledger)
    return (
        rows.filter("gradeable").select(*LEDGER_REPORT.names),
        rows.filter(~F.col("gradeable")).select(*LEDGER_REPORT.names),
    )


def _totals() -> list[Column]:
    result = F.col("result_normalized")
    return [
        F.count(F.lit(1)).alias("picks"),
        F.count_if(result == "W").alias("wins"),
        F.count_if(result == "L").alias("losses"),
        F.count_if(result == "Push").alias("pushes"),
        F.coalesce(F.sum("units_risked"), F.lit(0.0)).cast("long").alias("decisions"),
        F.coalesce(F.sum("units_risked"), F.lit(0.0)).alias("units_risked"),
        F.coalesce(F.sum("units_result"), F.lit(0.0)).alias("units_profit"),
    ]


def _rates(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {
            "win_rate": safe_ratio(F.col("wins"), F.col("decisions")),
            "roi": safe_ratio(F.col("units_profit"), F.col("units_risked")),
        }
    )


def ledger_by_book(graded: DataFrame) -> DataFrame:
    """Profit per book, best first; rows without a book stay a group."""
    return (
        _rates(graded.groupBy("book").agg(*_totals()))
        .select(*LEDGER_BY_BOOK.names)
        .orderBy(F.col("units_profit").desc(), F.col("book").asc_nulls_last())
    )


def ledger_overall(ledger: DataFrame) -> DataFrame:
    """One-row summary; zeros and missing rates for an empty ledger."""
    rows = graded_ledger(ledger)
    graded = rows.withColumns(
        {
            c: F.when(F.col("gradeable"), F.col(c))
            for c in ("result_normalized", "units_risked", "units_result", "book")
        }
    )
    overall = graded.agg(
        F.count_distinct("book").alias("books"),
        F.count_if("gradeable").alias("_graded"),
        F.count_if(~F.col("gradeable")).alias("skipped_rows"),
        *_totals(),
    ).withColumn("picks", F.col("_graded")).drop("_graded")
    names = [c for c in LEDGER_BY_BOOK.names if c != "book"]
    return _rates(overall).select("books", *names, "skipped_rows")
