"""Registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline import session
from tallyline.contracts import contract_report
from tallyline.functions.names import canonical_name, entity_name, quote_name, slate_name
from tallyline.operators import (
    backtest,
    evaluate,
    ledger,
    lines,
    market,
    model,
    picks,
    rollup,
    serving,
    sketches,
    slate,
    trailing,
)
from tallyline.plans import incremental, training
from tallyline.plans import ledger as ledger_store
from tallyline.plans.ledger import ledger_report
from tallyline.plans.serving import slate_features
from tallyline.plans.slate import build_slate
from tallyline.queries import inputs, tables
from tallyline.schemas import LINES_CONTRACT, MODEL_FEATURES, QUOTES_DOCUMENT, SLATE_CONTRACT
from tallyline.session import materialize
from tallyline.sources import paths, publish, readers, versions
from tallyline.sources.checked import CORRUPT, set_aside, write_checked
from tallyline.sources.nested import flatten_quotes, flatten_schedule, market_documents, parse_documents
from tallyline.sources.readers import events_between
from tallyline.sources.snapshots import land_snapshots
from tallyline.streaming import curation, upsert

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}

SPLIT_DAY = "2000-01-01"
AS_OF_DAY = "2000-07-01"
DIGITS = 6


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show in the comparison."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# ---- events and entity-periods -----------------------------------------------------


@query
def event_flags(spark, sf):
    return inputs.flagged(spark, sf).groupBy("game_date", "description", "events").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_k").alias("k"), F.sum("is_whiff").alias("whiffs")
    )


@query
def event_range(spark, sf):
    chosen = events_between(tables.EVENTS.read(spark, sf), "1997-01-01", "1999-06-30")
    return chosen.groupBy("game_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("release_spin_rate").alias("known_spin")
    )


@query
def entity_rollup(spark, sf):
    return rounded(inputs.periods(spark, sf))


@query
def fielding_lookup(spark, sf):
    return rollup.fielding_lookup(tables.EVENTS.read(spark, sf))


@query
def group_info_join(spark, sf):
    joined = rollup.add_group_info(inputs.periods(spark, sf), tables.EVENTS.read(spark, sf))
    return joined.select("game_date", "game_pk", "pitcher", "pitches", "pitching_team", "opponent_team")


@query
def group_offense(spark, sf):
    return rounded(trailing.add_group_form(materialize(rollup.group_periods(inputs.flagged(spark, sf)), "groups")))


@query
def trailing_means(spark, sf):
    form = trailing.add_trailing(
        materialize(inputs.periods(spark, sf), "periods"), ("pitcher",), trailing.PERIOD_ORDER, trailing.ENTITY_MEANS
    )
    return rounded(form.select("game_pk", "pitcher", *[s.output for s in trailing.ENTITY_MEANS]))


@query
def trailing_dispersion(spark, sf):
    form = trailing.add_trailing(
        materialize(inputs.periods(spark, sf), "periods"),
        ("pitcher",),
        trailing.PERIOD_ORDER,
        trailing.ENTITY_DISPERSION,
    )
    return rounded(form.select("game_pk", "pitcher", "strikeouts", *[s.output for s in trailing.ENTITY_DISPERSION]))


@query
def opponent_context_join(spark, sf):
    form = trailing.add_group_form(materialize(rollup.group_periods(inputs.flagged(spark, sf)), "groups"))
    joined = rollup.add_opponent_form(inputs.periods_with_groups(spark, sf), form)
    return rounded(
        joined.select(
            "game_date", "game_pk", "pitcher", "pitching_team", "opponent_team",
            "opp_strikeouts_per_game_last10", "opp_k_rate_last10",
        )
    )


@query
def trailing_blocks(spark, sf):
    """Trailing means with tasks so small that most keys are cut into blocks."""
    periods = materialize(inputs.periods(spark, sf), "periods")
    form = trailing.add_entity_form(periods, max_rows_per_task=12)
    outputs = [s.output for s in trailing.ENTITY_MEANS + trailing.ENTITY_DISPERSION]
    return rounded(form.select("game_pk", "pitcher", *outputs))


@query
def rate_features(spark, sf):
    periods = materialize(inputs.periods(spark, sf), "periods")
    rates = trailing.add_rates(trailing.add_entity_form(periods))
    return rounded(rates.select("game_pk", "pitcher", "k_per_pitch_last10", "k_rate_last10"))


@query
def starter_filter(spark, sf):
    kept = rollup.starter_like(inputs.periods(spark, sf), min_pitches=25, min_batters=18)
    return kept.select("game_date", "game_pk", "pitcher", "pitches", "batters_faced")


@query
def entity_history(spark, sf):
    return rounded(inputs.history(spark, sf))


CORRECTED_DAY = "1997-04-01"
# Deliveries by the first day that is not in them any more.
DELIVERIES = ("1997-01-01", "1997-07-01", "1998-01-01", "1999-04-01", "2100-01-01")


def _wrong_first(events: DataFrame) -> DataFrame:
    """The events as first delivered: the corrected day without half of its rows."""
    return events.filter((F.col("game_date") != CORRECTED_DAY) | (F.col("inning") % 2 == 1))


@query
def history_incremental(spark, sf):
    """The history built in five deliveries and a late correction of one day."""
    store, events = session.new_folder(spark, "history-store"), tables.EVENTS.read(spark, sf)
    day, since = F.col("game_date"), "1900-01-01"
    for until in DELIVERIES:
        part = _wrong_first(events).filter((day >= since) & (day < until))
        incremental.update_history(spark, store, part, strict=False)
        since = until
    incremental.update_history(spark, store, events.filter(day == CORRECTED_DAY), strict=False)
    return rounded(incremental.stored_history(spark, store))


@query
def history_update_counts(spark, sf):
    """How many days two deliveries bring, and how many they write: all days, then one again."""
    store, events = session.new_folder(spark, "history-store"), tables.EVENTS.read(spark, sf)
    whole = incremental.update_history(spark, store, _wrong_first(events), strict=False)
    late = incremental.update_history(spark, store, events.filter(F.col("game_date") == CORRECTED_DAY), strict=False)
    rows = [
        (step, u.days_delivered, u.entities_touched, u.groups_touched, u.history_days_written)
        for step, u in enumerate((whole, late), start=1)
    ]
    layout = "step int, days_delivered long, entities_touched long, groups_touched long, history_days_written long"
    return spark.createDataFrame(rows, layout)


@query
def latest_row(spark, sf):
    newest = trailing.latest_rows(inputs.periods(spark, sf), ("pitcher",), trailing.PERIOD_ORDER)
    return newest.select("pitcher", "game_date", "game_pk", "strikeouts", "pitches")


@query
def latest_context_asof(spark, sf):
    return rounded(trailing.group_context(inputs.history(spark, sf), AS_OF_DAY))


@query
def context_asof_rows(spark, sf):
    """Every slate row with the context of its opponent as of the row's own day."""
    history = materialize(inputs.history(spark, sf), "history")
    slate_rows = tables.SLATE.read(spark, sf).select("game_pk", "game_date", "opponent")
    return rounded(serving.add_context_per_row(slate_rows, history))


# ---- model table -------------------------------------------------------------------


@query
def model_table(spark, sf):
    return rounded(model.model_table(inputs.history(spark, sf)))


@query
def time_split(spark, sf):
    table = model.model_table(inputs.history(spark, sf))
    parts = model.time_split(table, SPLIT_DAY, strict=False)
    summaries = [
        part.agg(
            F.lit(label).alias("part"),
            F.count(F.lit(1)).alias("n"),
            F.sum("strikeouts").alias("strikeouts"),
            F.date_format(F.min("game_date"), "yyyy-MM-dd").alias("first_day"),
            F.date_format(F.max("game_date"), "yyyy-MM-dd").alias("last_day"),
        )
        for label, part in zip(("train", "test"), parts, strict=True)
    ]
    return summaries[0].unionByName(summaries[1])


@query
def date_ranges(spark, sf):
    return evaluate.date_range(tables.EVENTS.read(spark, sf))


# ---- serving -----------------------------------------------------------------------


@query
def serving_features(spark, sf):
    history = materialize(inputs.history(spark, sf), "history")
    features = serving.serving_features(
        tables.SLATE.read(spark, sf), history, trailing.group_context(history, AS_OF_DAY), strict=False
    )
    return rounded(features.withColumn("career_starts", F.col("career_starts").cast("long")))


@query
def slate_serving(spark, sf):
    """The serving plan: context as of the first day of the slate."""
    history = materialize(inputs.history(spark, sf), "history")
    features = slate_features(tables.SLATE.read(spark, sf), history, strict=False)
    return rounded(features.select("game_pk", "days_rest", *MODEL_FEATURES))


@query
def slate_finalize(spark, sf):
    return slate.finalize_slate(tables.RAW_SLATE.read(spark, sf))


@query
def slate_distinct(spark, sf):
    return slate.prediction_base(tables.RAW_SLATE.read(spark, sf), strict=False)


@query
def home_away_check(spark, sf):
    rows = slate.finalize_slate(tables.RAW_SLATE.read(spark, sf))
    return rows.filter(slate.home_away_mismatch()).groupBy("game_date").agg(F.count(F.lit(1)).alias("bad_rows"))


@query
def contract_checks(spark, sf):
    return contract_report(tables.RAW_SLATE.read(spark, sf), SLATE_CONTRACT)


# ---- readers -----------------------------------------------------------------------


def _as_csv(df: DataFrame, name: str) -> str:
    """A table landed as CSV under a name, blanks kept as they are."""
    folder = paths.join(session.new_folder(df.sparkSession, "landed"), name)
    writer = df.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return folder


@query
def slate_read(spark, sf):
    """A landed slate read by name into its types."""
    return readers.read_slate(spark, _as_csv(tables.SLATE.read(spark, sf), "slate.csv"))


@query
def ledger_read(spark, sf):
    """A landed ledger, every field as text and blanks as blanks."""
    return readers.read_ledger(spark, _as_csv(tables.LEDGER.read(spark, sf), "ledger.csv"))


@query
def history_read(spark, sf):
    """The written history through its reader, which checks it."""
    folder = session.new_folder(spark, "history")
    inputs.history(spark, sf).write.parquet(folder)
    return rounded(readers.read_history(spark, folder))


# ---- names -------------------------------------------------------------------------


@query
def names_entity(spark, sf):
    text = F.col("text")
    return tables.table(spark, sf, "documents").select("doc_id", entity_name(text).alias("name"))


@query
def names_entity_exact(spark, sf):
    text = F.col("text")
    return tables.table(spark, sf, "documents").select("doc_id", entity_name(text, exact=True).alias("name"))


@query
def names_quote(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", quote_name(F.col("text")).alias("name"))


@query
def names_slate(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", slate_name(F.col("text")).alias("name"))


@query
def names_canonical(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", canonical_name(F.col("text")).alias("name"))


# ---- documents, snapshots, lines ---------------------------------------------------


@query
def quotes_flatten(spark, sf):
    return flatten_quotes(market_documents(inputs.quote_documents(spark, sf)))


@query
def quotes_alternates(spark, sf):
    """One market of documents that hold two, both with outcomes."""
    documents = market_documents(inputs.quote_documents(spark, sf, alternates=True))
    return flatten_quotes(documents, market="alternates")


@query
def quotes_broken(spark, sf):
    """Quotes of documents some of which are broken; those are set aside and cost no other."""
    documents = parse_documents(inputs.broken_quote_texts(spark, sf), "text", QUOTES_DOCUMENT, corrupt=CORRUPT)
    return flatten_quotes(market_documents(set_aside(documents).good))


@query
def documents_set_aside(spark, sf):
    """How many documents came and how many are broken, as the job that wrote them counted."""
    documents = parse_documents(inputs.broken_quote_texts(spark, sf), "text", QUOTES_DOCUMENT, corrupt=CORRUPT)
    made = set_aside(documents)
    kept = made.good.agg(F.count(F.lit(1)).alias("good_rows"))
    bad = made.bad.agg(F.count(F.lit(1)).alias("bad_rows")).scalar()
    return kept.select(F.lit(made.counts["rows"]).cast("long").alias("rows"), "good_rows", bad.alias("bad_rows"))


@query
def schedule_flatten(spark, sf):
    return flatten_schedule(inputs.schedule_documents(spark, sf))


@query
def slate_build(spark, sf):
    """The slate plan: flattened, finalized and checked."""
    return build_slate(inputs.schedule_documents(spark, sf))


def _lines_output(df: DataFrame) -> DataFrame:
    """Instants as microseconds, so that no session zone takes part."""
    return df.withColumns({c: F.unix_micros(c) for c in ("commence_time", "pulled_at")})


@query
def lines_normalize(spark, sf):
    return _lines_output(lines.normalize_snapshots(tables.DIRTY_LINES.read(spark, sf)))


@query
def lines_curate(spark, sf):
    return _lines_output(lines.curate_lines(inputs.snapshots(spark, sf), strict=False))


def _two_kinds(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The raw snapshots as text under two headers: rows with a source, and rows without
    that column whose other columns stand in another order."""
    raw = tables.RAW_LINES.read(spark, sf)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    fewer = [c for c in reversed(raw.columns) if c != "source"]
    return text.filter("source is not null"), text.filter("source is null").select(*fewer)


@query
def lines_landed(spark, sf):
    """Files under two headers, landed twice: the second landing replaces the first."""
    log, target = (session.new_folder(spark, label) for label in ("snapshots.csv", "landed"))
    for kind, part in zip(("with_source", "without"), _two_kinds(spark, sf), strict=True):
        part.write.option("header", True).csv(paths.join(log, kind))
    land_snapshots(spark, log, target)
    return _lines_output(lines.normalize_snapshots(land_snapshots(spark, log, target)))


@query
def lines_streamed(spark, sf):
    """Snapshots that arrive in two drops, curated by a stream that is stopped in between."""
    dropped, log, progress = (session.new_folder(spark, label) for label in ("dropped", "curated", "progress"))
    for part in _two_kinds(spark, sf):
        part.write.mode("append").parquet(dropped)
        curation.curate_stream(curation.snapshot_stream(spark, dropped), log, progress).awaitTermination()
    return _lines_output(curation.curated_from_log(spark, log))


@query
def lines_streamed_state(spark, sf):
    """Snapshots in two drops, curated by a stream with state that is stopped in between; the
    watermark lies far enough back for all of them."""
    dropped, store, progress = (session.new_folder(spark, label) for label in ("dropped", "lines", "progress"))
    for part in _two_kinds(spark, sf):
        part.write.mode("append").parquet(dropped)
        upsert.curate_stateful(curation.snapshot_stream(spark, dropped), store, progress, delay="3650 days").awaitTermination()
    return _lines_output(upsert.current_lines(spark, store))


@query
def lines_checked(spark, sf):
    """Snapshots as they come, checked by the job that writes them: rows by what is wrong."""
    rows = lines.normalize_snapshots(tables.DIRTY_LINES.read(spark, sf))
    contract = replace(LINES_CONTRACT, unique=())
    checked = write_checked(rows, contract, strict=False)
    found = checked.bad.select(F.explode("problems").alias("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))
    whole = spark.createDataFrame([(n, k) for n, k in checked.counts.items()], "problem string, counted long")
    good = checked.good.agg(F.lit("good").alias("problem"), F.count(F.lit(1)).alias("n"))
    by_check = whole.filter("counted > 0 and problem not in ('rows', 'bad_rows')").join(found, "problem", "left")
    return by_check.select("problem", "counted", "n").unionByName(
        good.select("problem", F.lit(checked.counts["rows"] - checked.counts["bad_rows"]).cast("long").alias("counted"), "n")
    )


@query
def lines_published(spark, sf):
    """Curated lines committed twice: first those of some books, then all."""
    store = session.new_folder(spark, "lines-store")
    curated = lines.curate_lines(inputs.snapshots(spark, sf), strict=False)
    publish.publish_table(curated.filter("bookmaker < 'd'"), store, publish.LINES)
    publish.publish_table(curated, store, publish.LINES)
    return _lines_output(spark.read.parquet(versions.current(spark, store).path(publish.LINES)))


# ---- market ------------------------------------------------------------------------


def _joined(spark, sf):
    quotes = flatten_quotes(market_documents(inputs.quote_documents(spark, sf)))
    return market.join_quotes(inputs.forecasts(spark, sf), quotes, strict=False)


@query
def forecast_quote_join(spark, sf):
    return rounded(
        _joined(spark, sf).select(
            "event_id", "bookmaker", "side", "line", "price", "player_name_proj", "player_name_odds",
            "player_name_norm", "team", "predicted_strikeouts", "edge",
        )
    )


@query
def forecast_quote_collation(spark, sf):
    """Forecasts and quotes whose names differ in accents and case, joined by collation."""
    accented = F.translate(F.upper("player_name"), "ELI", "ÉĽÎ")
    quotes = flatten_quotes(market_documents(inputs.quote_documents(spark, sf))).withColumn("player_name", accented)
    joined = market.join_quotes_by_collation(inputs.forecasts(spark, sf), quotes.drop("player_name_norm"))
    return rounded(
        joined.select("event_id", "bookmaker", "side", "line", "price", "player_name_proj", "player_name_odds", "edge")
    )


def _line_joined(spark, sf):
    curated = lines.curate_lines(inputs.snapshots(spark, sf), strict=False)
    return market.join_historical_lines(inputs.daily_forecasts(spark, sf), curated, strict=False)


@query
def forecast_lines_join(spark, sf):
    return rounded(
        _line_joined(spark, sf).select(
            "game_date", "player_name_norm", "player_name_proj", "player_name_line", "bookmaker", "side", "line",
            "price", "predicted_strikeouts", "actual_strikeouts", "edge",
        )
    )


@query
def best_over(spark, sf):
    best = market.best_over(_joined(spark, sf))
    return rounded(best.select("player_name_proj", "bookmaker", "line", "price", "side", "predicted_strikeouts", "edge"))


@query
def best_quote_side(spark, sf):
    best = picks.best_side_quotes(_joined(spark, sf))
    return rounded(
        best.filter(F.col("side_norm").isin("over", "under")).select(
            "player_name_proj", "side_norm", "_quote.bookmaker", "_quote.line", "_quote.price"
        )
    )


PICK_OUTPUT = (
    "player_name", "team", "opponent", "predicted_strikeouts", "book", "pick_side", "line", "price", "edge",
    "implied_probability", "value_score", "confidence_tier", "pick_type",
)


# The synthetic lines lie far apart; these thresholds give picks of every class and tier.
WIDE_POLICY = picks.PickPolicy(
    official_edge=25.0, lean_edge=15.0, tiers=(("high", 12.0), ("medium", 9.0), ("low", 7.0))
)


def _picks(spark, sf):
    return picks.daily_picks(_joined(spark, sf), WIDE_POLICY, strict=False)


@query
def daily_picks(spark, sf):
    return rounded(_picks(spark, sf).select(*PICK_OUTPUT))


@query
def postable_picks(spark, sf):
    return rounded(picks.postable_picks(_picks(spark, sf), WIDE_POLICY).select(*PICK_OUTPUT))


# ---- backtest ----------------------------------------------------------------------


@query
def grade_picks(spark, sf):
    graded = backtest.grade_picks(_picks(spark, sf))
    return rounded(
        graded.select(
            "player_name", "pick_side", "line", "actual_strikeouts", "outcome", "is_win", "is_loss", "is_push",
            "decision", "profit_units", "line_band",
        )
    )


def _dated_backtest(spark, sf):
    return backtest.run_backtest(
        _line_joined(spark, sf), group_keys=("game_date", "player_name_proj"), strict=False
    )


@query
def backtest_summary(spark, sf):
    return rounded(backtest.summarize_backtest(_dated_backtest(spark, sf)))


@query
def backtest_participant(spark, sf):
    """One pick per participant over all days, each with its first forecast."""
    graded = backtest.run_backtest(_line_joined(spark, sf), strict=False)
    return rounded(
        graded.select("player_name", "book", "pick_side", "line", "edge", "pick_type", "outcome", "profit_units")
    )


@query
def backtest_status(spark, sf):
    joined = _line_joined(spark, sf)
    return backtest.backtest_status(joined, backtest.run_backtest(joined, strict=False))


@query
def backtest_unavailable(spark, sf):
    """Why there is no backtest: forecasts of days without lines, and without outcomes."""
    joined = _line_joined(spark, sf)
    nothing = joined.filter("game_date < '1900-01-01'")
    unknown = joined.withColumn("actual_strikeouts", F.lit(None).cast("double"))
    made = [backtest.backtest_status(df, backtest.run_backtest(df, strict=False)) for df in (nothing, unknown)]
    return made[0].unionByName(made[1])


# ---- ledger ------------------------------------------------------------------------


@query
def ledger_rows(spark, sf):
    chosen = rounded(_picks(spark, sf).drop("game_date"))
    return ledger.ledger_rows(inputs.user_slate(spark, sf), chosen).select(
        "pick_key", "game_date", "player_name", "team", "opponent", "book", "odds", "pick_side", "confidence_tier",
        "pick_type", "result", "actual_strikeouts", "record_source",
    )


@query
def ledger_upsert(spark, sf):
    return ledger.upsert_ledger(tables.LEDGER.read(spark, sf), inputs.new_ledger_rows(spark, sf))


@query
def ledger_bucketed(spark, sf):
    """The upsert on the stored ledger, of which only the buckets of new keys are written."""
    root = session.new_folder(spark, "ledger-store")
    ledger_store.replace_ledger(spark, tables.LEDGER.read(spark, sf), root)
    ledger_store.upsert_rows(spark, inputs.new_ledger_rows(spark, sf), root)
    return ledger_store.read_current_ledger(spark, root)


@query
def ledger_buckets_written(spark, sf):
    """The buckets of the stored ledger with their rows, and whether the ten first of the
    new keys have them written anew, as the folders of both versions show."""
    root = session.new_folder(spark, "ledger-store")
    before = ledger_store.replace_ledger(spark, tables.LEDGER.read(spark, sf), root)
    ten = inputs.new_ledger_rows(spark, sf).orderBy("pick_key").limit(10)
    after = ledger_store.upsert_rows(spark, ten, root)
    kept = set(ledger_store.bucket_folders(before)) & set(ledger_store.bucket_folders(after))
    folders = after.under(ledger_store.LEDGER)
    written = spark.createDataFrame([(int(b), f not in kept) for b, f in folders.items()], "bucket long, written boolean")
    rows = ledger_store.read_version(spark, after).groupBy(ledger.ledger_bucket(ledger_store.BUCKETS).alias("bucket"))
    return rows.agg(F.count(F.lit(1)).alias("n")).join(written, "bucket").select("bucket", "n", "written")


@query
def ledger_graded(spark, sf):
    rows = ledger.graded_ledger(tables.LEDGER.read(spark, sf))
    return rounded(
        rows.select(
            "pick_key", "book", "odds", "price", "result", "result_normalized", "odds_numeric", "gradeable",
            "units_risked", "units_result",
        )
    )


@query
def ledger_by_book(spark, sf):
    return rounded(ledger_report(tables.LEDGER.read(spark, sf))["by_book"])


@query
def ledger_overall(spark, sf):
    return rounded(ledger.ledger_overall(tables.LEDGER.read(spark, sf)))


# ---- evaluation --------------------------------------------------------------------


@query
def prediction_results(spark, sf):
    return rounded(
        inputs.results(spark, sf).select(
            "game_pk", "pitcher", "actual_strikeouts", "predicted_strikeouts", "error", "abs_error"
        )
    )


@query
def regression_metrics(spark, sf):
    return rounded(evaluate.regression_metrics(inputs.results(spark, sf)))


@query
def interval_fit(spark, sf):
    config = evaluate.fit_intervals(inputs.results(spark, sf))
    kept = {k: config[k] for k in ("base_stddev_column", "nominal_coverage", "interval_multiplier", "calibration_rows")}
    layout = "base_stddev_column string, nominal_coverage double, interval_multiplier double, calibration_rows long"
    return rounded(spark.createDataFrame([tuple(kept.values())], layout))


@query
def sketched_quantiles(spark, sf):
    """Quantiles of the absolute error over two ranges of days from stored daily sketches:
    whether the rank of each lies as near its probability as the sketch allows."""
    results = materialize(inputs.results(spark, sf).select("game_date", "abs_error"), "results")
    stored = materialize(sketches.daily_sketches(results, "abs_error"), "sketches")
    out = []
    for label, until in (("all", None), ("before split", SPLIT_DAY)):
        chosen = results if until is None else results.filter(F.col("game_date") <= until)
        quantiles = materialize(sketches.range_quantiles(stored, (0.1, 0.5, 0.9), end=until), "quantiles")
        exact = sketches.rank_shares(chosen, "abs_error", quantiles)
        far = F.greatest(F.col("below") - F.col("probability"), F.col("probability") - F.col("up_to"))
        near = exact.select("probability", (far <= 2 * sketches.RANK_ERROR).alias("near"))
        out.append(near.join(quantiles, "probability").select(F.lit(label).alias("days"), "probability", "n", "near"))
    return out[0].unionByName(out[1])


FIXED_INTERVAL = {"interval_multiplier": 1.37, "nominal_coverage": 0.8, "method": "fixed"}


@query
def interval_apply(spark, sf):
    rows = evaluate.apply_intervals(inputs.results(spark, sf), FIXED_INTERVAL)
    return rounded(
        rows.select(
            "game_pk", "pitcher", "raw_std_dev", "std_dev", "lower_bound", "upper_bound",
            "interval_coverage_target", "interval_multiplier",
        )
    )


@query
def interval_coverage(spark, sf):
    return rounded(evaluate.interval_coverage(inputs.results(spark, sf), FIXED_INTERVAL))


@query
def error_buckets(spark, sf):
    return rounded(evaluate.error_buckets(inputs.results(spark, sf)))


# ---- model -------------------------------------------------------------------------

_fitted: dict[tuple[str, str], tuple] = {}


def forget_models() -> None:
    """Let the next query train again; a bench calls it before each timed run."""
    _fitted.clear()


def _trained(spark, sf, history=None):
    """The model with the workload's own parameters, trained once per session and table for
    the queries that ask different things of it. A query that has the history itself passes it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _fitted:
        history = inputs.history(spark, sf) if history is None else history
        table = materialize(model.model_table(history), "model-table")
        train, test = model.time_split(table, SPLIT_DAY)
        _fitted[key] = (model.train_model(train, params=model.BoostParams()), table, train, test)
    return _fitted[key]


def _sound(scored):
    """A known forecast inside its own interval."""
    predicted = F.col("predicted_strikeouts")
    inside = predicted.between(F.col("lower_bound") - 1e-9, F.col("upper_bound") + 1e-9)
    return F.coalesce(~F.isnan(predicted) & inside, F.lit(False)).alias("sound")


@query
def gbt_train_score(spark, sf):
    fitted, _, _, test = _trained(spark, sf)
    scored = model.score(fitted, test)
    return scored.select("game_date", "game_pk", "pitcher", "strikeouts", _sound(scored))


@query
def gbt_score_latest(spark, sf):
    fitted, table, _, _ = _trained(spark, sf)
    scored = model.score_latest(fitted, table)
    return scored.select("game_date", "pitcher", "strikeouts", _sound(scored))


@query
def gbt_learns(spark, sf):
    """The error on the training rows beside that of their mean."""
    fitted, _, train, _ = _trained(spark, sf)
    mean = train.agg(F.avg("strikeouts")).scalar()
    errors = model.score(fitted, train).select(
        F.pow(F.col("predicted_strikeouts") - F.col("strikeouts"), 2).alias("own"),
        F.pow(mean - F.col("strikeouts"), 2).alias("plain"),
    )
    return errors.agg(F.count(F.lit(1)).alias("n"), (F.avg("own") < F.avg("plain")).alias("below_mean"))


@query
def gbt_train(spark, sf):
    """Training alone: the rounds of the model, as many as the workload asks for."""
    fitted, _, train, _ = _trained(spark, sf)
    trees = fitted.stages[-1].getNumTrees
    return train.agg(F.count(F.lit(1)).alias("n"), F.lit(trees).cast("long").alias("rounds"))


@query
def gbt_error_by_round(spark, sf):
    """The error after each round on both sides of the split; that of the last round beside
    the root mean squared error of the scored rows."""
    fitted, _, train, test = _trained(spark, sf)
    rounds = model.error_by_round(fitted, {"train": train, "test": test})
    scored = evaluate.prediction_results(model.score(fitted, test))
    rmse = evaluate.regression_metrics(scored).select("rmse").scalar()
    last = F.abs(F.col("test") - rmse) < 1e-9
    # A row a round: few enough for one task.
    falls = F.col("train") <= F.first("train").over(Window.orderBy("round"))
    return rounds.select(
        "round",
        (F.col("train").isNotNull() & F.col("test").isNotNull()).alias("known"),
        falls.alias("below_first"),
        F.when(F.col("round") == model.BoostParams().rounds, last).alias("last_is_rmse"),
    )


@query
def set_published(spark, sf):
    """A whole training set committed as a version; its model table as readers find it."""
    # The history is built once, for the training and for the set.
    history = materialize(inputs.history(spark, sf), "history")
    fitted, table, _, _ = _trained(spark, sf, history)
    root = session.new_folder(spark, "sets")
    publish.publish_set(
        spark,
        root,
        history=history,
        table=table,
        lines=lines.curate_lines(inputs.snapshots(spark, sf), strict=False),
        model=fitted,
        metadata={"split_date": SPLIT_DAY},
    )
    found = publish.resolve_set(spark, root)
    split = publish.load_metadata(spark, found)["split_date"]
    rows = spark.read.parquet(found.path(publish.TABLE)).filter(F.col("game_date") >= split)
    scored = model.score(publish.load_model(found), rows)
    return scored.select("game_date", "game_pk", "pitcher", "strikeouts", _sound(scored))


@query
def training_metadata(spark, sf):
    """The counts and days of the training record, as rows."""
    fitted, table, train, test = _trained(spark, sf)
    scored = [evaluate.prediction_results(model.score(fitted, part).drop("std_dev", "raw_std_dev")) for part in (train, test)]
    scored = [materialize(part, "scored") for part in scored]
    record = training.training_record(
        table, *scored, None, params=model.BoostParams(), split_date=SPLIT_DAY, event_range=("1995-01-01", "2001-12-31")
    )
    window = record["training_window"]
    days = {f"{part}_{end}": window[f"{part}_date_range"][end] for part in ("train", "test") for end in ("start", "end")}
    counts = {name: str(window[name]) for name in ("model_table_rows", "train_rows", "test_rows")}
    known = {
        "rounds": str(record["model_params"]["rounds"]),
        "interval_rows": str(record["evaluation_metrics"]["uncertainty"]["rows"]),
        "bucket_rows": str(sum(b["rows"] for b in record["evaluation_metrics"]["bucketed_error"]["buckets"])),
        "backtest": record["evaluation_metrics"]["workflow_backtest"]["reason"],
    }
    return spark.createDataFrame(list({**days, **counts, **known}.items()), "name string, value string")


@query
def feature_importance(spark, sf):
    fitted, _, _, _ = _trained(spark, sf)
    gains = model.feature_importance(fitted)
    return gains.agg(
        F.round(F.sum("importance_gain"), 6).alias("total_gain"),
        F.bool_and(F.col("feature").isin(*MODEL_FEATURES)).alias("known"),
        (F.count(F.lit(1)) == F.count_distinct("feature")).alias("distinct"),
    )
