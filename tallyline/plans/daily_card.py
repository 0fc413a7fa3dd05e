"""Daily card: slate, forecasts, quotes, picks, ledger and every output."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyline.contracts import ContractError, check_contract
from tallyline.operators.evaluate import apply_metadata_intervals
from tallyline.operators.model import score
from tallyline.operators.picks import DEFAULT_POLICY, WORKFLOW_LIMITS, PickPolicy, PostLimits, daily_picks, postable_picks
from tallyline.plans.edges import edges
from tallyline.plans.ledger import persist_ledger, write_ledger_report
from tallyline.plans.serving import slate_features
from tallyline.plans.slate import build_slate, save_slate
from tallyline.schemas import JOINED, JOINED_CONTRACT, MARKET_KEY, PICK, PICKS_CONTRACT, SLATE_CONTRACT, Contract
from tallyline.sources import paths, publish, versions
from tallyline.sources.checked import raise_if_bad, write_checked
from tallyline.sources.readers import empty_table, read_history
from tallyline.sources.versions import Change, Version

FORECASTS_CONTRACT = Contract("forecasts", ("player_name", "predicted_strikeouts"), ("player_name",))
OUTPUTS = ("slate", "forecasts", "joined", "picks", "postable", "run_status")


@dataclass(frozen=True)
class Card:
    slate: DataFrame
    forecasts: DataFrame
    joined: DataFrame
    picks: DataFrame
    postable: DataFrame
    status: str = "success"
    message: str = ""


def _features(slate: DataFrame, history: DataFrame) -> DataFrame:
    return slate_features(slate, history, strict=False)


def _picks(joined: DataFrame, policy: PickPolicy) -> DataFrame:
    return daily_picks(joined, policy, strict=False)


@dataclass(frozen=True)
class Hooks:
    """Steps of the daily run that a caller may replace by functions of its own."""

    build_features: Callable[[DataFrame, DataFrame], DataFrame] = _features
    predict: Callable[..., DataFrame] = score
    adjust_metadata: Callable[[dict | None], dict | None] = lambda metadata: metadata
    build_picks: Callable[[DataFrame, PickPolicy], DataFrame] = _picks
    filter_picks: Callable[[DataFrame], DataFrame] = lambda picks: picks


class QuotesUnavailable(Exception):
    """The quote source could not be read; the card degrades to forecasts only."""


def slate_forecasts(
    slate: DataFrame, history: DataFrame, model, metadata: dict | None, *, hooks: Hooks = Hooks(), strict: bool = True
) -> DataFrame:
    """Forecasts of a slate with the intervals the training metadata configures. ``strict``
    checks the slate, which one that was written checked does not need."""
    check_contract(slate, SLATE_CONTRACT, strict=strict)
    features = hooks.build_features(slate, history)
    return apply_metadata_intervals(hooks.predict(model, features), hooks.adjust_metadata(metadata))


def market_card(
    forecasts: DataFrame,
    quote_documents: DataFrame,
    policy: PickPolicy = DEFAULT_POLICY,
    limits: PostLimits = WORKFLOW_LIMITS,
    *,
    market: str = MARKET_KEY,
    hooks: Hooks = Hooks(),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(joined, picks, postable), each written once by the job that checks its contract."""
    joined, _ = edges(forecasts, quote_documents, market=market, strict=False)
    joined = write_checked(joined, JOINED_CONTRACT).good
    picks = write_checked(hooks.build_picks(joined, policy), PICKS_CONTRACT).good
    postable = postable_picks(hooks.filter_picks(picks), policy, official=limits.official, lean=limits.lean)
    return joined, picks, write_checked(postable, PICKS_CONTRACT).good


def daily_card(
    spark: SparkSession,
    root: str,
    schedule_documents: DataFrame,
    read_quotes: Callable[[], DataFrame],
    policy: PickPolicy = DEFAULT_POLICY,
    limits: PostLimits = WORKFLOW_LIMITS,
    *,
    market: str = MARKET_KEY,
    hooks: Hooks = Hooks(),
) -> Card:
    """The whole daily run on landed documents and the published training set. ``market``
    names the market whose quotes count, ``hooks`` replace single steps.

    A quote source that is unavailable degrades the run: forecasts are saved, the
    market outputs are empty. Every other failure ends it."""
    slate = build_slate(schedule_documents)
    published = publish.resolve_set(spark, root)
    # Checked when it was written, like the slate.
    history = read_history(spark, published.path(publish.HISTORY), strict=False)
    model, metadata = publish.load_model(published), publish.load_metadata(spark, published)
    forecasts = slate_forecasts(slate, history, model, metadata, hooks=hooks, strict=False)
    checked = write_checked(forecasts, FORECASTS_CONTRACT, strict=False)
    if not checked.counts["rows"]:
        raise ContractError("no forecasts were generated")
    raise_if_bad(checked, FORECASTS_CONTRACT)
    forecasts = checked.good
    try:
        joined, picks, postable = market_card(
            forecasts, read_quotes(), policy, limits, market=market, hooks=hooks
        )
    except QuotesUnavailable as error:
        return Card(
            slate,
            forecasts,
            empty_table(spark, JOINED),
            empty_table(spark, PICK),
            empty_table(spark, PICK),
            "degraded",
            f"quotes unavailable; forecasts were saved but no edges or picks: {error}",
        )
    return Card(slate, forecasts, joined, picks, postable)


def save_card(
    spark: SparkSession, card: Card, root: str, target: str, policy: PickPolicy = DEFAULT_POLICY
) -> Version:
    """Every output of a run: ledger upsert, then tables, ledger reports and run status as
    one version of the store ``target``, which notes the version of the ledger they show.
    Picks are saved in the order of the policy.

    A run that dies before the commit leaves the outputs of the run before it; the ledger
    may hold its picks already, and saving the card again changes nothing there."""
    ledger = persist_ledger(card.slate, card.postable, root)
    folder = versions.new_data(target, "card")
    whole = paths.join(target, folder)
    save_slate(card.slate, paths.join(whole, "slate"))
    for name in ("forecasts", "joined", "picks", "postable"):
        rows = getattr(card, name)
        if name in ("picks", "postable"):
            rows = rows.orderBy(*policy.order())
        rows.write.parquet(paths.join(whole, name))
    reports = write_ledger_report(spark, ledger, whole)
    status = {"status": card.status, "message": card.message, "ledger_version": ledger.number}
    publish.write_record(spark, status, paths.join(whole, "run_status"))
    put = {name: f"{folder}/{name}" for name in (*OUTPUTS, *reports)}
    return versions.commit(spark, target, lambda base: Change(put=put, info=status))
