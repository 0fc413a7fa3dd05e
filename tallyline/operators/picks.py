"""Pick selection: best quote per side, best side, classes, tiers and capped top-k."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import ContractError, check_contract, require_columns
from tallyline.functions.odds import implied_probability, side_key
from tallyline.schemas import JOINED_CONTRACT, PICK_FIRST_COLUMNS, PICKS_CONTRACT


@dataclass(frozen=True)
class SideRule:
    """How quotes of one side are ranked: numeric columns, each "asc" or "desc"."""

    side: str
    order: tuple[tuple[str, str], ...]

    def rank(self) -> Column:
        """Ascending rank with missing values last, whatever the direction."""
        parts = []
        for i, (column, direction) in enumerate(self.order):
            value = F.col(column).cast("double")
            signed = -value if direction == "desc" else value
            parts.append(F.coalesce(signed, F.lit(float("inf"))).alias(f"k{i}"))
        return F.struct(*parts)


@dataclass(frozen=True)
class PostLimits:
    official: int = 4
    lean: int = 2


@dataclass(frozen=True)
class PickPolicy:
    """Thresholds and orders of the selection; the defaults are fixed values."""

    official_edge: float = 0.75
    lean_edge: float = 0.40
    tiers: tuple[tuple[str, float], ...] = (("high", 0.50), ("medium", 0.30), ("low", 0.15))
    default_tier: str = "thin"
    side_rules: tuple[SideRule, ...] = (
        SideRule("over", (("line", "asc"), ("price", "desc"))),
        SideRule("under", (("line", "desc"), ("price", "desc"))),
    )
    tie_side: str = "over"
    class_order: tuple[str, ...] = ("official", "lean", "pass")
    limits: PostLimits = field(default_factory=PostLimits)

    def rule(self, side: str) -> SideRule:
        for rule in self.side_rules:
            if rule.side == side:
                return rule
        raise ContractError(f"no ranking rule configured for side '{side}'")

    def pick_class(self, edge: Column) -> Column:
        """The size of the edge decides, its sign does not."""
        size = F.abs(edge)
        return F.when(size >= self.official_edge, "official").when(size >= self.lean_edge, "lean").otherwise("pass")

    def tier(self, value_score: Column) -> Column:
        label = F.lit(self.default_tier)
        for name, threshold in reversed(self.tiers):
            label = F.when(value_score >= threshold, name).otherwise(label)
        return label

    def class_rank(self) -> Column:
        rank = F.lit(99)
        for position, name in enumerate(self.class_order):
            rank = F.when(F.col("pick_type") == name, position).otherwise(rank)
        return rank

    def order(self) -> list[Column]:
        """Final order of picks; the name settles ties."""
        return [self.class_rank(), F.col("value_score").desc_nulls_last(), F.col("player_name").asc()]

    def post_limits(self, official: int | None = None, lean: int | None = None) -> PostLimits:
        return PostLimits(
            self.limits.official if official is None else official,
            self.limits.lean if lean is None else lean,
        )


DEFAULT_POLICY = PickPolicy()
WORKFLOW_LIMITS = PostLimits(official=3, lean=1)


def first_forecasts(joined: DataFrame, *, group_keys: Sequence[str] = ("player_name_proj",)) -> DataFrame:
    """Rows (group keys, _first_forecast): that of the first row of a participant, its earliest
    date, then the lowest forecast. A table carries no row order in Spark. The quotes are
    hashed by day; what is sorted after that is a row for each participant and day."""
    days = [c for c in ("game_date",) if c in joined.columns and c not in group_keys]
    lowest = joined.groupBy(*group_keys, *days).agg(F.min("predicted_strikeouts").alias("_first_forecast"))
    if not days:
        return lowest
    first = F.min(F.struct(*days, "_first_forecast")).getField("_first_forecast")
    return lowest.groupBy(*group_keys).agg(first.alias("_first_forecast"))


def best_side_quotes(
    joined: DataFrame, policy: PickPolicy = DEFAULT_POLICY, *, group_keys: Sequence[str] = ("player_name_proj",)
) -> DataFrame:
    """Best quote per participant and side: one row per pair with the whole quote in
    ``_quote``. Each map task keeps one row per pair (window group limit)."""
    require_columns(joined, ("predicted_strikeouts", "side", "line", "price", *group_keys), "joined_quotes")
    sided = joined.withColumn("side_norm", side_key(F.col("side"))).filter("line is not null")
    rank = F.lit(None)
    for rule in (policy.rule("over"), policy.rule("under")):
        rank = F.when(F.col("side_norm") == rule.side, rule.rank()).otherwise(rank)
    # Ties go by named columns, then by all others, so the winner never follows row order.
    ties = [c for c in ("bookmaker", "game_date") if c in joined.columns]
    ties += [c for c in joined.columns if c not in {*ties, *group_keys}]
    best = Window.partitionBy(*group_keys, "side_norm").orderBy(rank, *ties)
    chosen = sided.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1")
    return chosen.select(*group_keys, "side_norm", F.struct(*joined.columns).alias("_quote"))


def choose_side(
    side_quotes: DataFrame,
    forecasts: DataFrame,
    policy: PickPolicy = DEFAULT_POLICY,
    *,
    group_keys: Sequence[str] = ("player_name_proj",),
) -> DataFrame:
    """Per participant the side with the larger edge over its first forecast. Both tables hold
    a row or two for each participant and are joined by merge: neither is sent to the driver."""
    over = F.col("side_norm") == "over"
    gap = F.col("_first_forecast") - F.col("_quote.line")
    # A missing key is a group of its own, as in the windows.
    named = forecasts.withColumnsRenamed({k: f"_of_{k}" for k in group_keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in group_keys]
    sides = side_quotes.filter(F.col("side_norm").isin("over", "under")).join(named.hint("merge"), same)
    sides = sides.withColumn("_edge", F.when(over, gap).otherwise(-gap)).filter("_edge is not null")
    tie = F.col("side_norm") == ("under" if policy.tie_side == "under" else "over")
    larger = Window.partitionBy(*group_keys).orderBy(F.col("_edge").desc(), tie.desc())
    chosen = sides.withColumn("_rn", F.row_number().over(larger)).filter("_rn = 1")
    whole = chosen.select("_quote.*", "_edge", F.col("side_norm").alias("pick_side")).drop("edge")
    return whole.withColumnRenamed("_edge", "edge")


def daily_picks(
    joined: DataFrame,
    policy: PickPolicy = DEFAULT_POLICY,
    *,
    group_keys: Sequence[str] = ("player_name_proj",),
    strict: bool = True,
) -> DataFrame:
    """One pick per participant with class, value score and confidence tier. The rows come in
    no order; ``policy.order()`` is the one to save or show them in."""
    if "player_name_proj" not in joined.columns:
        require_columns(joined, ("player_name",), "joined_quotes")
        joined = joined.withColumn("player_name_proj", F.col("player_name"))
    check_contract(joined, replace(JOINED_CONTRACT, allow_empty=True), strict=strict)
    whole = joined.dropna(subset=["player_name_proj", "predicted_strikeouts", "side", "line"])
    best = best_side_quotes(whole, policy, group_keys=group_keys)
    chosen = choose_side(best, first_forecasts(whole, group_keys=group_keys), policy, group_keys=group_keys)
    name = F.col("player_name_proj")
    if "player_name" in chosen.columns:
        name = F.coalesce(name, F.col("player_name"))
    scored = (
        chosen.withColumn("implied_probability", implied_probability(F.col("price")))
        .withColumns(
            {
                "pick_type": policy.pick_class(F.col("edge")),
                "value_score": F.abs("edge") * (1 - F.col("implied_probability")),
                "player_name": name,
            }
        )
        .withColumn("confidence_tier", policy.tier(F.col("value_score")))
        .drop("player_name_proj")
        .withColumnRenamed("bookmaker", "book")
    )
    leading = [c for c in PICK_FIRST_COLUMNS if c in scored.columns]
    others = [c for c in scored.columns if c not in leading]
    picks = scored.select(*leading, *others)
    # The joined contract leaves no missing value for the picks contract to find.
    return check_contract(picks, PICKS_CONTRACT, strict=False)


def postable_picks(
    picks: DataFrame,
    policy: PickPolicy = DEFAULT_POLICY,
    *,
    official: int | None = None,
    lean: int | None = None,
) -> DataFrame:
    """The first officials and leans in the final order, up to their caps."""
    require_columns(picks, ("pick_type", "value_score", "player_name"), "picks")
    limits = policy.post_limits(official, lean)
    place = Window.partitionBy("pick_type").orderBy(*policy.order()[1:])
    largest = max(limits.official, limits.lean)
    cap = F.when(F.col("pick_type") == "official", limits.official).otherwise(limits.lean)
    return (
        picks.filter(F.col("pick_type").isin("official", "lean"))
        .withColumn("_rn", F.row_number().over(place))
        # The constant bound lets Spark drop the rest before the shuffle.
        .filter(F.col("_rn") <= largest)
        .filter(F.col("_rn") <= cap)
        .drop("_rn")
        .orderBy(*policy.order())
    )
