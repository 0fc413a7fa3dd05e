"""Slate cleaning and the slate's own consistency checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.contracts import ContractError, check_contract, require_columns
from tallyline.functions.names import group_code, slate_name
from tallyline.schemas import SLATE, SLATE_CONTRACT
from tallyline.sources.checked import raise_if_bad, write_checked


def finalize_slate(raw: DataFrame) -> DataFrame:
    """Normalized names and group codes, fixed column order."""
    require_columns(raw, SLATE.names, "raw_slate")
    codes = {c: group_code(F.col(c)) for c in ("team", "opponent", "home_team", "away_team")}
    return (
        raw.withColumns(codes)
        .withColumns({"player_name": slate_name(F.col("player_name")), "is_home": F.col("is_home").cast("int")})
        .select(*SLATE.names)
    )


def home_away_mismatch() -> Column:
    """True for a row whose group is not the one its home flag says."""
    expected = F.when(F.col("is_home") == 1, F.col("home_team")).when(F.col("is_home") == 0, F.col("away_team"))
    return expected.isNotNull() & ~F.col("team").eqNullSafe(expected)


def checked_slate(raw: DataFrame) -> DataFrame:
    """Finalized slate that satisfies its contract and the home/away rule, written by the job
    that counts what does not."""
    checks = {"home/away team consistency": home_away_mismatch()}
    checked = write_checked(finalize_slate(raw), SLATE_CONTRACT, more=checks, strict=False)
    if not checked.counts["rows"]:
        raise ContractError("no probable starters found in the schedule")
    raise_if_bad(checked, SLATE_CONTRACT)
    return checked.good


def distinct_slate(slate: DataFrame) -> DataFrame:
    """One row per (date, game, entity). Which copy stays is fixed by the remaining
    columns, so the result does not depend on the input order."""
    keys = ["game_date", "game_pk", "pitcher"]
    rest = [c for c in slate.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*rest)
    return slate.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def prediction_base(slate: DataFrame, *, strict: bool = True) -> DataFrame:
    """Distinct, contract-checked slate."""
    return check_contract(distinct_slate(slate), SLATE_CONTRACT, strict=strict)
