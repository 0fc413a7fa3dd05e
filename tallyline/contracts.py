"""Contract checks.

Column presence is checked on the driver without a job. All value checks of one
contract share one aggregate pass; duplicate keys take one more grouped pass, whose
counts are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import Contract

DUPLICATES_SHOWN = 20


class ContractError(ValueError):
    """A table does not satisfy its contract."""


def require_columns(df: DataFrame, columns: Iterable[str], name: str) -> None:
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise ContractError(f"{name} is missing required columns: {missing}")


def _value_checks(contract: Contract):
    checks = [F.count(F.lit(1)).alias("rows")]
    checks += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in contract.non_null]
    checks += [F.count_if(~F.col(c).isin(0, 1)).alias(f"domain_{c}") for c in contract.zero_one]
    return checks


def _duplicates(df: DataFrame, contract: Contract) -> DataFrame:
    return df.groupBy(*contract.unique).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def check_contract(df: DataFrame, contract: Contract, *, strict: bool = True) -> DataFrame:
    """Raise :class:`ContractError` on a violation, else return the table unchanged.
    With ``strict=False`` only the columns are checked and no job runs."""
    require_columns(df, contract.required, contract.name)
    if not strict:
        return df
    found = df.agg(*_value_checks(contract)).first().asDict()
    if found["rows"] == 0:
        if contract.allow_empty:
            return df
        raise ContractError(f"{contract.name} is empty.")
    nulls = {c: found[f"null_{c}"] for c in contract.non_null if found[f"null_{c}"]}
    if nulls:
        raise ContractError(f"{contract.name} has null values in required columns: {nulls}")
    if contract.unique:
        copies = _duplicates(df, contract).limit(DUPLICATES_SHOWN).collect()
        if copies:
            keys = [row.asDict() for row in copies]
            raise ContractError(f"{contract.name} has duplicate rows for key(s) {list(contract.unique)}: {keys}")
    for c in contract.zero_one:
        if found[f"domain_{c}"]:
            raise ContractError(f"{contract.name}.{c} contains values other than 0 and 1")
    return df


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """The same checks as a table: one row per check with its number of bad rows."""
    require_columns(df, contract.required, contract.name)
    checks = [("non_empty", "*", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))]
    checks += [("non_null", c, F.count_if(F.col(c).isNull())) for c in contract.non_null]
    checks += [("zero_one", c, F.count_if(~F.col(c).isin(0, 1))) for c in contract.zero_one]
    rows = [
        F.struct(
            F.lit(kind).alias("check_name"),
            F.lit(column).alias("column_name"),
            bad.cast("long").alias("bad_rows"),
        )
        for kind, column, bad in checks
    ]
    report = df.agg(F.array(*rows).alias("checks")).select(F.inline("checks"))
    if not contract.unique:
        return report
    unique = _duplicates(df, contract).agg(
        F.lit("unique").alias("check_name"),
        F.lit(",".join(contract.unique)).alias("column_name"),
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("bad_rows"),
    )
    return report.unionByName(unique)
