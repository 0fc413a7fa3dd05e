"""Checked writes: a table, its bad rows and the counts of its contract from one job.

The rows are written once, good and bad ones into folders of their own, and what is wrong
with them is counted by the job that writes them (an observation). Nothing is read again
to be checked.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tallyline.contracts import ContractError, require_columns
from tallyline.schemas import Contract
from tallyline.session import new_folder

CORRUPT, PROBLEMS, _BAD = "_corrupt_record", "problems", "_bad"


@dataclass(frozen=True)
class Checked:
    """``bad`` rows carry the names of the checks they fail in ``problems``; ``counts`` holds
    the number of rows, of bad rows, and of rows by failed check."""

    good: DataFrame
    bad: DataFrame
    counts: Mapping[str, int]


def _write(df: DataFrame, problems: Mapping[str, Column], folder: str) -> Checked:
    names = list(problems)
    found = F.array_compact(F.array(*[F.when(problems[n], F.lit(n)) for n in names], F.lit(None).cast("string")))
    judged = df.withColumn(PROBLEMS, found).drop("_copies")
    observation = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(PROBLEMS) > 0).alias("bad_rows")]
    counts += [F.count_if(F.array_contains(PROBLEMS, n)).alias(n) for n in names]
    marked = judged.observe(observation, *counts).withColumn(_BAD, F.size(PROBLEMS) > 0)
    marked.write.partitionBy(_BAD).parquet(folder)
    spark = df.sparkSession
    # The layout is known, also where no row was written.
    schema = StructType([*judged.schema.fields, StructField(_BAD, BooleanType())])
    whole = spark.read.schema(schema).parquet(folder)
    return Checked(
        whole.filter(~F.col(_BAD)).drop(_BAD, PROBLEMS), whole.filter(F.col(_BAD)).drop(_BAD), observation.get
    )


def write_checked(
    df: DataFrame,
    contract: Contract,
    folder: str | None = None,
    *,
    more: Mapping[str, Column] | None = None,
    strict: bool = True,
) -> Checked:
    """Write a table and check it on the way: missing values, values other than 0 and 1,
    keys that stand on several rows (all of which are bad), and ``more`` checks, columns
    that hold for bad rows. ``strict`` raises after the write if any row is bad, or none is
    there where the contract wants some; else the good rows go on and the bad ones stay aside.

    Rows of one unique key meet in one task, which spills: a contract asks that of keys whose
    copies are few. ``folder`` is one of the session's own if none is given."""
    require_columns(df, contract.required, contract.name)
    problems = {f"null {c}": F.col(c).isNull() for c in contract.non_null}
    problems |= {f"not 0 or 1: {c}": ~F.col(c).isin(0, 1) for c in contract.zero_one}
    if contract.unique:
        copies = F.count(F.lit(1)).over(Window.partitionBy(*contract.unique))
        df = df.withColumn("_copies", copies)
        problems["duplicate " + ",".join(contract.unique)] = F.col("_copies") > 1
    problems |= dict(more or {})
    checked = _write(df, problems, folder or new_folder(df.sparkSession, contract.name))
    if strict:
        raise_if_bad(checked, contract)
    return checked


def raise_if_bad(checked: Checked, contract: Contract) -> None:
    if checked.counts["rows"] == 0 and not contract.allow_empty:
        raise ContractError(f"{contract.name} is empty.")
    failed = {n: k for n, k in checked.counts.items() if k and n not in ("rows", "bad_rows")}
    if failed:
        shown = [r.asDict() for r in checked.bad.limit(3).collect()]
        raise ContractError(f"{contract.name} has bad rows: {failed}, such as {shown}")


def set_aside(df: DataFrame, folder: str | None = None, *, corrupt: str = CORRUPT) -> Checked:
    """Write records as a reader gave them, those that it could not read apart. ``good`` lacks
    the column ``corrupt``; ``counts`` holds rows and bad_rows."""
    made = _write(df, {"corrupt record": F.col(corrupt).isNotNull()}, folder or new_folder(df.sparkSession, "records"))
    return Checked(made.good.drop(corrupt), made.bad, made.counts)
