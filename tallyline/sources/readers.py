"""Readers with explicit layouts. No reader infers types from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyline.contracts import ContractError, check_contract, require_columns
from tallyline.functions.numeric import nan_columns_to_null
from tallyline.schemas import EVENT, HISTORY_CONTRACT, LEDGER, LEDGER_COLUMNS, SLATE
from tallyline.sources.paths import exists


def empty_table(spark: SparkSession, layout: StructType) -> DataFrame:
    return spark.createDataFrame([], layout)


def read_csv_text(spark: SparkSession, paths) -> DataFrame:
    """CSV files of one header with every field as text; a blank field is NULL. A quote inside
    a quoted field is doubled."""
    return spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(paths)


def read_csv_records(spark: SparkSession, path: str, columns: Sequence[str], *, corrupt: str) -> DataFrame:
    """CSV of known columns, in the order of its header, with lines that do not fit in a
    column of their own (see ``set_aside``)."""
    own = read_csv_text(spark, path).columns
    require_columns(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in own)), columns, path)
    schema = StructType([StructField(c, StringType()) for c in [*own, corrupt]])
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", corrupt)
    # A line is judged whole, also where only some of its columns are asked for.
    reader = reader.option("columnPruning", False).option("escape", '"')
    return reader.csv(path).select(*columns, corrupt)


def read_slate(spark: SparkSession, path: str) -> DataFrame:
    """Slate CSV by column name, typed; text that does not fit its type is an error."""
    raw = read_csv_text(spark, path)
    require_columns(raw, SLATE.names, "slate")
    return raw.select(*[F.trim(F.col(f.name)).cast(f.dataType).alias(f.name) for f in SLATE.fields])


def read_history(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """Published entity-period history."""
    history = nan_columns_to_null(spark.read.parquet(path))
    history = history.withColumn("game_date", F.col("game_date").cast("date"))
    return check_contract(history, HISTORY_CONTRACT, strict=strict)


def ledger_layout(raw: DataFrame) -> DataFrame:
    """The ledger's columns as text, a missing value as a blank."""
    missing = [c for c in LEDGER_COLUMNS if c not in raw.columns]
    if missing:
        raise ContractError(f"ledger is missing required columns: {missing}")
    return raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LEDGER_COLUMNS])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger with blanks kept as blanks; an absent ledger is an empty one."""
    if not exists(spark, path):
        return empty_table(spark, LEDGER)
    return ledger_layout(read_csv_text(spark, path) if path.endswith(".csv") else spark.read.parquet(path))


def events_between(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events of a closed date range in the event layout."""
    require_columns(events, EVENT.names, "events")
    wanted = events.filter(F.col("game_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return nan_columns_to_null(wanted.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT.fields]))


def read_events(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Events of a closed date range. On a table partitioned by ``game_date`` the range
    prunes partitions; otherwise it is pushed to the Parquet scan."""
    return events_between(spark.read.parquet(path), start, end)
