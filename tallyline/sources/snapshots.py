"""The snapshot log: a tree of CSV files, and its landing as a partitioned table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyline.contracts import ContractError
from tallyline.functions.dates import day_text
from tallyline.schemas import RAW_LINE_COLUMNS, layout
from tallyline.session import materialize
from tallyline.sources.checked import set_aside
from tallyline.sources.paths import exists, is_file
from tallyline.sources.readers import empty_table


CORRUPT = "_corrupt_record"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every CSV file below a folder, numbered in the order of its file."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(folder)
        .select("value", F.col("_metadata.file_path").alias("relative_path"), "_metadata.file_block_start")
        .withColumn("_id", F.monotonically_increasing_id())
    )


def header_of_each_file(spark: SparkSession, folder: str) -> DataFrame:
    """(relative_path, first, header) of every CSV file below a folder, written.

    The first block of a file is read by one task from its start, so the smallest number
    seen there is that of the header line: numbers are hashed by file, and no line is sorted.
    This reads the text twice: land a large log once and read the landed table from then on."""
    starts = _lines(spark, folder).filter("file_block_start = 0")
    first = materialize(starts.groupBy("relative_path").agg(F.min("_id").alias("first")), "first-lines")
    found = starts.join(first, (starts["_id"] == first["first"]) & (starts["relative_path"] == first["relative_path"]))
    return materialize(found.select(first["relative_path"], "first", F.col("value").alias("header")), "headers")


def _names(header: str) -> list[str]:
    return [name.strip().strip('"') for name in header.split(",")]


def _parsed(header: str, columns: list[str]) -> Column:
    """A line under a header as one struct of all ``columns``, in an array. The line is parsed
    once; columns that the header lacks are NULL. A line of too many or too few fields, or
    with broken quotes, stays whole in the corrupt-record column, beside what could be read."""
    own = _names(header)
    ddl = ", ".join(f"`{name}` string" for name in [*own, CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'}
    record = F.from_csv(F.col("value"), ddl, options)

    def whole(parsed: Column) -> Column:
        missing = F.lit(None).cast("string")
        fields = [(parsed.getField(c) if c in own else missing).alias(c) for c in columns]
        return F.struct(*fields, parsed.getField(CORRUPT).alias(CORRUPT))

    return F.transform(F.array(record), whole)


def _read(spark: SparkSession, folder: str, headers: DataFrame, known: list[str]) -> DataFrame:
    """All rows below a folder in one pass: each line meets its file's header by path, in
    Spark, and is parsed by it. Only the different headers come to the driver."""
    columns = list(dict.fromkeys(name for header in known for name in _names(header)))
    lines = _lines(spark, folder).filter("trim(value) != ''")
    placed = lines.join(headers, "relative_path").filter(F.col("_id") != F.col("first"))
    rows = F.lit(None)
    for header in known:
        rows = F.when(F.col("header") == header, _parsed(header, columns)).otherwise(rows)
    return placed.select("relative_path", F.inline(rows))


def _headers(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    headers = header_of_each_file(spark, folder)
    return headers, sorted(r["header"] for r in headers.select("header").distinct().collect())


def read_snapshots(spark: SparkSession, folder: str, *, with_corrupt: bool = False) -> DataFrame:
    """All snapshots below a folder as text columns, matched by name across files with
    different headers; an absent or empty folder is an empty table. ``with_corrupt`` keeps
    the column that holds a line that does not fit its header, for ``set_aside``."""
    headers, known = _headers(spark, folder) if exists(spark, folder) else (None, [])
    if not known:
        names = RAW_LINE_COLUMNS + (CORRUPT,) * with_corrupt
        return empty_table(spark, layout(*[(c, StringType()) for c in names]))
    rows = _read(spark, folder, headers, known).drop("relative_path")
    return rows if with_corrupt else rows.drop(CORRUPT)


def land_snapshots(spark: SparkSession, source: str, target: str, *, quarantine: str | None = None) -> DataFrame:
    """Check external CSV files and land them in the snapshot table.

    Every file must have the required columns, or nothing is landed. Rows keep the
    path of their file below the source; landing a file again replaces what it landed on
    its days. Rebalancing by day splits a day that is too large for one writer. With a folder
    ``quarantine``, lines that do not fit their header are written there and not landed."""
    if not exists(spark, source):
        raise FileNotFoundError(f"snapshot source does not exist: {source}")
    if is_file(spark, source) and not source.lower().endswith(".csv"):
        raise ContractError(f"snapshot source file must be a CSV: {source}")
    headers, known = _headers(spark, source)
    if not known:
        raise FileNotFoundError(f"no CSV files found under snapshot source: {source}")
    for header in known:
        missing = [c for c in RAW_LINE_COLUMNS if c not in _names(header)]
        if missing:
            wrong = headers.filter(F.col("header") == header).agg(F.min("relative_path")).first()[0]
            raise ContractError(f"{wrong} is missing required columns: {missing}")
    rows = _read(spark, source, headers, known)
    if quarantine is None:
        rows = rows.drop(CORRUPT)
    else:
        rows = set_aside(rows, quarantine, corrupt=CORRUPT).good
    below = F.regexp_replace("relative_path", "^.*" + re.escape(source.rstrip("/")) + "/?", "")
    landed = rows.withColumn("relative_path", below).withColumn("game_day", day_text(F.col("game_date")))
    writer = landed.hint("rebalance", "game_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("game_day", "relative_path").parquet(target)
    return spark.read.parquet(target)
