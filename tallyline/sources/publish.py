"""Published sets: the datasets of a training build, committed as one version.

A set is written into a folder of its own, checked there, and then named by a manifest
(:mod:`tallyline.sources.versions`). Readers take the newest complete set.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallyline.contracts import ContractError
from tallyline.schemas import CURATED_LINE
from tallyline.sources import paths, versions
from tallyline.sources.versions import Change, Version

HISTORY, TABLE, LINES, MODEL, METADATA = "entity_periods", "model_table", "curated_lines", "model", "metadata"
DATASETS = (HISTORY, TABLE, LINES, MODEL, METADATA)


def write_record(spark: SparkSession, record: Mapping, path: str) -> None:
    """A one-row JSON document."""
    text = json.dumps(record, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def write_row(row: DataFrame, path: str) -> None:
    """A one-row table as JSON."""
    row.coalesce(1).write.mode("overwrite").json(path)


def write_set(
    spark: SparkSession,
    folder: str,
    *,
    history: DataFrame,
    table: DataFrame,
    lines: DataFrame,
    model: PipelineModel,
    metadata: Mapping,
) -> str:
    """Write the five datasets of a set."""
    for name, df in ((HISTORY, history), (TABLE, table), (LINES, lines)):
        df.write.mode("overwrite").parquet(paths.join(folder, name))
    model.write().overwrite().save(paths.join(folder, MODEL))
    write_record(spark, metadata, paths.join(folder, METADATA))
    return folder


def check_set(spark: SparkSession, folder: str) -> str:
    """A set is complete, its history and model table hold rows, and its lines have
    the line layout."""
    missing = [n for n in DATASETS if not paths.exists(spark, paths.join(folder, n))]
    if missing:
        raise FileNotFoundError(f"missing saved dataset(s): {missing}")
    for name in (HISTORY, TABLE):
        if spark.read.parquet(paths.join(folder, name)).isEmpty():
            raise ContractError(f"saved {name} is empty")
    if spark.read.parquet(paths.join(folder, LINES)).columns != CURATED_LINE.names:
        raise ContractError("saved curated_lines do not have the expected columns")
    return folder


def publish_set(spark: SparkSession, root: str, **datasets) -> Version:
    """Write the datasets of :func:`write_set` into a new folder, check and commit them. It
    takes the place of the set before it, whatever that was made from."""
    folder = versions.new_data(root, "set")

    def build(base: Version) -> Change:
        return Change(put={name: f"{folder}/{name}" for name in DATASETS})

    whole = paths.join(root, folder)
    write_set(spark, whole, **datasets)
    check_set(spark, whole)
    return versions.commit(spark, root, build)


def resolve_set(spark: SparkSession, root: str) -> Version:
    """The newest version that holds a whole set. One choice for all datasets, so a model is
    never paired with the metadata of another one."""
    for number in reversed(versions.numbers(spark, root)):
        version = versions.at(spark, root, number)
        if all(name in version and paths.exists(spark, version.path(name)) for name in DATASETS):
            return version
    raise FileNotFoundError(f"no complete dataset set under {root}")


def load_model(version: Version) -> PipelineModel:
    return PipelineModel.load(version.path(MODEL))


def load_metadata(spark: SparkSession, version: Version) -> dict:
    return read_record(spark, version.path(METADATA))


def publish_table(df: DataFrame, root: str, name: str) -> Version:
    """Replace one dataset that is published by itself. ``root`` is the dataset's own."""
    spark = df.sparkSession
    folder = versions.new_data(root, name)
    df.write.parquet(paths.join(root, folder))
    return versions.commit(spark, root, lambda base: Change(put={name: folder}))
