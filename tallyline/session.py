"""Session set-up and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyline.sources import paths

LOCAL_MEMORY = "8g"

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()
_copies: ContextVar[list[str] | None] = ContextVar("copies", default=None)


def build_session(app_name: str = "tallyline", *, master: str | None = None, shuffle_partitions: int | None = None):
    """A session with the settings the engine expects. On a cluster leave ``master``
    and ``shuffle_partitions`` unset: the submit command and AQE decide."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot join key even where the join's partitioning would have been reused.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        if master.startswith("local"):
            # Driver and executors share one JVM, whose default heap is 1 GB.
            builder = builder.config("spark.driver.memory", LOCAL_MEMORY)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it. Only a local
    session, where driver and executors are one process, may fall back to a
    temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tallyline-")
    return _local_folders[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of a name not used before, in the shared one; :func:`scratch` deletes it."""
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    copies = _copies.get()
    if copies is not None:
        copies.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several jobs read and continue from the written copy.

    Unlike a cached table it survives lost executors, and unlike an RDD checkpoint
    later reads still prune columns and push filters."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the copies that :func:`materialize` makes inside the block when it ends, also
    by an error. For jobs that save their results inside: tables that read the copies
    are of no use after it."""
    token = _copies.set([])
    try:
        yield
    finally:
        made = _copies.get()
        _copies.reset(token)
        for path in made:
            paths.delete(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point RDD checkpoints (iterative model training) at the shared folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, once per application, however the driver
    came by it. Only the driver reads the archive; Spark's file server hands it out."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tallyline-code-")) / "tallyline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
