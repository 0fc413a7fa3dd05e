"""File system calls through the cluster's own Hadoop file systems."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)


def _file_system(spark: SparkSession, location: str):
    return _path(spark, location).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    return bool(_file_system(spark, location).exists(_path(spark, location)))


def is_file(spark: SparkSession, location: str) -> bool:
    return exists(spark, location) and not _file_system(spark, location).getFileStatus(_path(spark, location)).isDirectory()


def delete(spark: SparkSession, location: str) -> None:
    if exists(spark, location):
        _file_system(spark, location).delete(_path(spark, location), True)


def make_parent(spark: SparkSession, location: str) -> None:
    _file_system(spark, location).mkdirs(_path(spark, location).getParent())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is absent."""
    return list(modified(spark, folder))


def modified(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names of the files and folders in a folder with their times of change, in seconds."""
    if not exists(spark, folder):
        return {}
    found = _file_system(spark, folder).listStatus(_path(spark, folder))
    return {f.getPath().getName(): f.getModificationTime() / 1000 for f in found}


def read_text(spark: SparkSession, location: str) -> str:
    stream = _file_system(spark, location).open(_path(spark, location))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, location: str, text: str) -> None:
    make_parent(spark, location)
    stream = _file_system(spark, location).create(_path(spark, location), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Move a complete file to a name that nobody has taken; False if somebody has. Of two
    that try at once one succeeds: a hard link fails on a taken name, and so does the
    rename of a distributed file system that is not asked to overwrite."""
    if _file_system(spark, target).getScheme() == "file":
        local_source, local_target = (_path(spark, p).toUri().getPath() for p in (source, target))
        try:
            os.link(local_source, local_target)
        except FileExistsError:
            return False
        delete(spark, source)
        return True
    return rename_if_absent(spark, source, target)


def rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, target).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(_path(spark, source), _path(spark, target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder; the target must not exist."""
    make_parent(spark, target)
    if not _file_system(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])
