"""Folder operations on any file system Spark can write to."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists."""
    system, target = _opened(spark, path)
    return system.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, none if it does not exist."""
    system, target = _opened(spark, folder)
    if not system.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    system, target = _opened(spark, path)
    system.delete(target, True)


def commit(spark: SparkSession, folder: str, name: str) -> bool:
    """Rename a finished folder to ``name``; False, and nothing changes, if somebody has taken that name."""
    system, target = _opened(spark, name)
    source = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system.mkdirs(target.getParent())
    # This rename refuses a target that exists; the older call would move the folder into it.
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(source), system.makeQualified(target), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written over a former one."""
    system, target = _opened(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    system, target = _opened(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
