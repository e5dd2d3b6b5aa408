"""Single files in any store that Spark reaches, through Hadoop's file interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def save_bytes(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a file, replacing one that is there."""
    out = _system(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename in one step; an error if ``target`` is there."""
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(_path(spark, source).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), _path(spark, target), spark._sc._gateway.new_array(fs.Options.Rename, 0))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries; none if it is not there."""
    system = _system(spark, folder)
    if not system.exists(_path(spark, folder)):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(_path(spark, folder)))


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)
