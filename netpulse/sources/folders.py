"""Folders and small files of any file system Spark can reach: listing, existence, tiny metadata files."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; empty if there is no such folder."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(place))


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """Write a small file so that readers see all of it or nothing; it has a hidden name until it is complete."""
    fs, place = _at(spark, path)
    if not replace and fs.exists(place):
        raise FileExistsError(path)
    _, draft = _at(spark, f"{place.getParent()}/.{place.getName()}.tmp")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if replace:
        fs.delete(place, False)
    if not fs.rename(draft, place):
        raise FileExistsError(path)
