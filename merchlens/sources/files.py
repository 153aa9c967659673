"""Folders of the shared file system, through the file systems Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folders(spark: SparkSession, root: str) -> dict[str, int]:
    """Names of the folders directly below `root` with the time each was last changed; none where there is no such folder."""
    system, place = _system(spark, root)
    if not system.exists(place):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in system.listStatus(place) if s.isDirectory()}


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it."""
    system, place = _system(spark, path)
    system.delete(place, True)
