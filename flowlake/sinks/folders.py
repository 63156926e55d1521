"""Listing and removing folders in whatever storage Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> set[str]:
    """Names of what lies in a folder, none where there is no folder."""
    system, at = _system(spark, path)
    if not system.exists(at):
        return set()
    return {status.getPath().getName() for status in system.listStatus(at)}


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files in a folder and below, but hidden ones."""
    system, at = _system(spark, path)
    found, listed = [], system.listFiles(at, True)
    while listed.hasNext():
        status = listed.next()
        place = status.getPath().toString()
        below = place.removeprefix(system.getFileStatus(at).getPath().toString())
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            found.append((place.replace("file:/", "file:///", 1) if place.startswith("file:/") and not place.startswith("file://") else place, status.getLen()))
    return sorted(found)


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, at = _system(spark, path)
    if not system.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} was not renamed to {to}")


def remove(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.delete(at, True)
