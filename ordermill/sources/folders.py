"""The few file operations that no DataFrame reader or writer offers, on any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order."""
    system, place = _system(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(place) or [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; none is fine."""
    system, place = _system(spark, path)
    system.delete(place, True)


def copy(spark: SparkSession, source: str, target: str, less: int = 0) -> None:
    """Copy one file, without its last ``less`` bytes, over what is there."""
    (system, origin), (other, place) = _system(spark, source), _system(spark, target)
    size = system.getFileStatus(origin).getLen() - less
    reading, writing = system.open(origin), other.create(place, True)
    try:
        spark._jvm.org.apache.commons.io.IOUtils.copyLarge(reading, writing, 0, max(size, 0))
    finally:
        writing.close()
        reading.close()
