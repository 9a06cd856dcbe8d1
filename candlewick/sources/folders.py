"""Folders of any file system that Spark can reach: names, sizes, renames. No file content passes through."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """Hadoop's path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    place, system = _at(spark, path)
    return system.getContentSummary(place).getLength()


def modified(spark: SparkSession, uri: str) -> int:
    """When a file was changed, in milliseconds; its name as Spark writes it, with escapes."""
    place, system = _at(spark, spark._jvm.java.net.URI(uri))
    return system.getFileStatus(place).getModificationTime()


def values_of(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders ``column=...`` right below ``path``; none if it does not exist."""
    place, system = _at(spark, path)
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()]
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Moves a folder to a name that must be free; one step on file systems with a name space."""
    place, system = _at(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(to.getParent())
    if system.exists(to) or not system.rename(place, to):
        raise FileExistsError(f"{path} cannot become {target}")


def delete(spark: SparkSession, path: str) -> None:
    place, system = _at(spark, path)
    system.delete(place, True)
