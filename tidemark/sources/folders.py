"""Folders in any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist."""
    folder, system = _folder(spark, source)
    new, _ = _folder(spark, target)
    system.mkdirs(new.getParent())
    if system.exists(new) or not system.rename(folder, new):
        raise FileExistsError(f"{source} can't become {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; nothing happens where there is none."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)
