"""Folders in the file systems that Spark writes to: what Spark's readers and writers cannot say themselves."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, system = _path(spark, folder)
    return system.exists(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds; one that is not there is fine."""
    path, system = _path(spark, folder)
    system.delete(path, True)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; of one that is not there, none."""
    path, system = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file in one piece: written under another name and renamed, so that no reader sees half of it."""
    path, system = _path(spark, file)
    part, _ = _path(spark, f"{file}.part")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.delete(path, False)
    if not system.rename(part, path):
        raise OSError(f"{file} could not be written")


def read_text(spark: SparkSession, file: str) -> str | None:
    """A small file's text; None if it is not there."""
    path, system = _path(spark, file)
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
