"""Folders on whichever file system they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, as far as it exists."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]


def file_paths(spark: SparkSession, path: str) -> set[str]:
    """Paths of the data files in ``path``, as far as it exists."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return set()
    found = (s.getPath() for s in files.listStatus(folder) if s.isFile())
    return {p.toString() for p in found if p.getName()[0] not in "._"}


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or no rows where nothing has been written."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
