"""Sitemaps as files: their URLs are read one by one, never a document as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The elements of a list of URLs and of a list of further sitemaps.
URL, SITEMAP = "url", "sitemap"


def read_sitemap_files(spark: SparkSession, path: str, element: str = URL) -> DataFrame:
    """(url, file) of every ``element`` with a ``loc`` in the XML files at ``path``.

    A file holds one document and may be compressed; each is one task's, which reads it as a
    stream. One that is not well-formed ends the query with an error.
    """
    rows = (
        spark.read.schema("loc string")
        .options(rowTag=element, mode="FAILFAST", ignoreSurroundingSpaces="true")
        .xml(path)
    )
    return rows.select(F.col("loc").alias("url"), F.col("_metadata.file_path").alias("file")).where(
        F.col("url").isNotNull()
    )
