"""A stored pending set, which grows and shrinks by appending alone.

    <set>/...                         URLs as they were added
    <set>/_removed/...                URLs as they were removed
    <set>/_folded-<n>/added, removed  the same from the n-th folding on

A URL is in the set if it was added more often than removed. Folding writes the set as it is
to a new pair of tables; it counts once its first table is complete, so a folding that dies leaves the
set as it was. One writer per set at a time. Folders of earlier foldings may be deleted
once no reader of that time is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listmill.operators.frontier import new_pending, still_pending, to_remove
from listmill.schemas import PENDING
from listmill.sources.paths import folder_names, path_exists, read_or_empty
from listmill.sources.work import append_counted

_FOLDED = "_folded-"


def _foldings(spark: SparkSession, path: str) -> int:
    """Number of the last complete folding, 0 if there is none."""
    names = [n for n in folder_names(spark, path) if n.startswith(_FOLDED)]
    numbers = sorted((int(n.removeprefix(_FOLDED)) for n in names), reverse=True)
    done = (n for n in numbers if path_exists(spark, f"{path}/{_FOLDED}{n}/added/_SUCCESS"))
    return next(done, 0)


def _tables(spark: SparkSession, path: str) -> tuple[str, str]:
    """Where URLs are added and removed now."""
    n = _foldings(spark, path)
    return (f"{path}/{_FOLDED}{n}/added", f"{path}/{_FOLDED}{n}/removed") if n else (path, f"{path}/_removed")


def read_pending(spark: SparkSession, path: str) -> DataFrame:
    """The set's URLs, each once."""
    added, removed = _tables(spark, path)
    rows = read_or_empty(spark, added, PENDING)
    if not path_exists(spark, removed):
        return rows
    return still_pending(rows, read_or_empty(spark, removed, PENDING))


def add_pending(spark: SparkSession, path: str, urls: DataFrame) -> int:
    """Add the URLs (column ``url``) that are not in the set; returns how many."""
    fresh = new_pending(read_pending(spark, path), urls)
    return append_counted(fresh, _tables(spark, path)[0])


def remove_pending(spark: SparkSession, path: str, urls: DataFrame) -> int:
    """Remove the URLs (column ``url``) that are in the set; returns how many."""
    gone = to_remove(read_pending(spark, path), urls)
    return append_counted(gone, _tables(spark, path)[1])


def fold_pending(spark: SparkSession, path: str) -> None:
    """Write the set anew, without what was removed."""
    n = _foldings(spark, path) + 1
    read_pending(spark, path).write.mode("overwrite").parquet(f"{path}/{_FOLDED}{n}/added")
