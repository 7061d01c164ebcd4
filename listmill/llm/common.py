"""What several of the operators need: words, stored work tables, bounded Arrow chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.session import work_dir

# A word is a run of anything but the six ASCII white-space characters. It is also
# what `bytes.split()` without arguments cuts UTF-8 text into.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the folder all executors share, read back.

    Cuts the lineage, so that a lost executor costs a read, and lets Spark know the
    table's size when it plans the joins with it.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in column ``text``, one row at least.

    Keeps what a Python worker holds bounded however long the texts are.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def rows_of_table(folder: str) -> Iterator[dict]:
    """Inside a task: the rows of a stored table of few, large rows, one in memory at a time."""
    where, path = fs.FileSystem.from_uri(folder)
    found = where.get_file_info(fs.FileSelector(path))
    for name in sorted(i.path for i in found if i.base_name.endswith(".parquet")):
        with where.open_input_file(name) as file:
            for row in pq.ParquetFile(file).iter_batches(batch_size=1):
                yield row.to_pylist()[0]
