"""Equi-joins against a table of unique keys that hold up under hot and null keys.

Both sides join on ``(key, spread)``, where ``spread`` is a hash of the key, or of
the whole row where the key is null. This does two things:

* null keys, which match nothing, go to all tasks instead of one;
* the aggregation that made the keys unique does not already partition the keys
  side as the join wants it, so Spark shuffles it again (keys only). AQE splits a
  hot partition only where the join reads both sides straight from a shuffle;
  without the second shuffle it leaves a hot key in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

_SPREAD = "_spread"

# What a row of a broadcast table takes at most besides its key.
ROW_OVERHEAD = 128
BROADCAST_LIMIT = 64 << 20
BROADCAST_SETTING = "listmill.broadcastBytes"


def _with_spread(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    row = F.xxhash64(*[F.col(f"`{c}`") for c in by])
    unmatchable = reduce(or_, [F.col(k).isNull() for k in keys])
    return df.withColumn(_SPREAD, F.when(unmatchable, row).otherwise(F.xxhash64(*keys)))


def join_unique(
    left: DataFrame,
    right: DataFrame,
    key: str | list[str],
    how: str,
    condition: Column | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join with a right side that has each key once; ``how`` is inner, left, left_semi or left_anti.

    Left rows with null keys are spread by a hash of the columns ``spread_by``, all
    unless given; name few where the others are not needed, so that they are not read.

    ``condition`` may compare further columns, as ``a.x`` (left) and ``b.y`` (right).
    The result has the left columns, for an inner or left join then the right's.
    """
    keys = [key] if isinstance(key, str) else key
    a = _with_spread(left, keys, left.columns if spread_by is None else spread_by).alias("a")
    b = _with_spread(right, keys, keys).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*keys, _SPREAD)]
    if condition is not None:
        on.append(condition)
    columns = [F.col(f"a.{c}") for c in left.columns]
    if how in ("inner", "left"):
        columns += [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return a.join(b, reduce(and_, on), how).select(*columns)


def drop_matching(
    left: DataFrame,
    keys: DataFrame,
    key: str | list[str],
    condition: Column | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Rows of ``left`` whose key is not in ``keys``; rows with a null key stay."""
    return join_unique(left, keys, key, "left_anti", condition, spread_by)


def key_bytes(*keys: str) -> Column:
    """Aggregate: upper bound of what the keys of these rows take in a broadcast table."""
    sizes = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys]
    size = reduce(add, sizes) + ROW_OVERHEAD
    return F.coalesce(F.sum(size.cast("long")), F.lit(0).cast("long"))


def _value_bytes(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StructType):
        return reduce(add, [_value_bytes(value[f.name], f.dataType) for f in kind.fields], F.lit(16))
    if isinstance(kind, ArrayType):
        items = F.aggregate(value, F.lit(0), lambda n, x: n + _value_bytes(x, kind.elementType))
        return F.coalesce(items, F.lit(0)) + 16
    return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)) + 16


def row_bytes(schema: StructType) -> Column:
    """Aggregate: upper bound of what these rows take, whole, in a broadcast table."""
    sizes = [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields]
    size = reduce(add, sizes) + ROW_OVERHEAD
    return F.coalesce(F.sum(size.cast("long")), F.lit(0).cast("long"))


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes of keys up to which a side is broadcast: the session's, else ``BROADCAST_LIMIT``."""
    return int(spark.conf.get(BROADCAST_SETTING, str(BROADCAST_LIMIT)))


def broadcast_if_small(df: DataFrame, size: int) -> DataFrame:
    """Ask for a broadcast where the measured ``size`` in bytes is within the limit, else for none.

    Spark's own estimate starts from the size of compressed files, which says little of the rows:
    keys of a few bytes each in zstd files pass its threshold by the million, and all of them go
    through the driver. A sort-merge join sends nothing there.
    """
    return F.broadcast(df) if size <= broadcast_limit(df.sparkSession) else df.hint("merge")
