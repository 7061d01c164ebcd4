"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt out by hash into index blocks of about ``BLOCK`` rows. Each block
has ``TREES`` trees; a tree gives every vector a string of ``BITS`` bits, one per hyperplane, each
halfway between two vectors of the block, and is stored as the sorted array of the strings
with the vectors' places. A query descends in all trees of a block to the longest prefix that
anything shares with it. Then it ascends in all of them together, one bit at a time,
until the ranges hold ``SHARE`` of the block's vectors, ``LEAST`` at least.
These candidates are measured exactly, and the block's best go on to the query's list.

The index is a stored table with one row per block. Queries are a stated set of rows, in
blocks of about ``QUERIES``, a row each of another stored table; a task takes one block of the index
through all of them, and holds no more than one of each. ``LEAST`` is a floor for blocks of less than
1,280 vectors, of which tables of fewer rows than ``BLOCK`` may consist: there more than ``SHARE`` of
a block is measured, never less.

``SHARE`` trades time for recall. The given vectors have no structure to find, their nearest
neighbours being three quarters as far as any others; recall of 0.9 takes about four tenths.

Defined cases: null, zero or empty vectors, those with null or non-finite components and rows
without an id take no part; vectors of different length are never compared; rows equal
in id and vector count once; rows of one id are never each other's neighbours; equal
distances go by id; no vectors give no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listmill.llm.common import rows_of_table, stored, table
from listmill.session import work_dir

NEAREST = 10
TREES = 48
BITS = 24
BLOCK = 4096
SHARE = 0.4
LEAST = 512
QUERIES = 2048
EVERY = 100

_INDEX = "dim int, block long, ids binary, vectors binary, strings binary, places binary"
_QUERIES = "dim int, ids binary, hashes binary, vectors binary"
_FOUND = "query_id long, query_hash long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, dim, h) of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    infinite = F.lit(float("inf"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & finite & nonzero).select(
        "*", F.size("vector").alias("dim"), F.xxhash64("vec_id", "vector").alias("h")
    )


def hyperplanes(vectors: np.ndarray, trees: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Normals (dim, trees * bits) and offsets, each halfway between two of the vectors."""
    pairs = np.random.default_rng(len(vectors)).integers(0, len(vectors), (2, trees * bits))
    a, b = vectors[pairs[0]], vectors[pairs[1]]
    return (a - b).T, ((a * a).sum(axis=1) - (b * b).sum(axis=1)) / 2


def bit_strings(vectors: np.ndarray, planes, trees: int, bits: int) -> np.ndarray:
    """(trees, rows): each row's string as a number, its first bit the highest."""
    normals, offsets = planes
    sides = (vectors @ normals > offsets).reshape(len(vectors), trees, bits)
    return (sides @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))).T


def _build(trees: int, bits: int):
    def built(group: pa.Table) -> pa.Table:
        ids = group["vec_id"].to_numpy()
        dim = group["dim"][0].as_py()
        vectors = group["vector"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        # one row of each, in an order that does not depend on how they came
        order = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
        ids, vectors = ids[new], np.ascontiguousarray(vectors[new])
        strings = bit_strings(vectors, hyperplanes(vectors, trees, bits), trees, bits)
        places = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        row = {
            "dim": pa.array([dim], pa.int32()),
            "block": pa.array([group["block"][0].as_py()], pa.int64()),
            "ids": [ids.tobytes()],
            "vectors": [vectors.tobytes()],
            "strings": [np.take_along_axis(strings, places, axis=1).tobytes()],
            "places": [places.tobytes()],
        }
        return pa.table(row)

    return built


def build_index(vectors: DataFrame, trees: int = TREES, bits: int = BITS) -> DataFrame:
    """The stored forest: a row per block of the usable vectors."""
    # h follows from id and vector, so a row that repeats neither gathers nor counts
    vectors = vectors.dropDuplicates(["vec_id", "h"])
    counts = vectors.groupBy(F.col("dim").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    # a row per vector length
    blocks = stored(counts.select("d", F.ceil(F.col("n") / BLOCK).alias("blocks")), "blocks")
    dealt = vectors.join(blocks, F.col("dim") == F.col("d")).select(
        "vec_id", "vector", "dim", F.pmod(F.col("h"), F.col("blocks")).alias("block")
    )
    return stored(dealt.groupBy("dim", "block").applyInArrow(_build(trees, bits), _INDEX), "forest")


class Forest:
    """One block of the index."""

    def __init__(self, row: dict, trees: int, bits: int):
        self.trees, self.bits = trees, bits
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        self.strings = np.frombuffer(row["strings"], np.int64).reshape(trees, -1)
        self.places = np.frombuffer(row["places"], np.int32).reshape(trees, -1)
        self.planes = hyperplanes(self.vectors, trees, bits)

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end place (queries, prefix lengths, trees) of what shares each prefix."""
        strings = bit_strings(queries, self.planes, self.trees, self.bits)
        shape = (len(queries), self.bits + 1, self.trees)
        first, end = np.empty(shape, np.int32), np.empty(shape, np.int32)
        for t in range(self.trees):
            for length in range(self.bits + 1):
                rest = self.bits - length
                prefix = strings[t] >> rest
                first[:, length, t] = np.searchsorted(self.strings[t], prefix << rest)
                end[:, length, t] = np.searchsorted(self.strings[t], (prefix + 1) << rest)
        return first, end

    def candidates(self, first: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
        """Places of at least ``least`` vectors, ascending from the longest prefixes."""
        sums = (end - first).sum(axis=1)
        found = np.zeros(len(self.ids), bool)
        # the longest prefixes that can hold enough, as one vector may be in all trees
        length = int(np.flatnonzero(sums >= least)[-1])
        while True:
            for t in range(self.trees):
                found[self.places[t, first[length, t] : end[length, t]]] = True
            if length == 0 or np.count_nonzero(found) >= least:
                return np.flatnonzero(found)
            length -= 1

    def nearest(
        self, ids: np.ndarray, queries: np.ndarray, count: int, share: float
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the query, ids, distances) of the best of the block."""
        least = min(len(self.ids), max(LEAST, int(share * len(self.ids))))
        first, end = self.ranges(queries)
        for q, (own, query) in enumerate(zip(ids, queries, strict=True)):
            places = self.candidates(first[q], end[q], least)
            places = places[self.ids[places] != own]
            away = np.sqrt(((self.vectors[places] - query) ** 2).sum(axis=1))
            best = np.lexsort((self.ids[places], away))[:count]
            yield q, self.ids[places[best]], away[best]


def _search(folder: str, count: int, share: float, trees: int, bits: int):
    """Each block of the index against all blocks of queries in the folder."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                forest = Forest(row, trees, bits)
                for block in rows_of_table(folder):
                    if block["dim"] == row["dim"]:
                        yield _found(forest, block, count, share)

    return searched


def _found(forest: Forest, block: dict, count: int, share: float) -> pa.RecordBatch:
    ids, hashes = (np.frombuffer(block[c], np.int64) for c in ("ids", "hashes"))
    queries = np.frombuffer(block["vectors"], np.float64).reshape(len(ids), -1)
    found = list(forest.nearest(ids, queries, count, share))
    q = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
    columns = [
        ids[q],
        hashes[q],
        np.concatenate([f[1] for f in found]),
        np.concatenate([f[2] for f in found]),
    ]
    names = ["query_id", "query_hash", "vec_id", "score"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _packed(group: pa.Table) -> pa.Table:
    ids, hashes = (group[c].to_numpy() for c in ("vec_id", "h"))
    dim = group["dim"][0].as_py()
    vectors = group["vector"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
    order = np.lexsort((hashes, ids))
    row = {"dim": pa.array([dim], pa.int32())}
    for name, column in (("ids", ids), ("hashes", hashes), ("vectors", vectors)):
        row[name] = [column[order].tobytes()]
    return pa.table(row)


def store_queries(queries: DataFrame, size: int) -> str:
    """The folder of a table with the different queries in blocks of about ``size``, a row each."""
    rows = queries.dropDuplicates(["vec_id", "h"])
    counts = rows.groupBy(F.col("dim").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    # a row per vector length
    blocks = stored(counts.select("d", F.ceil(F.col("n") / size).alias("blocks")), "query-counts")
    dealt = rows.join(blocks, F.col("dim") == F.col("d")).select(
        "vec_id", "h", "vector", "dim", F.pmod(F.col("h"), F.col("blocks")).alias("block")
    )
    folder = work_dir(queries.sparkSession, "query-blocks")
    dealt.groupBy("dim", "block").applyInArrow(_packed, _QUERIES).write.parquet(folder)
    return folder


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    count: int = NEAREST,
    share: float = SHARE,
    trees: int = TREES,
    bits: int = BITS,
) -> DataFrame:
    """(query_id, rank, vec_id, score); both frames as ``usable`` gives them."""
    index = build_index(vectors, trees, bits)
    blocks = max(index.count(), 1)
    search = _search(store_queries(queries, QUERIES), count, share, trees, bits)
    found = index.repartition(blocks, "dim", "block").mapInArrow(search, _FOUND)
    found = stored(found, "found")
    best = Window.partitionBy("query_id", "query_hash").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= count)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op7_neighbours(spark, sf_dir: str) -> DataFrame:
    """Nearest vectors of every hundredth."""
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
