"""Benchmark decontamination by greedy string tiling.

A document is compared with a benchmark item once they share a seed: ``TILE``
consecutive tokens. Seeds are found by a rolling Karp-Rabin hash over the document's
tokens, looked up among the items' hashes, and checked token by token. Then tiles are
marked: the longest common run of unmarked tokens first, at least ``TILE`` long, none
overlapping another in the document or in the item, until none is left. Every such
run consists of seeds on one diagonal, so tiling starts from the seeds and never
looks at the rest of a long document. The item's coverage is the share of its tokens in
tiles, in whatever order the document has them; from ``COVERAGE`` on the
document is contaminated.

Tokens are words in lower case without punctuation at either end; what is only
punctuation is no token. An item of fewer than ``TILE`` tokens is one seed by itself.

The benchmark is cut into blocks of a bounded number of tokens, which Spark stores in the shared
folder. A task holds some documents and goes through the blocks, one index at a time, so
one plan reads each document once, whatever the size of the benchmark; neither the
driver nor a task has all of it.

Defined cases: null and empty texts contain nothing and items without tokens are in
nothing; repeated documents are judged alike, equal items each for itself; null ids
stay null; no documents or no items give no rows. Other columns play no part.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.llm.common import chunks, stored, table, word_count
from listmill.session import work_dir

TILE = 5
COVERAGE = 0.6

# Tokens of the benchmark items that are indexed at once: about 64 MB of Python objects.
BLOCK_TOKENS = 1 << 18
# Bytes of text that a task takes through all blocks at once.
TEXT_BYTES = 32 << 20

_EDGES = b""".,;:!?*#$%&|"'()[]{}<>-_/\\"""
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    stripped = (w.strip(_EDGES) for w in text.lower().split())
    return [w for w in stripped if w]


def rolling_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` ids, modulo 2**64."""
    count = len(ids) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.zeros(count, np.uint64)
    for i in range(size):
        hashes = hashes * _BASE + ids[i : i + count]
    return hashes


def tile(seeds: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item place, document place, length) from all seeds of a pair.

    ``seeds`` are the places of equal runs of ``size`` tokens. Longest first; equal
    lengths by place in the document, then in the item.
    """
    by_diagonal = defaultdict(list)
    for i, j in seeds:
        by_diagonal[j - i].append(i)
    runs = []
    for diagonal, places in by_diagonal.items():
        places.sort()
        start = end = places[0]
        for i in [*places[1:], None]:
            if i is not None and i == end + 1:
                end = i
                continue
            runs.append((start - end - size, start + diagonal, start))
            start = end = i
    heapq.heapify(runs)
    in_item: set[int] = set()
    in_text: set[int] = set()
    tiles = []
    while runs:
        length, j, i = heapq.heappop(runs)
        length = -length
        free = [i + n not in in_item and j + n not in in_text for n in range(length)]
        if all(free):
            tiles.append((i, j, length))
            in_item.update(range(i, i + length))
            in_text.update(range(j, j + length))
            continue
        start = None
        for n, is_free in enumerate([*free, False]):
            if is_free and start is None:
                start = n
            elif not is_free and start is not None:
                if n - start >= size:
                    heapq.heappush(runs, (start - n, j + start, i + start))
                start = None
    return tiles


@dataclass
class _Items:
    """A block of benchmark items, made for looking up seeds."""

    rows: list[tuple[object, list[int]]]
    ids: dict[bytes, int]
    # seed length -> (sorted hashes, the place of each as (row, start))
    seeds: dict[int, tuple[np.ndarray, list[tuple[int, int]]]]

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], size: int) -> _Items:
        ids: dict[bytes, int] = {}
        rows = []
        for item, text in items:
            words = tokens((text or "").encode())
            if words:
                rows.append((item, [ids.setdefault(w, len(ids) + 1) for w in words]))
        found = defaultdict(list)
        for row, (_, words) in enumerate(rows):
            length = min(size, len(words))
            hashes = rolling_hashes(np.array(words, np.uint64), length)
            found[length] += [(h, row, i) for i, h in enumerate(hashes.tolist())]
        seeds = {}
        for length, entries in found.items():
            entries.sort()
            seeds[length] = (
                np.array([e[0] for e in entries], np.uint64),
                [(e[1], e[2]) for e in entries],
            )
        return cls(rows, ids, seeds)

    def seeds_in(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Seeds by item that a document, as ids, shares with it."""
        pairs = defaultdict(list)
        for length, (sorted_hashes, places) in self.seeds.items():
            hashes = rolling_hashes(words, length)
            left = np.searchsorted(sorted_hashes, hashes)
            hit = left < len(sorted_hashes)
            hit[hit] = sorted_hashes[left[hit]] == hashes[hit]
            for j in np.flatnonzero(hit).tolist():
                at = int(left[j])
                here = words[j : j + length].tolist()
                while at < len(places) and sorted_hashes[at] == hashes[j]:
                    row, i = places[at]
                    if self.rows[row][1][i : i + length] == here:
                        pairs[row].append((i, j))
                    at += 1
        return pairs

    def coverages(self, text: bytes, size: int) -> Iterator[tuple[object, float, int]]:
        """(item, coverage, number of tiles) of all items that share a seed."""
        words = tokens(text)
        known = np.fromiter(map(self.ids.get, words, [0] * len(words)), np.uint64, len(words))
        for row, seeds in self.seeds_in(known).items():
            item, item_words = self.rows[row]
            tiles = tile(seeds, min(size, len(item_words)))
            covered = sum(length for _, _, length in tiles)
            yield item, covered / len(item_words), len(tiles)


def store_blocks(benchmark: DataFrame, block_tokens: int) -> str:
    """The folder of a table with the items in blocks of ``block_tokens`` words, one item at least.

    Which items make a block does not matter for the result, so they are dealt out
    evenly and each task cuts what it has. A block is a row, an Arrow stream.
    """
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    words = items.agg(F.sum(word_count(F.col("text")))).first()[0] or 0

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                n = len((batch.column(1)[row].as_py() or "").split())
                if held and words + n > block_tokens:
                    yield _packed(held)
                    held, words = [], 0
                held.append(batch.slice(row, 1))
                words += n
        if held:
            yield _packed(held)

    folder = work_dir(benchmark.sparkSession, "benchmark-blocks")
    dealt = items.repartition(int(words // block_tokens) + 1)
    dealt.mapInArrow(packed, "block binary").write.parquet(folder)
    return folder


def _packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    items = pa.Table.from_batches(rows).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, items.schema) as stream:
        stream.write_table(items)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()])], ["block"])


class _Blocks:
    """The stored blocks as indexes, one of them in memory."""

    def __init__(self, folder: str, tile_size: int):
        self.where, path = fs.FileSystem.from_uri(folder)
        self.tile_size = tile_size
        self.names = []
        for info in self.where.get_file_info(fs.FileSelector(path)):
            if info.base_name.endswith(".parquet"):
                with self.where.open_input_file(info.path) as file:
                    count = pq.ParquetFile(file).metadata.num_rows
                self.names += [(info.path, n) for n in range(count)]
        self.names.sort()
        self.held = None

    def _read(self, path: str, number: int) -> pa.Table:
        with self.where.open_input_file(path) as file:
            rows = pq.ParquetFile(file).iter_batches(batch_size=1)
            block = next(row for n, row in enumerate(rows) if n == number)
        return pa.ipc.open_stream(block.column(0)[0].as_py()).read_all()

    def indexes(self) -> Iterator[tuple[_Items, pa.DataType]]:
        """All blocks; the next call begins with the last one, which is still there."""
        for name in self.names:
            if self.held is None or self.held[0] != name:
                self.held = None
                block = self._read(*name)
                rows = zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True)
                index = _Items.of(list(rows), self.tile_size)
                self.held = (name, index, block.schema.field(0).type)
            yield self.held[1:]
        self.names.reverse()


def overlaps(
    documents: DataFrame,
    benchmark: DataFrame,
    tile_size: int = TILE,
    coverage: float = COVERAGE,
    block_tokens: int = BLOCK_TOKENS,
    id_columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """(id columns, item_id, coverage, tiles) of contaminated documents."""
    rows = documents.select(*id_columns, F.col("text").cast("string").alias("_text"))
    item_type = benchmark.schema["item_id"].dataType
    schema = rows.drop("_text").schema.add("item_id", item_type).add("coverage", "double")
    schema = schema.add("tiles", "long")
    folder = store_blocks(benchmark, block_tokens)
    return rows.mapInArrow(_tiler(folder, tile_size, coverage, len(id_columns)), schema)


def _together(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches with about ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _tiler(folder: str, tile_size: int, coverage: float, id_count: int):
    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(folder, tile_size)
        for together in _together(chunks(batches, "_text"), TEXT_BYTES):
            for items, item_type in blocks.indexes():
                for batch in together:
                    found = _hits(batch, items, tile_size, coverage, id_count)
                    if not found:
                        continue
                    at, names, shares, tiles = zip(*found, strict=True)
                    columns = [c.take(pa.array(at)) for c in batch.columns[:id_count]]
                    columns += [pa.array(names, item_type), pa.array(shares), pa.array(tiles, pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        columns, [*batch.schema.names[:id_count], "item_id", "coverage", "tiles"]
                    )

    return tiled


def _hits(
    batch: pa.RecordBatch, items: _Items, tile_size: int, coverage: float, id_count: int
) -> list[tuple[int, object, float, int]]:
    """(row, item, coverage, tiles) of the contaminated rows."""
    texts = batch.column(id_count).cast(pa.binary())
    return [
        (row, *hit)
        for row in range(batch.num_rows)
        for hit in items.coverages(texts[row].as_py() or b"", tile_size)
        if hit[1] >= coverage
    ]


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no benchmark item."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    rows = documents.select("doc_id", "text", key.alias("_h"))
    # stored, so that Spark knows its size and, if it is small, does not shuffle the texts
    dirty = overlaps(rows, benchmark, id_columns=("_h",), **options).select("_h").distinct()
    dirty = stored(dirty, "contaminated")
    kept = documents.select(F.struct("*").alias("row"), key.alias("_h"))
    return kept.join(dirty, "_h", "left_anti").select("row.*")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the items they contain."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "coverage", "tiles"
    )
