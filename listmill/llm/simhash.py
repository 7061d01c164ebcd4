"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints of 64 bits link at ``RADIUS`` or fewer differing bits. Only different
fingerprints are compared: copies and texts with equal fingerprints are one node.

Candidates. The bits are cut into ``RADIUS + 2`` blocks; two fingerprints within the
radius agree in two blocks at least, so each pair of blocks gives a table whose key
is about 26 bits, and rows meet only in a table where they have the same key.

Comparison. The fingerprints of a key are stored vertically: word ``w`` of bit plane
``b`` holds bit ``b`` of fingerprints 64 w to 64 w + 63. Planes are compared by XOR;
the differences are counted for 64 fingerprints at once in a carry-save counter of
as many words as the radius has bits, whose overflow marks a distance beyond
the radius, and comparing stops when all fingerprints of a block have overflowed.
Short groups of one key are laid side by side and compared with themselves shifted by
1, 2, ... places. Long groups go query by query against blocks, and blocks that are
wholly in the query's component are left out. Each group returns links that span its
components, fewer than it has members.

Hot keys. A key with more than ``LONG_GROUP`` fingerprints is refined: the bits it leaves
open are cut into ``RADIUS + 1`` parts, and near fingerprints agree in one of them at
least, so its rows go to that many finer keys. As long as one is hot, it is refined again. A
key that leaves 12 bits open has at most 4,096 fingerprints, so five times are enough
for the radius of 3, and no task gets a larger group.

Components. Links become components by large-star and small-star steps on DataFrames,
each of them stored, until nothing changes.

Defined cases: a null text is empty; a text without words has fingerprint zero and
links like any other; a null id has a fingerprint and never is a component's name
unless all its members' ids are null; repeated rows stay; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill.llm.common import chunks, stored, table
from listmill.operators.joins import join_unique

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64

# Groups of up to this many fingerprints of one key are compared by shifts.
SHORT_GROUP = 64
# Fingerprints of a long group that are compared as one block.
BLOCK = 4096
# Fingerprints of one key that are compared in one task.
LONG_GROUP = 4096
# Rows taken together by a task, more only where one key has more.
ROWS_AT_ONCE = 1 << 17


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of each shingle of lower-cased words, of all words where they are fewer."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    count = max(len(words) - size + 1, 1)
    stops = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts[:count], stops, strict=True)]


def fingerprint(hashes: list[int]) -> int:
    """Bits that more than half of the hashes have."""
    if not hashes:
        return 0
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text's bits take 4 MB at once
        part = np.array(hashes[at : at + (1 << 16)], np.uint64)
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, *keep: Column, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    rows = documents.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = rows.drop("_text").schema.add("fp", "long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            found = [fingerprint(shingle_hashes(t or b"", shingle)) for t in texts]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fps)], [*batch.schema.names[:-1], "fp"]
            )

    return rows.mapInArrow(hashed, schema)


def block_tables(radius: int) -> list[tuple[int, ...]]:
    """Bit masks of all pairs of blocks, as lists of (shift, width)."""
    count = radius + 2
    edges = [BITS * i // count for i in range(count + 1)]
    blocks = [(edges[i], edges[i + 1] - edges[i]) for i in range(count)]
    return list(combinations(blocks, 2))


def _key(mask: Column) -> Column:
    """Names the rows that agree in the bits of the mask.

    Groups whose names are equal by chance are compared as one, by all their bits.
    """
    return F.xxhash64(mask, F.col("fp").bitwiseAND(mask))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def with_keys(nodes: DataFrame, radius: int) -> DataFrame:
    """(fp, mask, key): a row per fingerprint and pair of blocks."""
    masks = [
        _signed(sum(((1 << width) - 1) << shift for shift, width in pair))
        for pair in block_tables(radius)
    ]
    rows = nodes.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    return rows.withColumn("key", _key(F.col("mask")))


def finer_masks(mask: int, radius: int) -> list[int]:
    """The mask with one of ``radius + 1`` parts of its open bits added; none if they are too few."""
    bits = [b for b in range(BITS) if not mask >> b & 1]
    if len(bits) <= radius:
        return []
    edges = [len(bits) * i // (radius + 1) for i in range(radius + 2)]
    parts = [bits[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(mask % (1 << BITS) | sum(1 << b for b in part)) for part in parts]


def comparison_groups(nodes: DataFrame, radius: int, most: int | None = None) -> DataFrame:
    """(fp, key): rows of equal key are compared, at most ``most`` (``LONG_GROUP``) of a key.

    Hot keys are looked for by a count that is combined before it is shuffled, and only
    their rows are refined. The masks are known beforehand: ten, and four times as many
    with each refinement.
    """
    most = LONG_GROUP if most is None else most
    spark = nodes.sparkSession
    rows, groups = with_keys(nodes, radius), None
    masks = [_signed(sum(((1 << w) - 1) << s for s, w in pair)) for pair in block_tables(radius)]
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        hot = stored(sizes.where(F.col("n") > most).select("key"), "hot-keys")
        finer = [(m, f) for m in masks for f in finer_masks(m, radius)]
        if not finer or hot.isEmpty():
            part = rows.select("fp", "key")
            return part if groups is None else groups.unionByName(part)
        part = join_unique(rows, hot, "key", "left_anti").select("fp", "key")
        groups = part if groups is None else groups.unionByName(part)
        table_of = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        found = join_unique(rows, hot, "key", "inner").join(table_of, "mask")
        found = found.select("fp", F.col("finer").alias("mask"))
        rows = stored(found.distinct().withColumn("key", _key(F.col("mask"))), "finer-keys")
        masks = sorted({f for _, f in finer})


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): plane b, word w holds bit b of fingerprints 64 w ... 64 w + 63."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def within(differing: np.ndarray, radius: int, beyond: np.ndarray) -> np.ndarray:
    """Mask of the lanes with at most ``radius`` set planes.

    ``differing`` has the XORed planes first; ``beyond`` marks lanes to leave out. The
    counter starts so that its overflow is the radius exceeded.
    """
    digits = radius.bit_length()
    start = (1 << digits) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counter = [
        np.full_like(beyond, full if start >> d & 1 else np.uint64(0)) for d in range(digits)
    ]
    over = beyond.copy()
    for number, carry in enumerate(differing):
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if number % 8 == 7 and (over == full).all():
            break
    return ~over


def _lanes(mask: np.ndarray) -> np.ndarray:
    """Places of the set bits."""
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))


def _mask(lanes: np.ndarray, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, np.uint8)
    bits[: len(lanes)] = lanes
    return np.packbits(bits, bitorder="little").view(np.uint64)


class _Sets:
    """Disjoint sets over the rows at hand."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def short_group_links(fps: np.ndarray, keys: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links within the runs of equal keys, all of them compared by shifts."""
    planes = bit_planes(fps)
    words = planes.shape[1]
    sets, links = _Sets(len(fps)), []
    padded = np.concatenate([planes, np.zeros((BITS, 2), np.uint64)], axis=1)
    for shift in range(1, SHORT_GROUP):
        same = keys[shift:] == keys[:-shift]
        if not same.any():
            break
        at, by = divmod(shift, 64)
        moved = padded[:, at : at + words] >> np.uint64(by)
        if by:
            moved = moved | padded[:, at + 1 : at + 1 + words] << np.uint64(64 - by)
        near = within((p ^ m for p, m in zip(planes, moved, strict=True)), radius, ~_mask(same, words))
        for i in _lanes(near).tolist():
            if sets.join(i, i + shift):
                links.append((i, i + shift))
    return links


def long_group_links(fps: np.ndarray, radius: int, block: int = BLOCK) -> list[tuple[int, int]]:
    """Spanning links within one key, query by query against the blocks before it."""
    sets, links = _Sets(len(fps)), []
    planes = [bit_planes(fps[at : at + block]) for at in range(0, len(fps), block)]
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    whole: dict[int, bool] = {}  # complete blocks, and whether they are of one component
    for i, fp in enumerate(fps.tolist()):
        query = [ones if fp >> b & 1 else np.uint64(0) for b in range(BITS)]
        for number in range(i // block, -1, -1):
            first = number * block
            if whole.get(number) and sets.find(first) == sets.find(i):
                continue
            open_lanes = min(i - first, block)
            if open_lanes <= 0:
                continue
            side = planes[number]
            out = ~_mask(np.ones(open_lanes, np.uint8), side.shape[1])
            near = within((p ^ q for p, q in zip(side, query, strict=True)), radius, out)
            for j in _lanes(near).tolist():
                if sets.join(first + j, i):
                    links.append((first + j, i))
        if (i + 1) % block == 0:
            whole[i // block] = False
            for number in [n for n, one in whole.items() if not one]:  # links may have united them
                roots = {sets.find(j) for j in range(number * block, (number + 1) * block)}
                whole[number] = len(roots) == 1
    return links


def _links_of(keys: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Linked fingerprints of rows sorted by key, as rows of two."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(edges)
    found = []
    short = np.repeat((sizes > 1) & (sizes <= SHORT_GROUP), sizes)
    if short.any():
        part = fps[short]
        links = short_group_links(part, keys[short], radius)
        found.append(part[np.array(links, np.int64).reshape(-1, 2)])
    for number in np.flatnonzero(sizes > SHORT_GROUP):
        part = fps[edges[number] : edges[number + 1]]
        found.append(part[np.array(long_group_links(part, radius), np.int64).reshape(-1, 2)])
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between different fingerprints that span the near ones."""
    # sorting by fingerprint too puts near ones of a long group side by side
    rows = comparison_groups(nodes, radius).repartition("key").sortWithinPartitions("key", "fp")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(pairs: np.ndarray) -> pa.RecordBatch:
            pairs = pairs.view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"]
            )

        for batch in batches:
            keys = np.concatenate([keys, batch.column(1).to_numpy()])
            fps = np.concatenate([fps, batch.column(0).to_numpy().view(np.uint64)])
            if len(keys) < ROWS_AT_ONCE or keys[0] == keys[-1]:
                continue
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            yield out(_links_of(keys[:cut], fps[:cut], radius))
            keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield out(_links_of(keys, fps, radius))

    return rows.mapInArrow(linked, "a long, b long")


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) of every node with a link; the root is the smallest node reachable.

    A round hangs the larger neighbours of each node on its smallest one, then does
    so for the smaller ones. It keeps components together, and at the end every node
    hangs on its root.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = join_unique(both.where("v > u"), least, "u", "inner").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        large = stored(large.where("u <> v").distinct(), "links")
        least = smallest(large)
        small = join_unique(large, least, "u", "inner").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        hung = large.groupBy("u").agg(F.min("v").alias("v"))
        edges = stored(small.where("u <> v").unionByName(hung).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_groups(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Add ``group``, one fingerprint per component, to rows with ``fp``."""
    nodes = stored(rows.select("fp").distinct(), "fingerprints")
    found = stored(components(near_links(nodes, radius)), "components")
    roots = found.select(F.col("node").alias("fp"), "root")
    inside = join_unique(rows, roots, "fp", "inner")
    alone = join_unique(rows, roots, "fp", "left_anti")
    return inside.withColumnRenamed("root", "group").unionByName(
        alone.withColumn("group", F.col("fp"))
    )


def simhash_groups(
    documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    rows = stored(fingerprints(documents, F.col("doc_id"), shingle=shingle), "simhash")
    grouped = near_groups(rows, radius)
    names = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return join_unique(grouped, names, "group", "inner").drop("group")


def drop_near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One document of each component stays: that with the smallest id.

    Rows that share that id are told apart by their text's hash and, where that is
    equal too, one of them stays. A component of null ids keeps one row by hash.
    """
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    rows = stored(
        fingerprints(documents, F.col("doc_id"), key.alias("h"), shingle=shingle), "simhash"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h"))
    named = near_groups(rows, radius).groupBy("group").agg(first.alias("first"))
    kept = stored(named.select(F.col("first.doc_id").alias("k_id"), F.col("first.h").alias("k_h")), "kept")
    texts = documents.select(F.struct("*").alias("row"), "doc_id", key.alias("h"))
    # ids are compared as a range: as a join key they would make Spark shuffle the texts again
    # for the duplicates
    equal = F.coalesce(F.col("doc_id").between(F.col("k_id"), F.col("k_id")), F.lit(False))
    same = (F.col("h") == F.col("k_h")) & (
        equal | (F.col("doc_id").isNull() & F.col("k_id").isNull())
    )
    return texts.join(kept, same, "left_semi").dropDuplicates(["h", "doc_id"]).select("row.*")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
