"""Substring de-duplication by super-k-mers.

A window is ``WINDOW`` consecutive words of a document. The minimiser of a window is
the smallest hash of the ``GRAM`` word runs in it. Consecutive windows with the same minimiser
travel together, as one string of all their words: a super-k-mer, some ten windows
for the words of three. Its bucket follows from the minimiser, so equal windows meet
in one bucket, where they are sorted and the first of equals stands; all others mark
their words as repeated. Equality is exact: words get numbers per bucket, windows are
sorted by a hash of the numbers, and neighbours of equal hash are compared number by
number.

A task keeps each super-k-mer of a piece of its input only once, with its earliest
place; later places are repeats already. What goes to one bucket is compressed
together. Buckets are as many as keep one at about ``BUCKET_BYTES`` of text.

Minimisers with ``HOT_LEAST`` windows or more, and none with less than half of that, are
counted first: in text of a short period one super-k-mer has as many windows as the text.
Their windows travel one by one and are dealt out by their own words, so neither text around
a passage that everybody quotes nor a line repeated in succession gathers in one bucket.

Defined cases: null and empty texts have no words; windows do not cross documents; a
text shorter than a window repeats nothing; rows with equal id and text are one
document and treated alike; of rows with one id and different texts, that with
the smaller text hash is earlier; a null id is earlier than all others; no rows give no rows.
Other columns play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.llm.common import chunks, table

WINDOW = 20
GRAM = 2
BUCKET_BYTES = 2 << 20
# Bytes of text that a task packs at once, and the level it compresses with.
PIECE_BYTES = 4 << 20
LEVEL = 3
# A minimiser with fewer windows fits any bucket; comparing takes some 100 bytes a window.
HOT_LEAST = 1 << 19
# Super-k-mers that a task has as Python objects at once.
SLICE = 1 << 16

_NULL_ID = -(1 << 63)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xC2B2AE3D27D4EB4F)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MORE
    return x ^ (x >> np.uint64(29))


def _sum_of_runs(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every run of ``length`` values, by doubling."""
    done, total = 0, None
    part, size, factor = values, 1, _MIX
    while True:
        if length & size:
            if total is None:
                total, done = part, size
            else:
                n = len(values) - done - size + 1
                total = total[: max(n, 0)] * factor + part[done : done + max(n, 0)]
                done += size
        if size * 2 > length:
            return total
        n = len(part) - size
        part = part[: max(n, 0)] * factor + part[size : size + max(n, 0)]
        size *= 2
        with np.errstate(over="ignore"):
            factor = factor * factor


def _sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    size = 1
    while size * 2 <= length:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = length - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class _Piece:
    """Words of some documents and the super-k-mers in them."""

    def __init__(self, texts: list[bytes | None], window: int):
        words: list[bytes] = []
        counts = []
        for text in texts:
            own = (text or b"").split()
            words += own
            counts.append(len(own))
        self.window = window
        self.text = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        counts = np.array(counts, np.int64)
        first = np.cumsum(counts) - counts
        places = np.maximum(counts - window + 1, 0)
        self.row = np.repeat(np.arange(len(counts)), places)
        # windows by the number of their first word
        at = np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        self.at = at + first[self.row] if len(at) else at
        self.place = at
        self.minimiser = np.zeros(0, np.uint64)
        if len(at):
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
            del words
            hashes = _scrambled(_sum_of_runs(hashes, GRAM))
            self.minimiser = _sliding_min(hashes, window - GRAM + 1)[self.at]

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each super-k-mer."""
        if not len(self.at):
            return self.at, self.at
        new = np.ones(len(self.at), bool)
        new[1:] = (self.minimiser[1:] != self.minimiser[:-1]) | (self.row[1:] != self.row[:-1])
        first = np.flatnonzero(new)
        return first, np.diff(np.append(first, len(self.at)))

    def split(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Super-k-mers, those of hot minimisers as single windows."""
        first, count = self.runs()
        if not len(hot) or not len(first):
            return first, count
        is_hot = np.isin(self.minimiser[first], hot)
        times = np.where(is_hot, count, 1)
        single = np.repeat(is_hot, times)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(first, times) + nth, np.where(single, 1, np.repeat(count, times))


def _text_bytes(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0


def _hot_minimisers(rows: DataFrame, window: int, size: int | None = None) -> np.ndarray:
    """Minimisers with ``HOT_LEAST`` windows; ``size`` is the bytes of all texts.

    A piece reports those with its share of half that many windows. What it leaves out
    adds up to less than half, so half is enough to count.
    """
    size = max(_text_bytes(rows) if size is None else size, 1)
    most = HOT_LEAST / 2

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            texts = batch.column(2).cast(pa.binary())
            own = pc.sum(pc.binary_length(texts)).as_py() or 0
            piece = _Piece(texts.to_pylist(), window)
            first, count = piece.runs()
            found, which = np.unique(piece.minimiser[first], return_inverse=True)
            n = np.bincount(which, count, len(found)).astype(np.int64)
            heavy = n >= most * own / size
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[heavy].view(np.int64)), pa.array(n[heavy])], ["minimiser", "n"]
            )

    counts = rows.mapInArrow(counted, "minimiser long, n long")
    sums = counts.groupBy("minimiser").agg(F.sum("n").alias("n"))
    # at most a row per HOT_LEAST / 2 windows of the table
    hot = sums.where(F.col("n") >= most).select("minimiser").collect()
    return np.array([r["minimiser"] for r in hot], np.int64).view(np.uint64)


def _pack(compress, ids, hashes, places, counts, strings) -> bytes:
    columns = [np.array(c, np.int64).tobytes() for c in (ids, hashes, places, counts)]
    return compress(b"".join([len(ids).to_bytes(8, "little"), *columns, b"\n".join(strings)]))


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    n = int.from_bytes(blob[:8], "little")
    return np.frombuffer(blob, np.int64, 4 * n, 8).reshape(4, n), blob[8 + 32 * n :]


def _packer(window: int, buckets: int, hot: list[int]):
    """Documents -> (bucket, packed super-k-mers); a bucket below 0 packs known repeats."""
    hot_set = np.array(hot, np.uint64)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstd.ZstdCompressor(level=LEVEL).compress
        digest = xxhash.xxh64_intdigest
        for batch in chunks(batches, "_text", PIECE_BYTES):
            piece = _Piece(batch.column(2).cast(pa.binary()).to_pylist(), window)
            ids = pc.fill_null(batch.column(0), _NULL_ID).to_pylist()
            hashes = batch.column(1).to_pylist()
            first, count = piece.split(hot_set)
            columns = rows = None
            minimisers = piece.minimiser[first]
            text = piece.text
            seen: dict[bytes, tuple] = {}
            repeats: list[list[int]] = []

            def repeat(entry: tuple, repeats=repeats) -> None:
                """Windows side by side become one run."""
                last = repeats[-1] if repeats else None
                if last and last[0] == entry[0] and last[1] == entry[1] and last[2] + last[3] == entry[2]:
                    last[3] += entry[3]
                else:
                    repeats.append(list(entry[:4]))

            for at in range(0, len(first), SLICE):
                part, n = first[at : at + SLICE], count[at : at + SLICE]
                word = piece.at[part]
                columns = (
                    piece.row[part],
                    piece.place[part],
                    n,
                    piece.starts[word],
                    piece.ends[word + n + window - 2],
                )
                rows = zip(*(c.tolist() for c in columns), strict=True)
                for i, (row, place, n, start, end) in enumerate(rows, at):
                    string = text[start:end]
                    here = (ids[row], hashes[row], place, n, i)
                    other = seen.get(string)
                    if other is None:
                        seen[string] = here
                    elif here[:3] < other[:3]:
                        seen[string] = here
                        repeat(other)
                    elif here[:3] > other[:3]:
                        repeat(here)
            parts = defaultdict(list)
            kept = np.fromiter((entry[4] for entry in seen.values()), np.int64, len(seen))
            own = np.isin(minimisers[kept], hot_set).tolist()
            by_minimiser = (_scrambled(minimisers[kept]) % np.uint64(buckets)).tolist()
            for (string, entry), alone, bucket in zip(seen.items(), own, by_minimiser, strict=True):
                bucket = digest(string) % buckets if alone else bucket
                parts[bucket].append((*entry[:4], string))
            out, blobs = [], []
            for bucket, entries in parts.items():
                out.append(bucket)
                blobs.append(_pack(compress, *zip(*entries, strict=True)))
            for at in range(0, len(repeats), 4096):
                entries = [(*entry, b"") for entry in repeats[at : at + 4096]]
                blob = _pack(compress, *zip(*entries, strict=True))
                out.append(-1 - digest(blob) % buckets)
                blobs.append(blob)
            arrays = [pa.array(out, pa.int64()), pa.array(blobs, pa.binary())]
            # a worker keeps nothing of a piece while it waits for the next
            del piece, seen, parts, repeats, repeat, first, count, columns, rows, kept, text, out, blobs
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "packed"])
            del arrays
            pa.default_memory_pool().release_unused()

    return packed


def _word_numbers(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word, equal words alike, and which words end a line."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    line_end = np.append(data[ends] == 10, True)
    # each word keeps its separator; the last gets one, and a line's last differs by it
    flat = data.copy()
    flat[ends] = 32
    flat = np.append(flat, np.uint8(32))
    offsets = np.concatenate([[0], ends + 1, [len(flat)]]).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    )
    numbers = array.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return numbers.astype(np.uint64), line_end


def repeated_windows(blobs: list[bytes], window: int) -> np.ndarray:
    """Rows (id, text hash, place, windows) of the bucket's windows that start earlier too."""
    parts = [_unpack(b) for b in blobs]
    entries = np.concatenate([p[0] for p in parts], axis=1)
    numbers, line_end = _word_numbers(b"\n".join(p[1] for p in parts))
    line_start = np.concatenate([[0], np.flatnonzero(line_end)[:-1] + 1])
    order = np.lexsort((entries[2], entries[1], entries[0]))
    entries, line_start = entries[:, order], line_start[order]
    counts = entries[3]
    # windows by id, text hash and place
    entry = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = line_start[entry] + nth
    hashes = _scrambled(_sum_of_runs(_scrambled(numbers + np.uint64(1)), window))[at]
    sort = np.argsort(hashes, kind="stable")
    same = np.zeros(len(sort), bool)
    same[1:] = hashes[sort[1:]] == hashes[sort[:-1]]
    a, b = at[sort[:-1][same[1:]]], at[sort[1:][same[1:]]]
    if any((numbers[a + i] != numbers[b + i]).any() for i in range(window)):
        # different windows with one hash: sort by the words themselves
        rows = np.stack([numbers[at + i] for i in range(window)], axis=1)
        group = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        sort = np.argsort(group, kind="stable")
        same[1:] = group[sort[1:]] == group[sort[:-1]]
    first = sort[np.maximum.accumulate(np.where(same, 0, np.arange(len(sort))))]
    place = entries[2][entry] + nth
    whose = entries[:2, entry]
    differs = (place[first] != place[sort]) | (whose[:, first] != whose[:, sort]).any(axis=0)
    marked = np.zeros(len(sort), bool)
    marked[sort[same & differs]] = True
    hit = np.flatnonzero(marked)
    if not len(hit):
        return np.zeros((4, 0), np.int64)
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (entry[hit[1:]] != entry[hit[:-1]])
    start = np.flatnonzero(new)
    windows = np.diff(np.append(start, len(hit)))
    return np.stack([*whose[:, hit[start]], place[hit[start]], windows])


def _unpacker(window: int):
    """(bucket, packed), sorted by bucket -> runs of repeated windows."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstd.ZstdDecompressor().decompress

        def out(rows: np.ndarray) -> pa.RecordBatch:
            names = ["id", "h", "place", "windows"]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names)

        held, blobs = None, []
        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                blob = decompress(packed.as_buffer())
                if bucket < 0:
                    yield out(_unpack(blob)[0])
                    continue
                if bucket != held and blobs:
                    yield out(repeated_windows(blobs, window))
                    blobs = []
                held = bucket
                blobs.append(blob)
        if blobs:
            yield out(repeated_windows(blobs, window))

    return unpacked


def _rows(documents: DataFrame) -> DataFrame:
    """(id, h, _text): the smallest long for a null id; a hash of the text where ids repeat."""
    rows = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.col("text").cast("string").alias("_text"),
    )
    again = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    h = F.lit(0).cast("long") if again.isEmpty() else F.xxhash64("_text")
    return rows.select("id", h.alias("h"), "_text")


def repeats(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, h, place, windows): runs of windows whose words also start earlier."""
    size = _text_bytes(rows)
    buckets = -(-size // BUCKET_BYTES) or 1
    hot = _hot_minimisers(rows, window, size)
    packed = rows.mapInArrow(_packer(window, buckets, hot.tolist()), "bucket long, packed binary")
    sorted_ = packed.repartition("bucket").sortWithinPartitions("bucket")
    return sorted_.mapInArrow(_unpacker(window), "id long, h long, place long, windows long")


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    compress = zstd.ZstdCompressor(level=LEVEL).compress
    for batch in chunks(batches, "_text"):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        packed = pa.array([compress(t or b"") for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed], ["id", "h", "packed"])


def _kept_words(text: bytes, runs: list[dict], window: int) -> tuple[int, int, bytes]:
    words = text.split()
    if not runs:
        return len(words), 0, b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, [r["place"] for r in runs], 1)
    np.add.at(cover, [r["place"] + r["windows"] + window - 1 for r in runs], -1)
    free = np.cumsum(cover[:-1]) == 0
    return len(words), int((~free).sum()), b" ".join(w for w, f in zip(words, free, strict=True) if f)


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document."""
    rows = _rows(documents)
    runs = repeats(rows, window).groupBy(F.col("id").alias("r_id"), F.col("h").alias("r_h")).agg(
        F.collect_list(F.struct("place", "windows")).alias("runs")
    )
    texts = rows.mapInArrow(_zipped, "id long, h long, packed binary")
    joined = texts.join(runs, (F.col("h") == F.col("r_h")) & (F.col("id") == F.col("r_id")), "left")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstd.ZstdDecompressor().decompress
        for batch in chunks(batches, "packed"):
            found = [
                _kept_words(decompress(t.as_buffer()), r.as_py(), window)
                for t, r in zip(batch.column(2), batch.column(1), strict=True)
            ]
            words, removed, left = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(words, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(left, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "n_removed", "kept"],
            )

    schema = "id long, n_words long, n_removed long, kept string"
    found = joined.select("id", "runs", "packed").mapInArrow(kept, schema)
    doc_id = F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id")
    return found.select(doc_id, "n_words", "n_removed", "kept")


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    """Words of every document, how many of them repeat, and what is left."""
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )
