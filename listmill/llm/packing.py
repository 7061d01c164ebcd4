"""Harmonic packing of documents into training sequences of one capacity.

Lengths go into classes by the reciprocals of the capacity: a bin of class ``k`` holds
exactly ``k`` pieces of ``capacity / k`` tokens. A document is cut into such pieces, the
longest that fit first; with the powers of two as ``k`` that is its length in binary, so
nothing of it is left over and full bins have no padding.

Workers need nothing of each other to fill bins: each numbers its own pieces of a class.
The pieces per worker and class, a table of a few numbers per task, tell at which place of the class
a worker's numbers start; place divided by ``k`` is the bin. Only the last bin of each class is not full. What is in it is
laid into sequences of a power of two each, which take no padding either.

Defined cases: a null or empty text is the end id alone; repeated rows and ids are
packed one by one; a very long text is cut like any other; no rows give no rows. Other
columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listmill.llm.common import chunks, stored, table
from listmill.llm.tokens import WordIds, filled, load, read_file, word_encoder

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 2

_CUT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "worker int, per_bin int, place long, ids array<int>"
)


def _with_end(ids: pa.ListArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids, each document's followed by the end id, and where documents end."""
    sizes = pc.list_value_length(ids).to_numpy().astype(np.int64) + 1
    ends = np.cumsum(sizes)
    flat = np.empty(ends[-1] if len(ends) else 0, "<u4")
    own = np.ones(len(flat), bool)
    own[ends - 1] = False
    flat[own] = ids.flatten().to_numpy()
    flat[ends - 1] = end_id
    return flat, ends


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first token and length of each piece; pieces are in the documents' order."""
    lengths = [1 << b for b in reversed(range(capacity.bit_length()))]
    times = np.stack([sizes // capacity, *(sizes // n % 2 for n in lengths[1:])], axis=1)
    document, which = np.divmod(np.repeat(np.arange(times.size), times.ravel()), len(lengths))
    length = np.array(lengths, np.int64)[which]
    running = np.cumsum(length) - length
    first = np.cumsum(sizes) - sizes
    return document, running - first[document], length


def _cutter(vocabulary, capacity: int, end_id: int, keep_ids: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(word_encoder(load(vocabulary.value, special=True), lower=True))
        worker = TaskContext.get().partitionId()
        so_far = dict.fromkeys((1 << b for b in range(capacity.bit_length())), 0)
        for batch in chunks(batches, "_text"):
            ids = words.of_texts(pc.ascii_split_whitespace(filled(batch.column(1))))
            flat, ends = _with_end(ids, end_id)
            sizes = np.diff(ends, prepend=0)
            document, start, length = cut(sizes, capacity)
            place = np.empty(len(length), np.int64)
            for n, count in so_far.items():
                which = np.flatnonzero(length == n)
                place[which] = count + np.arange(len(which))
                so_far[n] += len(which)
            data = memoryview(flat).cast("B")
            stops = np.cumsum(length) * 4
            crcs = [
                zlib.crc32(data[a:b])
                for a, b in zip((stops - length * 4).tolist(), stops.tolist(), strict=True)
            ]
            borders = np.append(0, stops // 4).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(document)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                    pa.array(sizes[document]),
                    pa.array(np.full(len(length), worker, np.int32)),
                    pa.array((capacity // length).astype(np.int32)),
                    pa.array(place),
                    lists if keep_ids else pa.nulls(len(length), lists.type),
                ],
                [part.split()[0] for part in _CUT.split(", ")],
            )

    return pieces


def _highest_bit(number: Column) -> Column:
    return F.length(F.bin(number)) - 1


def _bins(pieces: DataFrame) -> DataFrame:
    """The pieces with ``sequence_id``, gapless over all classes, and ``offset``."""
    counts = pieces.groupBy("worker", "per_bin").agg(F.count(F.lit(1)).alias("n"))
    # a row per class
    totals = {r["per_bin"]: r["n"] for r in counts.groupBy("per_bin").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    first_bin, bins = [], 0
    for k, n in sorted(totals.items()):
        first_bin += [F.lit(k), F.lit(bins).cast("long")]
        bins += n // k + (n % k).bit_count()
    all_of = [F.lit(x) for k, n in totals.items() for x in (k, F.lit(n).cast("long"))]
    before = Window.partitionBy("per_bin").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "worker", "per_bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    k, total = F.col("per_bin"), F.create_map(*all_of)[F.col("per_bin")]
    at = F.col("first") + F.col("place")
    full, rest = F.floor(total / k), total % k
    # the pieces behind the last full bin: a sequence per bit of their number, high bits first;
    # a place differs from that number first in the bit whose sequence it is in
    behind = at - full * k
    bit = _highest_bit(behind.bitwiseXOR(rest))
    above = F.call_function("shiftright", rest, bit + 1)
    in_full = at < full * k
    number = F.when(in_full, F.floor(at / k)).otherwise(full + F.bit_count(above))
    slot = F.when(in_full, at % k).otherwise(behind - F.call_function("shiftleft", above, bit + 1))
    return (
        pieces.join(starts, ["worker", "per_bin"])
        .withColumn("sequence_id", (F.create_map(*first_bin)[k] + number).cast("long"))
        .withColumn("offset", (slot * F.col("length")).cast("long"))
    )


def pack(
    documents: DataFrame,
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of every piece.

    ``ids`` is null unless they are to be kept. ``capacity`` is a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity has to be a power of two")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text")
    )
    file = documents.sparkSession.sparkContext.broadcast(read_file(vocabulary))
    pieces = stored(rows.mapInArrow(_cutter(file, capacity, end_id, keep_ids), _CUT), "packed")
    return _bins(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces with ids: at most a capacity of them in a group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )


def op12_pack(spark, sf_dir: str) -> DataFrame:
    """Pieces of every document and the sequences they are in."""
    return pack(table(spark, sf_dir, "documents")).drop("ids")
