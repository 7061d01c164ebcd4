"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A text is encoded by a byte-level vocabulary (A) and by a SentencePiece model (B); both
token lists spell the same bytes, a space and the text. A link is a pair of an A and a B
token whose byte ranges overlap; a group ends where tokens of both end.

Each piece of the table is aligned in Arrow alone. The lists are flattened, parent
indices say which document a token is of, cumulative sums of the tokens' byte lengths, less
what the documents before take, give each token's end. A full outer hash join on
(document, end) brings the ends of both sides together: every row of it, in order, is a link, as
the stretch between two ends lies in one token of each side; rows with both tokens end a group.
``Table.group_by`` counts the piece's links per pair of ids, and Spark merges the counts.

Counts come back to a piece by a join on its distinct pairs, some thousands for the
millions of its links, so neither links nor counts are broadcast. The best counts per B
id are: their number is at most the size of B's vocabulary.

Defined cases: a text that is null, empty, or not spelled by the tokens of either side
has no tokens and a row of zeros; repeated rows and ids are rows of their own, and count
as often as they are there; very long texts are a piece of their own; no rows give no rows.
Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from listmill.llm.common import chunks, stored, table
from listmill.llm.tokens import WordIds, Words, byte_letters, filled, load, read_file, word_encoder

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
PIECE_BYTES = 1 << 19

# SentencePiece writes a space so.
_SPACE = "▁"
# A space that a run of white space, or the text's border, may tie to its neighbours.
_TIED = r"^ | $|  |[\s\x0b\x{85}\p{Z}] [\s\x0b\x{85}\p{Z}]"

_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
_PIECE = (
    f"piece long, documents array<struct<{_COLUMNS}>>, a array<int>, b array<int>, n array<long>, uses binary"
)


class Alignment(NamedTuple):
    """Per document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), and the
    links of all documents per pair of ids (a, b, links, best)."""

    documents: DataFrame
    pairs: DataFrame


def _id_texts(vocabulary: dict[str, int], spell) -> pa.Array:
    """What each id spells; ids not in use spell nothing."""
    texts = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        texts[i] = spell(token)
    return pa.array(texts, pa.binary())


def _joined(texts: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of texts fresh from ``take``, one behind the other, and their borders."""
    borders = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.binary_length(texts).to_numpy(), out=borders[1:])
    return texts.buffers()[2] or pa.py_buffer(b""), borders


class _Side:
    """One tokenizer: ids of texts, and the bytes of ids."""

    def __init__(self, words: WordIds, whole, texts: pa.Array):
        self.words, self.whole, self.texts = words, whole, texts
        self.sizes = pc.cast(pc.binary_length(texts), pa.int64())

    def ids(self, texts: pa.Array, tied: pa.Array, words: Words) -> pa.ListArray:
        """By words where spaces stand alone, else by whole texts, which are empty in ``words``."""
        by_word = self.words.of_texts(words)
        which = np.flatnonzero(tied.to_numpy(zero_copy_only=False))
        if not len(which):
            return by_word
        whole = pa.array(self.whole(texts.take(which).to_pylist()), by_word.type)
        place = np.arange(len(texts))
        place[which] = len(texts) + np.arange(len(which))
        return pa.concat_arrays([by_word, whole]).take(pa.array(place))

    def spelled(self, ids: pa.ListArray) -> pa.LargeBinaryArray:
        """The joined bytes of each list."""
        data, borders = _joined(self.texts.take(ids.flatten()))
        own = pa.py_buffer(borders[np.asarray(ids.offsets)])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, own, data])

    def ends(self, ids: pa.ListArray, name: str) -> pa.Table:
        """(end, id, token): where tokens end, as document and bytes in it."""
        flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
        running = pc.cumulative_sum(self.sizes.take(flat))
        before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(ids.offsets[:-1])
        end = pc.subtract(running, before.take(parent))
        key = pc.add(pc.shift_left(pc.cast(parent, pa.int64()), 32), end)
        token = pa.array(np.arange(len(flat)))
        return pa.table([key, flat, token], ["end", name, f"{name}_token"])


def byte_level_side(data: bytes) -> _Side:
    tokenizer = load(data, special=False)
    letters = {c: b for b, c in byte_letters().items()}

    def spell(token: str) -> bytes:
        return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

    def whole(texts: list[str]) -> list[list[int]]:
        found = tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    texts = _id_texts(tokenizer.get_vocab(), spell)
    return _Side(WordIds(word_encoder(tokenizer, " ")), whole, texts)


def piece_side(data: bytes) -> _Side:
    model = SentencePieceProcessor(model_proto=data)
    pieces = [model.id_to_piece(i) for i in range(model.piece_size())]
    if any(_SPACE in piece.lstrip(_SPACE) for piece in pieces):
        raise ValueError("pieces of this model go on behind a space: texts cannot be cut there")

    def spell(piece: str) -> bytes:
        if model.is_byte(model.piece_to_id(piece)):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(_SPACE, " ").encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    texts = _id_texts({p: i for i, p in enumerate(pieces)}, spell)
    return _Side(WordIds(encode), encode, texts)


def _marked_numbers(most: int) -> pa.Array:
    """The decimal numbers below ``most``, each before a comma, a bar and a semicolon."""
    return pa.array([f"{i}{mark}" for i in range(most) for mark in ",|;"], pa.large_binary())


@lru_cache(maxsize=1)
def _sides(byte_level: bytes, pieces: bytes) -> tuple[_Side, _Side, pa.Array]:
    """Both sides and the marked numbers of their ids, loaded once in a worker, not in each task:
    freed tokenizers leave holes, so a worker would grow with its tasks."""
    a_side, b_side = byte_level_side(byte_level), piece_side(pieces)
    return a_side, b_side, _marked_numbers(max(len(a_side.texts), len(b_side.texts)))


def _group_texts(
    a: pa.Table, b: pa.Table, last_a: np.ndarray, last_b: np.ndarray, whose: np.ndarray, numbers: pa.Array
) -> tuple[memoryview, np.ndarray]:
    """All ``a1,a2|b1;a3|b2,b3`` joined, and where each document's ends, a comma behind it.

    ``last_a`` and ``last_b`` are the tokens that end each group, ``whose`` its document.
    """
    places = np.empty(a.num_rows + b.num_rows, np.int64)
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    at_a = np.arange(a.num_rows) + np.repeat(last_b - size_b + 1, size_a)
    at_b = np.arange(b.num_rows) + np.repeat(last_a + 1, size_b)
    ids_a, ids_b = a.column(1).to_numpy(), b.column(1).to_numpy()
    places[at_a], places[at_b] = ids_a * 3, ids_b * 3
    places[at_a[last_a]] += 1
    final = np.diff(whose, append=-1) != 0
    places[at_b[last_b]] += np.where(final, 0, 2)
    data, borders = _joined(numbers.take(pa.array(places)))
    return memoryview(data), borders[at_b[last_b[final]] + 1]


def _aligned(texts: pa.Array, a_side: _Side, b_side: _Side, numbers: pa.Array, digest: bool):
    """Columns of the documents, the piece's pairs with their counts, and who uses which."""
    texts = filled(texts)
    tied = pc.match_substring_regex(texts, _TIED)
    expected = pc.cast(pc.binary_join_element_wise("", texts, " "), pa.large_binary())
    words = Words.of(pc.split_pattern(pc.if_else(tied, "", texts), " "))
    a_ids, b_ids = a_side.ids(texts, tied, words), b_side.ids(texts, tied, words)
    good = pc.and_(
        pc.equal(a_side.spelled(a_ids), expected), pc.equal(b_side.spelled(b_ids), expected)
    )
    good = pc.and_(good, pc.not_equal(texts, ""))
    rows = np.flatnonzero(good.to_numpy(zero_copy_only=False))
    a_ids, b_ids = a_ids.take(rows), b_ids.take(rows)
    a, b = a_side.ends(a_ids, "a"), b_side.ends(b_ids, "b")
    links = a.join(b, "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    document = pc.shift_right(links["end"], 32).to_numpy()
    shared = pc.and_(links["a"].is_valid(), links["b"].is_valid())
    groups = links.filter(shared)
    whose = pc.shift_right(groups["end"], 32).to_numpy()
    # bytes between two ends lie in the tokens that end next; a document's end is on both sides
    pair = pc.add(
        pc.shift_left(pc.cast(pc.fill_null_backward(links["a"]), pa.int64()), 32),
        pc.cast(pc.fill_null_backward(links["b"]), pa.int64()),
    )
    pair = pair.combine_chunks().dictionary_encode()
    pairs = pa.table({"pair": pair.indices}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
    pairs = pairs.sort_by("pair")
    uses = pa.table({"document": pa.array(rows[document], pa.int32()), "pair": pair.indices})
    uses = uses.group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")])
    data, ends = _group_texts(
        a, b, groups["a_token"].to_numpy(), groups["b_token"].to_numpy(), whose, numbers
    )
    written = [""] * len(texts)
    start = 0
    for row, end in zip(rows.tolist(), ends.tolist(), strict=True):
        part = data[start : end - 1]
        written[row] = hashlib.sha256(part).hexdigest() if digest else str(part, "ascii")
        start = end

    def per_row(values: np.ndarray) -> pa.Array:
        full = np.zeros(len(texts), np.int64)
        full[rows] = values
        return pa.array(full)

    columns = [
        per_row(pc.list_value_length(a_ids).to_numpy()),
        per_row(pc.list_value_length(b_ids).to_numpy()),
        per_row(np.bincount(whose, minlength=len(rows))),
        per_row(np.bincount(document, minlength=len(rows))),
        pa.array(written),
    ]
    return columns, pair.dictionary, pairs["pair_count"], uses


def _zipped(uses: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, uses.schema, options=options) as out:
        out.write_table(uses)
    return sink.getvalue().to_pybytes()


def _piece_lists(values, kind: pa.DataType) -> pa.ListArray:
    """A single list with all the values."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def _pieces(rows: DataFrame, byte_level: str, pieces: str, digest: bool) -> DataFrame:
    """A row per piece of the table with all that its alignment yields."""
    context = rows.sparkSession.sparkContext
    models = context.broadcast((read_file(byte_level), read_file(pieces)))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side, numbers = _sides(*models.value)
        piece = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, "_text", PIECE_BYTES):
            columns, distinct, n, uses = _aligned(batch.column(1), a_side, b_side, numbers, digest)
            documents = pa.StructArray.from_arrays([batch.column(0), *columns], names)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([piece]),
                    _piece_lists(documents, documents.type),
                    _piece_lists(pc.shift_right(distinct, 32), pa.int32()),
                    _piece_lists(pc.bit_wise_and(distinct, 0xFFFFFFFF), pa.int32()),
                    _piece_lists(n, pa.int64()),
                    pa.array([_zipped(uses)], pa.binary()),
                ],
                ["piece", "documents", "a", "b", "n", "uses"],
            )
            piece += 1
            # a worker keeps nothing of a piece while it waits for the next
            del columns, distinct, n, uses, documents
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(aligned, _PIECE)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(documents, uses, counts of the piece's pairs in their order) -> documents with sums."""
    for batch in batches:
        for i in range(batch.num_rows):
            documents = batch.column(0).slice(i, 1).flatten()
            counts = batch.column(2).slice(i, 1).flatten()
            uses = pa.ipc.open_stream(batch.column(1)[i].as_buffer()).read_all()
            links, best = (counts.field(k).take(uses["pair"].combine_chunks()) for k in (1, 2))
            times = uses["count_all"].combine_chunks()
            sums = (
                pa.table(
                    {
                        "document": uses["document"],
                        "best": pc.multiply(times, pc.cast(best, pa.int64())),
                        "sum": pc.multiply(times, links),
                    }
                )
                .group_by("document", use_threads=False)
                .aggregate([("best", "sum"), ("sum", "sum")])
            )
            full = np.zeros((2, len(documents)), np.int64)
            full[:, sums["document"].to_numpy()] = sums["best_sum"], sums["sum_sum"]
            yield pa.RecordBatch.from_arrays(
                [*documents.flatten(), pa.array(full[0]), pa.array(full[1])],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"],
            )


def align(
    documents: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, digest: bool = False
) -> Alignment:
    """Align every document. ``groups`` holds the ids of each group in order, as
    ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text")
    )
    table_ = stored(_pieces(rows, byte_level, pieces, digest), "aligned")
    asked = table_.select("piece", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "pair"))
    asked = asked.select("piece", "place", "pair.*")
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("links"))
    counts = stored(counts, "aligned-pairs")
    # a row per id of B's vocabulary
    most = F.broadcast(counts.groupBy("b").agg(F.max("links").alias("most")))
    pairs = counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))
    answers = asked.drop("n").join(pairs, ["a", "b"]).groupBy("piece").agg(
        F.sort_array(F.collect_list(F.struct("place", "links", "best"))).alias("counts")
    )
    # a piece without pairs gets no answer
    none = F.array().cast("array<struct<place:int,links:long,best:boolean>>")
    joined = table_.select("piece", "documents", "uses").join(answers, "piece", "left")
    joined = joined.select("documents", "uses", F.coalesce("counts", none).alias("counts"))
    return Alignment(joined.mapInArrow(_scored, f"{_COLUMNS}, n_best long, count_sum long"), pairs)


def op11_align(spark, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document."""
    found = align(table(spark, sf_dir, "documents"), digest=True).documents
    return found.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )
