"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on ordinary and on toxic text. A text is cut
into windows of ``WINDOW`` words, each compressed with both; what the toxic dictionary
saves, in bytes, is the window's distance. Shares of windows beyond thresholds, the
mean and the largest distance go through a logistic calibration to a score.

Both dictionaries come from zstandard's trainer, and both end with the one of ordinary windows, so
ordinary text costs the same with either. The toxic one is trained on the parts of
words of toxic texts that set them apart: stretches of byte sequences that are ``GRAM_RATIO`` times as
frequent in toxic texts as in ordinary ones. How many texts such a sequence has to be in is not set:
training is repeated with ``LEAST`` and its doubles, fewer and surer parts each time, and the pair
of dictionaries stays whose calibrated scores tell the other half of the sample apart best.
Each label's sample is halved: one half trains the dictionaries, the other
the calibration, so that neither sees texts it was made from.

Fitted on a bounded sample: at most ``SAMPLE`` labelled rows of either label, and of
each at most ``SAMPLE_WINDOWS`` windows, evenly spread over its text. Every window of
every text is scored.

Defined cases: a null or empty text has no windows and gets the score of no distance;
repeated rows are scored alike; a document labelled twice counts as toxic if any label
says so; null labels are no labels; very long texts are scored window by window like others.
Without rows of both labels, or where toxic texts have nothing in common that ordinary
ones lack, nothing can be told: all scores are 0, so no document is dropped. No rows give no
rows. Other columns play no part.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.common import chunks, table

WINDOW = 8
SAMPLE = {1: 1500, 0: 3000}
SAMPLE_WINDOWS = 200
THRESHOLD = 0.3

# Size of either dictionary.
DICTIONARY_BYTES = 8192
# Length of the byte sequences that set toxic words apart, how many times as frequent as in
# ordinary texts they are, and the least number of toxic texts to begin with.
GRAM = 5
GRAM_RATIO = 20
LEAST = 3

# Distances in bytes beyond which windows are counted.
STEPS = (1, 2, 3, 5)

_PUNCTUATION = b""".,;:!?*#$%&|"'()"""


def windows(text: bytes, most: int | None = None) -> list[bytes]:
    """Windows of lower-cased words with single spaces around and between them.

    With ``most``, at most that many of them, evenly spread over the text.
    """
    words = text.lower().split()
    starts = range(0, len(words), WINDOW)
    if most is not None and len(starts) > most:
        starts = [starts[i * len(starts) // most] for i in range(most)]
    return [b" %b " % b" ".join(words[i : i + WINDOW]) for i in starts]


def _word_grams(windows_: list[bytes]) -> tuple[set[bytes], set[bytes]]:
    """The words, spaced, and the byte sequences within them."""
    words = {b" %b " % w.strip(_PUNCTUATION) for one in windows_ for w in one.split()}
    return words, {w[i : i + GRAM] for w in words for i in range(len(w) - GRAM + 1)}


def toxic_parts(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Iterator[list[bytes]]:
    """Parts of words that set toxic texts apart, for rising numbers of texts they have to be in."""
    words, with_gram, without = [], Counter(), Counter()
    for text in toxic:
        own, grams = _word_grams(text)
        words.append(own)
        with_gram.update(grams)
    for text in ordinary:
        without.update(_word_grams(text)[1])
    share = GRAM_RATIO * len(toxic) / max(len(ordinary), 1)
    marked = {gram: n for gram, n in with_gram.items() if n >= share * without[gram]}
    least = LEAST
    while parts := {part for own in words for word in own for part in _marked_parts(word, marked, least)}:
        yield sorted(parts)
        least *= 2


def _marked_parts(word: bytes, marked: dict[bytes, int], least: int) -> Iterator[bytes]:
    """Stretches of the word in which every byte sequence is marked in so many texts."""
    start = None
    for i in range(len(word) - GRAM + 2):
        if marked.get(word[i : i + GRAM], 0) >= least:
            start = i if start is None else start
        elif start is not None:
            yield word[start : i + GRAM - 1]
            start = None


def _trained(samples: list[bytes], k: int) -> bytes:
    """The content that zstandard's trainer picks from the samples, in segments of ``k`` bytes."""
    try:
        trained = zstd.train_dictionary(DICTIONARY_BYTES + 2048, samples, k=k, d=6, level=3)
    except zstd.ZstdError:  # too few samples to train on
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]
    return trained.as_bytes()[-DICTIONARY_BYTES:]


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    parameters = zstd.ZstdCompressionParameters(
        compression_level=3,
        window_log=17,
        hash_log=14,
        chain_log=14,
        search_log=4,
        min_match=GRAM,
        strategy=zstd.STRATEGY_GREEDY,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    dictionary = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    return zstd.ZstdCompressor(compression_params=parameters, dict_data=dictionary)


@dataclass
class Model:
    """Both dictionaries and the calibration; a few kilobytes."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: list[float] = field(default_factory=list)
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Compressors of a model, made once per task."""

    def __init__(self, model: Model):
        self.model = model
        self.ordinary = _compressor(model.ordinary).compress if model.ordinary else None
        self.toxic = _compressor(model.toxic + model.ordinary).compress if model.toxic else None

    def features(self, parts: list[bytes]) -> list[float]:
        """Shares of windows beyond the steps, mean and largest distance."""
        if not parts or self.ordinary is None or self.toxic is None:
            return [0.0] * (len(STEPS) + 3)
        saved = np.array([len(self.ordinary(w)) - len(self.toxic(w)) for w in parts])
        shares = [float((saved >= s).mean()) for s in STEPS]
        most = float(saved.max())
        return [*shares, float(saved.clip(-2, 8).mean()), most, most / (1 + np.log(len(parts)))]

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        model = self.model
        if not model.weights:
            return np.zeros(len(rows))
        x = (np.array(rows) - model.mean) / model.scale
        z = np.concatenate([np.ones((len(rows), 1)), x], axis=1) @ np.array(model.weights)
        return 1 / (1 + np.exp(-z.clip(-30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the intercept first, by Newton steps."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    penalty = np.diag([0.0, *[ridge] * (x.shape[1] - 1)])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        slope = x.T @ (p - y) + penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: list[tuple[int, list[bytes]]], counts: dict[int, int]) -> Model:
    """Model from (label, windows) rows; ``counts`` are the labels' numbers of all rows."""
    rows = {label: [w for y, w in sample if y == label] for label in (0, 1)}
    if min(len(rows[0]), len(rows[1])) < 2:
        return Model()
    ordinary = _trained([w for text in rows[0][::2] for w in text], k=24)
    y = np.array([label for label in (0, 1) for _ in rows[label][1::2]])
    # the sample has the labels in other numbers than the labelled rows
    shift = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    best, least_loss = Model(), np.inf
    for parts in toxic_parts(rows[1][::2], rows[0][::2]):
        # twice, as the trainer looks for what samples have in common
        toxic = _trained([b" %b " % part for _ in range(2) for part in parts], k=16)
        model = Model(ordinary, toxic)
        scorer = model.scorer()
        x = np.array([scorer.features(w) for label in (0, 1) for w in rows[label][1::2]])
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - mean) / scale
        weights = fit_logistic(x, y)
        z = weights[0] + x @ weights[1:]
        loss = float(np.logaddexp(0, np.where(y == 1, -z, z)).mean())
        if loss < least_loss:
            weights[0] += shift
            model.mean, model.scale, model.weights = mean.tolist(), scale.tolist(), weights.tolist()
            best, least_loss = model, loss
    return best


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on a sample of the labelled documents that are not held out."""
    spark = documents.sparkSession
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    chosen = []
    for label, most in SAMPLE.items():
        rows = known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(most)
        chosen += [(r["doc_id"], label) for r in rows.collect()]
    if not chosen:
        return fit([], counts)
    ids = spark.createDataFrame(chosen, known.schema)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("_text")).join(
        F.broadcast(ids), "doc_id"  # bounded by SAMPLE
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            parts = [
                windows(t or b"", SAMPLE_WINDOWS)
                for t in batch.column(1).cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(parts, pa.list_(pa.binary()))],
                ["doc_id", "toxic", "parts"],
            )

    texts = texts.select("doc_id", "_text", "toxic")
    schema = texts.select("doc_id", "toxic").schema.add("parts", T.ArrayType(T.BinaryType()))
    rows = texts.mapInArrow(cut, schema).dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: (r["toxic"], str(r["doc_id"])))
    random.Random(0).shuffle(rows)
    return fit([(r["toxic"], [bytes(p) for p in r["parts"]]) for r in rows], counts)


def score(documents: DataFrame, model: Model, *keep: Column) -> DataFrame:
    """The columns ``keep`` and ``score`` for every document."""
    rows = documents.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = rows.drop("_text").schema.add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in chunks(batches, "_text"):
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            found = scorer.scores([scorer.features(windows(t or b"")) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64())],
                [*batch.schema.names[:-1], "score"],
            )

    return rows.mapInArrow(scored, schema)


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, scored where they are read."""
    model = train(documents, labels)
    scored = score(documents, model, F.struct("*").alias("row"))
    return scored.where(F.col("score") < threshold).select("row.*")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document."""
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, train(documents, table(spark, sf_dir, "labels")), F.col("doc_id"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
