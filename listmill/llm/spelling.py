"""Spelling variants: words one edit apart, grouped under the most frequent form.

Near words are found by a variable-length gram index. Words get ``PAD`` marks on either side.
The dictionary of grams starts from all of ``SHORTEST`` characters; a gram that is more
frequent than ``SHARE`` of all places is pruned in favour of the longer ones that it
begins, up to ``LONGEST``. It has at most a few thousand frequent grams and those longer by a
character, whatever the number of words, so it is broadcast.

A word is decomposed into the dictionary's grams: at each place the longest, left out if an
earlier gram covers it. Where a gram ends follows from its own characters, so an edit at a place
affects the grams that contain it, and grams behind it that a gram reaching over the
edit, of ``LONGEST`` characters at most, may cover. The largest number of them over all places
is the word's bound: near words share all grams but that many. Merging their lists therefore may begin with
the ``bound + 1`` rarest grams of each word, the short lists; near words meet in one of
them. The gram is before the edit or behind it, so near words also have in common all that is before the
gram, or all behind it, and their lengths differ by one at most: lists are kept by
the gram together with that, and by length. Pairs that meet are verified by their edit distance
inside the join, which AQE splits where a list is long.

Defined cases: null and empty texts have no words; a null ``doc_id`` is written as
nothing before the colon; repeated rows count as often as they are there; very long
runs are words like any other; equally frequent near words: the smaller in
code-point order; no words give no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.llm.common import stored, table

LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form is that many times as frequent as its variant.
FORM_RATIO = 2
# One run in so many loses a character.
DAMAGED = 97

SHORTEST, LONGEST = 2, 4
PAD = 2
SHARE = 1 / 8192

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\x01", "\x02"


def words(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the frequent words of all texts, after the runs' damage."""
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    # shorter runs only get shorter
    pattern = F.lit(f"[a-zÀ-ÿ]{{{least_length},}}")
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, pattern, F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int") + 1
    word = F.when(F.col("h") % DAMAGED == 0, F.overlay("run", F.lit(""), place, F.lit(1))).otherwise(
        F.col("run")
    )
    counts = hashed.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= least_length) & (F.col("n") >= least_count))


def gram_dictionary(found: DataFrame) -> dict[str, tuple[int, bool]]:
    """Frequency of each gram of the dictionary, and whether longer ones replace it."""
    padded = F.concat(F.lit(_START * PAD), "word", F.lit(_END * PAD))
    places = found.select(padded.alias("s")).select("s", F.explode(F.sequence(F.lit(1), F.length("s") - 1)).alias("p"))
    rest = F.length("s") - F.col("p") + 1
    sizes = F.filter(
        F.array(*map(F.lit, range(SHORTEST, LONGEST + 1))), lambda size: size <= rest
    )
    grams = places.select(F.explode(F.transform(sizes, lambda size: F.substring("s", F.col("p"), size))).alias("gram"))
    counts = stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    size = F.length("gram")
    all_places = counts.where(size == SHORTEST).agg(F.sum("n")).first()[0] or 0
    # at most 1 / SHARE of each size
    frequent = counts.where((size < LONGEST) & (F.col("n") > all_places * SHARE))
    begins = frequent.select(F.col("gram").alias("begin"))
    longer = counts.where(size > SHORTEST).join(
        F.broadcast(begins), F.expr("substring(gram, 1, length(gram) - 1)") == F.col("begin"), "left_semi"
    )
    kept = counts.where(size == SHORTEST).unionByName(longer).collect()
    extended = {r["begin"] for r in begins.collect()}
    return {r["gram"]: (r["n"], r["gram"] in extended) for r in kept}


def decompose(word: str, dictionary: dict[str, tuple[int, bool]]) -> list[tuple[int, str]]:
    """Place and gram, without those that an earlier gram covers."""
    s = _START * PAD + word + _END * PAD
    found, covered = [], 0
    for place in range(len(s) - SHORTEST + 1):
        end = place + SHORTEST
        while end - place < LONGEST and end < len(s) and dictionary[s[place:end]][1]:
            end += 1
        if end > covered:
            found.append((place, s[place:end]))
            covered = end
            if end == len(s):
                break
    return found


def affected(grams: list[tuple[int, str]], length: int) -> int:
    """The most grams that one edit of a word of that length can affect."""
    ends = np.array([place + len(gram) for place, gram in grams])
    # an edit at a place, or between it and the next; the first is between the marks and the word
    first, last = PAD - 1, PAD + length - 1
    from_, to = np.clip(ends - LONGEST, first, last + 1), np.clip(ends, first, last + 1)
    steps = np.bincount(from_, minlength=last + 2) - np.bincount(to, minlength=last + 2)
    return int(np.cumsum(steps).max())


def _indexer(dictionary):
    """(word, n) -> the lists that the word is in: its rarest grams with what is on one side."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of = dictionary.value
        for batch in batches:
            rows, keys, sizes = [], [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                found = decompose(word, grams_of)
                most = affected(found, len(word)) + 1
                found.sort(key=lambda g: (grams_of[g[1]][0], g[1], g[0]))
                padded = _START * PAD + word + _END * PAD
                for place, gram in found[:most]:
                    # an edit can only be inside the word
                    if place + len(gram) < len(word) + PAD:
                        keys.append(padded[: place + len(gram)])
                        rows.append(row)
                    if place >= PAD:
                        keys.append(padded[place:])
                        rows.append(row)
                sizes += [len(word)] * (len(rows) - len(sizes))
            rows = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array(sizes, pa.int32()),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                ],
                ["list", "size", "word", "n"],
            )

    return lists


def near_pairs(found: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, once."""
    dictionary = found.sparkSession.sparkContext.broadcast(gram_dictionary(found))
    schema = "list string, size int, word string, n long"
    lists = stored(found.mapInArrow(_indexer(dictionary), schema), "gram-lists")
    key = ["list", "size"]
    others = lists.select(*key, F.col("word").alias("other"), F.col("n").alias("other_n"))
    own = lists.withColumnRenamed("size", "own_size").withColumn(
        "size", F.explode(F.array("own_size", F.col("own_size") + 1))
    )
    once = (F.col("own_size") < F.col("size")) | (F.col("word") < F.col("other"))
    verified = F.levenshtein("word", "other", 1) == 1
    pairs = own.join(others, key).where(once & verified)
    return pairs.select("word", "n", "other", "other_n").dropDuplicates(["word", "other"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last by jumping.

    A form is more frequent by ``FORM_RATIO``, so chains are short and the steps few.
    """
    done = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = done.select(F.col("word").alias("via"), F.col("root").alias("further"))
        step = done.join(next_, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = stored(step, "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        done = step.select("word", "root")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word."""
    found = stored(words(documents), "words")
    pairs = stored(near_pairs(found), "near-words")
    back = pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    best = F.struct(-F.col("other_n"), F.col("other").alias("near"))
    near = pairs.unionByName(back).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(best).alias("best")
    )
    near = near.select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"), "n"
    )
    is_form = F.col("near_n") >= FORM_RATIO * F.col("n")
    near = stored(
        near.select(
            "word",
            "n_near",
            F.when(is_form, F.col("near")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(near.where("form is not null"))
    return (
        found.join(near, "word", "left")
        .join(last, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words and forms."""
    return spelling_variants(table(spark, sf_dir, "documents"))
