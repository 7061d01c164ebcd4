"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies: its weight times its source's rate,
which is set so that the source's expected words are its target. The whole part of it is
certain. The fraction ``p`` is an inclusion probability: documents of a source are
ranked by ``(U / (1 - U)) / (p / (1 - p))``, the odds of a random number by the odds
of inclusion, and taken from the smallest on until the words that the whole copies
leave open are filled. ``U`` is a hash of seed, document id and text, so reruns agree.

The weight is a column or, without one, comes from the length: from 1 for the shortest
documents to 2 for those of 512 words and more, so that the mix prefers connected text.
Weights count in eighths, from 1/8 to 64, so a source has few different ones, whose
sums give its rate: those that would exceed the most copies allowed get these, the
others divide the rest.

Nothing sorts a whole source: ranks fall into ``BINS`` bins per source, whose sums
tell in which bin the sample ends; that one is divided into ``BINS`` again, and only the
one of these where the sample ends is sorted. What joins the documents is one row per source.

Defined cases: a null source is a source of its own, the last; a null or empty text has size
0; a null id is an id like any other; rows of a source with equal id and text share their
fate; a source without words gets no copies; a null weight is 1; no rows give no rows. Other
columns of the input, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listmill.llm.common import stored, table, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix"

# Bins of the ranks of one source, and of the ranks of one bin.
BINS = 1024
# Words by which the weight rises a step, and steps to a whole.
STEP_WORDS = 64
STEPS = 8
MAX_WEIGHT = 64.0
# 13 hex digits are a whole number that a double holds exactly.
_DIGITS = 13


def random_number(doc_id: Column, text: Column, seed: str) -> Column:
    """Hash of seed, id and text as a number within (0, 1)."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    whole = F.concat_ws(":", F.lit(seed), name, F.md5(F.coalesce(text, F.lit(""))))
    digits = F.conv(F.substring(F.md5(whole), 1, _DIGITS), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(16**_DIGITS))


def source_targets(
    totals: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """Add ``target`` to (source, source_size), one row per source.

    Sources in code point order, null last, have the weights in turn. They divide
    ``share`` times all words by weight, up to ``max_repeats`` times their own each;
    what is over goes to the others by weight. Sorted by own size to weight, the
    sources at their limit come first, which gives the final level in one pass. The
    windows see one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    named = totals.withColumn(
        "place", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    )
    turn = F.array(*map(F.lit, weights))
    rows = named.select(
        "source",
        "source_size",
        "place",
        F.element_at(turn, (F.col("place") - 1) % len(weights) + 1).alias("w"),
        (F.col("source_size") * float(max_repeats)).alias("limit"),
    )
    before = every.orderBy(F.col("limit") / F.col("w"), "place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    words = F.sum("source_size").over(every) * float(share)
    open_words = words - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    rows = rows.withColumn("level", open_words / open_weight).withColumn(
        "sorted", F.row_number().over(every.orderBy(F.col("limit") / F.col("w"), "place"))
    )
    below = F.col("limit") / F.col("w") > F.col("level")
    final = F.min(F.when(below, F.struct("sorted", "level"))).over(every)["level"]
    target = F.when(final.isNull(), F.col("limit")).otherwise(
        F.least("limit", final * F.col("w"))
    )
    return rows.select("source", "source_size", target.alias("target"))


def length_weight(size: Column) -> Column:
    """1 for a document of few words, rising by steps to 2."""
    return 1 + F.least(F.floor(size / STEP_WORDS), F.lit(STEPS)) / STEPS


def source_rates(
    targets: DataFrame, classes: DataFrame, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """Add ``rate`` to (source, source_size, target), from (source, weight, size).

    Sorted by weight, the heaviest first, those of ``max_repeats`` copies come first, and
    the rate is what the target leaves for the words behind them. The windows see the
    different weights of a source.
    """
    rows = classes.join(
        targets.select(F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s"))
    )
    heaviest = Window.partitionBy("source").orderBy(F.desc("weight"))
    most = F.lit(float(max_repeats))
    full = F.coalesce(
        F.sum("size").over(heaviest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    open_ = F.sum(F.col("size") * F.col("weight")).over(
        heaviest.rowsBetween(0, Window.unboundedFollowing)
    )
    level = F.when(open_ > 0, (F.col("target") - most * full) / open_)
    fits = F.col("level") * F.col("weight") <= most
    found = (
        rows.withColumn("level", level)
        .groupBy(F.col("source").alias("s"))
        .agg(
            F.max(F.when(fits, F.struct("weight", "level"))).alias("first"),
            (most / F.min("weight")).alias("all_full"),
        )
    )
    return targets.join(found, F.col("source").eqNullSafe(F.col("s"))).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.coalesce("first.level", "all_full"))
        .otherwise(0.0)
        .alias("rate"),
    )


def _ranked(df: DataFrame, max_repeats: int) -> DataFrame:
    """Add whole copies, rank and bin; the rank is null where nothing is left to chance."""
    expected = F.least(F.col("rate") * F.col("weight"), F.lit(float(max_repeats)))
    whole = F.floor(expected)
    p = expected - whole
    rank = (F.col("draw") / (1 - F.col("draw"))) / (p / (1 - p))
    return df.withColumn("whole", whole).withColumn(
        "rank", F.when(p > 0, rank)
    ).withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * (BINS * BINS)))


def _ends(ranked: DataFrame, bin: Column) -> tuple[DataFrame, DataFrame]:
    """Sums of the bins up to each, and those bins where the words in it reach ``open``.

    ``ranked`` has ``before``, the words in front of its first bin, and ``open``.
    """
    bins = ranked.where("rank IS NOT NULL").groupBy("source", bin.alias("bin")).agg(
        F.sum("size").alias("size"), F.max("before").alias("before"), F.max("open").alias("open")
    )
    until = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("bin"))
    sums = bins.withColumn("until", until).select(
        "source", "bin", "open", (F.col("until") - F.col("size")).alias("before"), "until"
    )
    return sums, sums.where("before < open AND until >= open")


def _within(ranked: DataFrame, ends: DataFrame, bin: Column) -> DataFrame:
    """The rows in their source's last bin, with the words in front of it."""
    last = ends.select(F.col("source").alias("e"), F.col("bin").alias("end"), "before", "open")
    here = F.col("source").eqNullSafe(F.col("e")) & (bin == F.col("end"))
    return ranked.drop("before", "open").join(last, here).drop("e", "end")


def mixing_plan(
    documents: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weight: str | None = None,
    seed: str = SEED,
    max_repeats: int = MAX_REPEATS,
    **shares,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of all documents, and for each source where its sample ends.

    Both are stored: (doc_id, source, size, draw, weight) and (source, source_size,
    target, rate, cut_bin, cut_rank, cut_id). ``weight`` names a positive column that
    makes inclusion unequal within a source, in place of the length.
    """
    size = word_count(F.col(text))
    sizes = stored(
        documents.select(
            F.col(id_column).alias("doc_id"),
            F.col(source).alias("source"),
            size.alias("size"),
            random_number(F.col(id_column), F.col(text), seed).alias("draw"),
            _weight(weight, size).alias("weight"),
        ),
        "mix-sizes",
    )
    classes = stored(
        sizes.groupBy("source", "weight").agg(F.sum("size").alias("size")), "mix-weights"
    )
    totals = classes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, max_repeats=max_repeats, **shares)
    rates = stored(source_rates(targets, classes, max_repeats), "mix-rates")

    ranked = _ranked(_with_source(sizes, rates), max_repeats)
    certain = ranked.groupBy("source").agg(
        (F.max("target") - F.sum(F.col("whole") * F.col("size"))).alias("open")
    )
    certain = stored(certain.withColumn("before", F.lit(0)), "mix-open")
    ranked = _with_source(ranked, certain)
    coarse = F.floor(F.col("bin") / BINS)
    bins, ends = _ends(ranked, coarse)
    full = bins.groupBy("source").agg(F.max(F.col("until") < F.col("open")).alias("all_in"))
    inside = _within(ranked, stored(ends, "mix-bins"), coarse)
    ends = stored(_ends(inside, F.col("bin"))[1], "mix-ends")
    inside = _within(ranked, ends, F.col("bin"))
    of_source = Window.partitionBy("source")
    peers = inside.groupBy("source", "rank", F.col("doc_id").cast("string").alias("id")).agg(
        F.sum("size").alias("size"), F.max("before").alias("before"), F.max("open").alias("open")
    )
    so_far = F.sum("size").over(of_source.orderBy("rank", F.col("id").asc_nulls_first()))
    taken = F.col("before") + so_far - F.col("size") / 2 <= F.col("open")
    last = (
        peers.withColumn("taken", taken)
        .where("taken")
        .groupBy(F.col("source").alias("s"))
        .agg(F.max(F.struct("rank", F.coalesce("id", F.lit("")).alias("id"))).alias("last"))
    )
    cuts = (
        rates.join(
            full.select(F.col("source").alias("f"), "all_in"),
            F.col("source").eqNullSafe(F.col("f")),
            "left",
        )
        .join(
            ends.select(F.col("source").alias("e"), F.col("bin").alias("end_bin")),
            F.col("source").eqNullSafe(F.col("e")),
            "left",
        )
        .join(last, F.col("source").eqNullSafe(F.col("s")), "left")
        .select(
            "source",
            "source_size",
            "target",
            "rate",
            F.coalesce(
                "end_bin", F.when(F.col("all_in"), F.lit(BINS * BINS + 1)).otherwise(F.lit(-1))
            ).alias("cut_bin"),
            F.col("last.rank").alias("cut_rank"),
            F.col("last.id").alias("cut_id"),
        )
    )
    return sizes, stored(cuts, "mix-cuts")


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join one row per source; Spark broadcasts them where their stored size allows."""
    renamed = sources.withColumnRenamed("source", "_s")
    return rows.join(renamed, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def with_copies(sizes: DataFrame, cuts: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``copies``, how often the mix takes each row, and its source's columns.

    ``sizes`` needs doc_id, source, draw and weight.
    """
    ranked = _ranked(_with_source(sizes, cuts), max_repeats)
    here = F.struct("rank", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    end = F.struct(F.col("cut_rank").alias("rank"), F.col("cut_id").alias("id"))
    drawn = (F.col("bin") < F.col("cut_bin")) | (
        (F.col("bin") == F.col("cut_bin")) & F.col("cut_rank").isNotNull() & (here <= end)
    )
    copies = F.col("whole") + F.when(drawn, 1).otherwise(0)
    return ranked.withColumn("copies", copies.cast("int"))


def _weight(name: str | None, size: Column) -> Column:
    if name is None:
        return length_weight(size)
    given = F.coalesce(F.col(name).cast("double"), F.lit(1.0))
    eighths = F.greatest(F.round(given * STEPS) / STEPS, F.lit(1 / STEPS))
    return F.least(eighths, F.lit(MAX_WEIGHT))


def mix(
    documents: DataFrame, seed: str = SEED, weight: str | None = None, **shares
) -> DataFrame:
    """The mixed corpus: the rows of the documents, each as often as it is taken."""
    _, cuts = mixing_plan(documents, seed=seed, weight=weight, **shares)
    rows = documents.select(
        F.struct("*").alias("row"),
        "doc_id",
        "source",
        random_number(F.col("doc_id"), F.col("text"), seed).alias("draw"),
        _weight(weight, word_count(F.col("text"))).alias("weight"),
    )
    taken = with_copies(rows, cuts)
    repeated = taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("n"))
    return repeated.select("row.*")


def op1_mix(spark, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    sizes, cuts = mixing_plan(table(spark, sf_dir, "documents"))
    return with_copies(sizes, cuts).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
