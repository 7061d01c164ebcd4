"""URL filter: rules, and gradient-boosted trees where no rule fits.

Trees see lexical features of a URL only: lengths, depth, share of digits, entropy of its
characters, numbers of parameters, hyphens and host labels, and statistics of its
host's suffix over all URLs (how many there are, their mean length, depth and share of digits).
They are trained from labelled URLs, by default those that a rule judges, at most
``TRAIN_ROWS`` different ones of them, drawn by a hash of the URL. Without labels of both kinds there is no
model and the verdict is that of the labels there are, or allow.

Everything is built-in expressions and Spark's own trees.

Defined cases: a null URL, or one without ``://``, has empty host and path and is
judged by the trees as an empty text; repeated rows are judged alike; of rules that fit, the
longest counts; no rows give no rows. Other columns of the input play no part.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill.llm.common import stored, table

# Fixed values: (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
ALLOW, BLOCK = "allow", "block"

TRAIN_ROWS = 20_000
TREES = 20
DEPTH = 4
SEED = 7

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LEXICAL = (
    "length host_length path_length depth digit_share entropy parameters hyphens labels".split()
)
_SUFFIX = "suffix_count suffix_length suffix_depth suffix_digits".split()
FEATURES = (*_LEXICAL, *_SUFFIX)


def _behind_scheme(url: Column) -> Column:
    """Text after the first ``://``, '' without one."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits, or null."""

    def fitting(verdict: str, rule: str) -> Column:
        rule_host, slash, rest = rule.partition("/")
        fits = F.concat(F.lit("."), host).endswith(f".{rule_host}") & path.startswith(slash + rest)
        found = F.struct(
            F.lit(len(rule)).alias("length"),
            F.lit(rule).alias("rule"),
            F.lit(verdict).alias("verdict"),
        )
        return F.when(fits, found)

    return F.array_max(F.array(*[fitting(*rule) for rule in rules]))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits."""
    length = F.length(text)

    def part(char: Column) -> Column:
        share = (length - F.length(F.replace(text, char, F.lit("")))) / length
        return -share * F.log2(share)

    parts = F.transform(F.array_distinct(F.split(text, "")), part)
    return F.when(length > 0, F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, the best rule and the lexical features."""
    rows = pages.select(
        "page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")
    ).select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    url, length = F.col("url"), F.length("url")
    return rows.select(
        "*",
        best_rule(F.col("host"), F.col("path")).alias("best"),
        F.regexp_extract("host", r"[^.]*$", 0).alias("suffix"),
        length.alias("length"),
        F.length("host").alias("host_length"),
        F.length("path").alias("path_length"),
        F.regexp_count("path", F.lit("/")).alias("depth"),
        F.when(length > 0, F.regexp_count(url, F.lit("[0-9]")) / length).otherwise(0.0).alias("digit_share"),
        _entropy(url).alias("entropy"),
        F.regexp_count(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("[^&]+")).alias("parameters"),
        F.regexp_count(url, F.lit("-")).alias("hyphens"),
        F.regexp_count("host", F.lit(r"[^.]+")).alias("labels"),
    )


def with_suffixes(rows: DataFrame) -> DataFrame:
    """Add the statistics of each row's suffix over all rows."""
    statistics = rows.groupBy(F.col("suffix").alias("s")).agg(
        F.log1p(F.count(F.lit(1))).alias("suffix_count"),
        F.avg("length").alias("suffix_length"),
        F.avg("depth").alias("suffix_depth"),
        F.avg("digit_share").alias("suffix_digits"),
    )
    # stored, so that Spark knows its size; one row per suffix
    return rows.join(stored(statistics, "suffixes"), F.col("suffix") == F.col("s")).drop("s")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def train(labelled: DataFrame, most: int = TRAIN_ROWS) -> GBTClassificationModel | str:
    """Trees from rows with the features, ``url`` and ``verdict``, or the only verdict there is."""
    order = F.xxhash64(F.lit(SEED), F.col("url"))
    sample = labelled.select("url", *FEATURES, (F.col("verdict") == BLOCK).cast("double").alias("label"))
    # rows of one URL are alike but for given labels: each label counts once
    sample = sample.dropDuplicates(["url", "label"])
    sample = stored(sample.orderBy(order, "url", "label").limit(most), "url-sample")
    kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        return BLOCK if 1.0 in kinds else ALLOW
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label")
    return trees.fit(_assembled(sample))


def judge(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    rows = with_suffixes(stored(lexical(pages), "urls"))
    ruled = rows.where("best IS NOT NULL").withColumn("verdict", F.col("best.verdict"))
    model = train(ruled)
    if isinstance(model, str):
        judged = rows.withColumn("guess", F.lit(model))
    else:
        # trees look at the rest only
        guess = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
        rest = model.transform(_assembled(rows.where("best IS NULL"))).withColumn("guess", guess)
        known = rows.where("best IS NOT NULL").withColumn("guess", F.lit(None).cast("string"))
        columns = ["page_id", "host", "path", "best", "guess"]
        judged = rest.select(*columns).unionByName(known.select(*columns))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "guess").alias("verdict"),
    )


def op6_urls(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return judge(table(spark, sf_dir, "pages"))
