"""Bronze -> silver: parse the message, take ids from the URL, parse the embedded objects."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from listmill.functions.embedded import (
    PROPERTY,
    SOLD_PROPERTY,
    embedded_json,
    embedded_object,
    has_data_layer,
    parse_message,
)
from listmill.functions.urls import url_key, url_type
from listmill.schemas import CANONICAL_PROPS, FORSALE_PROPS, SOLD_HOME, SOLD_PROPS


@dataclass(frozen=True)
class RefineSpec:
    """What makes one kind of listing: its objects, its output and its keys."""

    target: str
    # column name -> (name of the embedded object, schema)
    objects: Mapping[str, tuple[str, str]]
    # id without which a row is dropped
    required: str
    # output columns as SQL expressions
    output: tuple[str, ...]
    # one row is kept per dedup key; the silver table is updated by merge key
    dedup_key: str
    merge_key: str


_BY_URL = ("ingestion_date", "url", "collected_on", "url_key AS listing_id", "prop_type", "props")

FORSALE = RefineSpec(
    target="forsale",
    objects={"props": (PROPERTY, FORSALE_PROPS)},
    required="props.id",
    output=_BY_URL,
    dedup_key="listing_id",
    merge_key="listing_id",
)

CANONICAL = RefineSpec(
    target="canonical",
    objects={"props": (PROPERTY, CANONICAL_PROPS)},
    required="props.id",
    output=_BY_URL,
    dedup_key="listing_id",
    merge_key="listing_id",
)

# Sold pages have two ids, both from JSON: of the sale and of the home. Rows are
# kept per sale but merged by home; `dataclasses.replace(SOLD, merge_key="sold_id")`
# gives a table with one row per sale instead.
SOLD = RefineSpec(
    target="sold",
    objects={"prop": (PROPERTY, SOLD_HOME), "sold_props": (SOLD_PROPERTY, SOLD_PROPS)},
    required="sold_props.id",
    output=(
        "ingestion_date",
        "url",
        "collected_on",
        "sold_props.id AS sold_id",
        "prop_type",
        "prop.id AS listing_id",
        "sold_props",
    ),
    dedup_key="sold_id",
    merge_key="listing_id",
)

# Why a row is rejected, in the order in which it is tried.
NO_PAGE, NO_DATA_LAYER, NO_OBJECT = "no page", "no data layer", "no object"
NO_ID, WRONG_ID = "no id", "id of another type"
REASONS = (NO_PAGE, NO_DATA_LAYER, NO_OBJECT, NO_ID, WRONG_ID)

SPECS = {spec.target: spec for spec in (FORSALE, SOLD, CANONICAL)}

# Newest first. The date alone ties within one day's batch; with the position in
# the log the choice is the same however the rows are partitioned.
_NEWEST = ("ingestion_date", "collected_on", "offset", "partition", "topic")


def evaluated_once(name: str, value: Column) -> Column:
    """The value as a column that Catalyst computes exactly once.

    A filter on a parsed field is otherwise pushed below the projection together
    with a second copy of the parsing. A generator stops that.
    """
    return F.explode(F.array(value)).alias(name)


def latest_per_key(df: DataFrame, key: str, newest: tuple[str, ...] = _NEWEST) -> DataFrame:
    """One row per key: the first when ordered by ``newest``, all descending.

    Spark keeps only the first row per key of each map task before it shuffles,
    so a hot key arrives as one row per map task.
    """
    order = Window.partitionBy(key).orderBy(*[F.desc(c) for c in newest])
    return df.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def parse_messages(bronze: DataFrame) -> DataFrame:
    """Bronze -> url, page source, collection time, ids of the URL and the log position."""
    parsed = bronze.select(
        "ingestion_date", "offset", "partition", "topic", parse_message(F.col("value")).alias("page")
    )
    return parsed.select(
        "ingestion_date",
        "offset",
        "partition",
        "topic",
        "page.url",
        "page.source",
        F.col("page.timestamp").alias("collected_on"),
        url_key(F.col("page.url")).alias("url_key"),
        url_type(F.col("page.url")).alias("prop_type"),
    )


def _with_objects(messages: DataFrame, spec: RefineSpec, *keep: str) -> DataFrame:
    """The messages' columns but the page source, unless kept, and the struct ``objects``."""
    objects = F.struct(
        *[
            embedded_object(F.col("source"), name, schema).alias(column)
            for column, (name, schema) in spec.objects.items()
        ]
    )
    rest = [c for c in messages.columns if c != "source"]
    return messages.select(*rest, *keep, evaluated_once("objects", objects))


def _listed(spec: RefineSpec) -> Column:
    return F.col(f"objects.{spec.required}").isNotNull()


def parse_objects(messages: DataFrame, spec: RefineSpec) -> DataFrame:
    """Replace the page source by the embedded objects; drop rows without the required id."""
    rest = [c for c in messages.columns if c != "source"]
    return _with_objects(messages, spec).where(_listed(spec)).select(*rest, "objects.*")


def _reason(spec: RefineSpec) -> Column:
    """Why a page has no listing; null if it has one, whose source is not searched again."""
    column, field = spec.required.split(".")
    text = embedded_json(F.col("source"), spec.objects[column][0])
    # any value of the field, as text
    written = F.from_json(text, f"{field} string")[field]
    return F.when(
        ~_listed(spec),
        F.when(F.col("source").isNull(), NO_PAGE)
        .when(~has_data_layer(F.col("source")), NO_DATA_LAYER)
        .when(text == "", NO_OBJECT)
        .when(written.isNull(), NO_ID)
        .otherwise(WRONG_ID),
    )


def rejected(messages: DataFrame, spec: RefineSpec) -> DataFrame:
    """The messages that ``parse_objects`` drops, without the page source, and the ``reason``."""
    rest = [c for c in messages.columns if c != "source"]
    rows = _with_objects(messages, spec, "source").where(~_listed(spec))
    return rows.select(*rest, _reason(spec).alias("reason"))


def refine(bronze: DataFrame, spec: RefineSpec, counted: Observation | None = None) -> DataFrame:
    """Bronze rows -> silver rows of one batch, one per ``dedup_key``.

    ``counted`` gets the number of rejected rows by reason when the rows are computed.
    The sources then pass the parsing, which costs some time.
    """
    position = [c for c in _NEWEST if c not in ("ingestion_date", "collected_on")]
    messages = parse_messages(bronze)
    if counted is None:
        parsed = parse_objects(messages, spec)
    else:
        rest = [c for c in messages.columns if c != "source"]
        rows = _with_objects(messages, spec, "source").withColumn("reason", _reason(spec))
        numbers = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
        parsed = rows.observe(counted, *numbers).where(_listed(spec)).select(*rest, "objects.*")
    rows = parsed.selectExpr(*spec.output, *position)
    return latest_per_key(rows, spec.dedup_key).drop(*position)
