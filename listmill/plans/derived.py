"""Logs and listing pages that Spark derives from the test tables.

Every line item becomes the page of a listing and a record of the listing log;
every event becomes a record of the topic log. Page objects are built from the
SQL expressions below, which Spark and the oracle both understand: Spark goes
through HTML and JSON with them, the oracle evaluates them directly.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

LISTING_TOPIC = "listings"

# Two days of ingestion: lines shipped before the split arrived on the first.
SPLIT = dt.date(1998, 6, 1)
DAY_1 = dt.date(2024, 1, 1)
DAY_2 = dt.date(2024, 1, 2)

LISTING_URL = "https://www.example.org/bostad/"

LOCATIONS = {
    "country": "'se'",
    "county": "concat('county-', CAST(l_suppkey AS STRING))",
    "municipality": "concat('kommun-', CAST(l_partkey AS STRING))",
    "postal_city": "CASE WHEN l_linestatus = 'O' THEN 'Åkarp' END",
    "street": "concat('Gata \"', CAST(l_linenumber AS STRING), '\"')",
    "city": "concat('city', chr(92), l_returnflag)",
    "district": "l_linestatus",
}

# Field -> expression; a pair where the parsed value differs from what the page says.
FORSALE = {
    "id": ("l_orderkey", "TRY_CAST(l_orderkey AS INT)"),
    "broker_firm": "concat('firm-', CAST(l_suppkey AS STRING))",
    "broker_agency_id": ("l_suppkey", "TRY_CAST(l_suppkey AS INT)"),
    "location": "concat('place ', CAST(l_partkey AS STRING))",
    "locations": LOCATIONS,
    "new_production": "l_linestatus = 'O'",
    "offers_selling_price": "l_discount > 0.05",
    "status": "CASE WHEN l_returnflag = 'N' THEN 'for_sale' ELSE 'upcoming' END",
    "housing_form": "concat('form-', l_returnflag)",
    "tenure": "CASE WHEN l_tax > 0.04 THEN 'Äganderätt' ELSE 'Bostadsrätt' END",
    "street_address": "concat('Storgatan ', CAST(l_linenumber AS STRING))",
    "rooms": "l_quantity",
    "living_area": "l_extendedprice",
    "supplemental_area": "l_discount",
    "land_area": "l_tax",
    "driftkostnad": ("l_partkey", "TRY_CAST(l_partkey AS INT)"),
    "price": "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "has_price_change": "l_tax > 0.02",
    "upcoming_open_houses": "l_linenumber > 3",
    "bidding": "l_tax > 0.01",
    "has_floorplan": "l_quantity > 25",
    "publication_date": "CASE WHEN l_linestatus = 'O' THEN 'today' END",
    "construction_year": ("l_partkey", "CAST(l_partkey AS STRING)"),
    "callout": "CASE WHEN l_returnflag = 'A' THEN 'Ny!' END",
    "amenities": ["'balcony'", "concat('lift-', CAST(l_linenumber AS STRING))"],
    "water_distance": ("l_partkey", "CASE WHEN l_linenumber <> 6 THEN l_partkey END"),
}

CANONICAL = {
    "id": ("l_orderkey", "TRY_CAST(l_orderkey AS INT)"),
    "broker_firm": "concat('firm-', CAST(l_suppkey AS STRING))",
    "broker_agency_id": ("l_suppkey", "TRY_CAST(l_suppkey AS INT)"),
    "location": "concat('place ', CAST(l_partkey AS STRING))",
    "locations": LOCATIONS,
    "offers_selling_price": "l_discount > 0.05",
    "status": "CASE WHEN l_returnflag = 'N' THEN 'expired' ELSE 'sold' END",
    "housing_form": "concat('form-', l_returnflag)",
    "street_address": "concat('Storgatan ', CAST(l_linenumber AS STRING))",
    "borattavgift": ("l_partkey", "TRY_CAST(l_partkey AS INT)"),
    "upcoming_open_houses": "l_linenumber > 3",
    "long_description": "l_quantity > 25",
    "has_floorplan": "l_tax > 0.01",
    "amenities": ["'balcony'", "concat('lift-', CAST(l_linenumber AS STRING))"],
}

SOLD = {
    "id": "CAST(l_orderkey AS BIGINT)",
    "broker_agency": "concat('agency-', CAST(l_suppkey AS STRING))",
    "broker_agency_id": ("l_suppkey", "TRY_CAST(l_suppkey AS INT)"),
    "location": "concat('place ', CAST(l_partkey AS STRING))",
    "locations": LOCATIONS,
    "street_address": "concat('Storgatan ', CAST(l_linenumber AS STRING))",
    "price": "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "selling_price": "CAST(round(l_extendedprice * 90) AS BIGINT)",
    "rooms": ("l_quantity", "CAST(l_quantity AS STRING)"),
    "living_area": "CAST(l_partkey AS STRING)",
    "sold_at_date": "CASE WHEN l_linestatus = 'F' THEN 'yesterday' END",
}

PROP_TYPE = "CASE l_returnflag WHEN 'A' THEN 'villa' WHEN 'R' THEN 'radhus' ELSE 'tomt' END"

# Which pages are broken, and how. None of these yields a listing:
NO_DATA_LAYER = "l_linenumber = 7"
ID_IS_TEXT = "l_quantity = 50"
OBJECT_ON_TWO_LINES = "l_quantity = 1"
BROKEN = f"({NO_DATA_LAYER} OR {ID_IS_TEXT} OR {OBJECT_ON_TWO_LINES})"
# Nor does an id that the object's schema cannot hold.
HAS_INT_ID = "TRY_CAST(l_orderkey AS INT) IS NOT NULL"
# These do not matter: other keys after the object, a line break before the bracket.
TRAILING_KEYS = "l_returnflag = 'N'"
BREAK_BEFORE_BRACKET = "l_discount = 0"
# A field of the wrong type, which is null where the page says it, and nothing else is.
DISTANCE_IS_FRACTION = "l_linenumber = 6"
# A sold page without the object of the home.
NO_HOME = "l_returnflag = 'R'"

# Key of an order in an upsert batch: lines have no key this high.
ORDER_KEY = "CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1000000000000 ELSE o_orderkey END"

# Position of a line's record in the listing log: later ship dates come later.
DAYS = "datediff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE))"
PARTITION = "CAST(l_suppkey % 4 AS INT)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tasks that build pages, which takes far longer than reading the lines does: so many at least, and
# more where a task would get more lines than it can sort as pages in its share of memory.
PAGE_TASKS = 32
PAGE_LINES = 1 << 18


def json_column(fields: dict) -> Column:
    """Struct of the fields as the page says them."""

    def said(value) -> Column:
        if isinstance(value, dict):
            return json_column(value)
        if isinstance(value, list):
            return F.array(*map(F.expr, value))
        return F.expr(value[0] if isinstance(value, tuple) else value)

    return F.struct(*[said(value).alias(name) for name, value in fields.items()])


def _object_text(fields: dict) -> Column:
    """JSON text of the object; the fields that some pages get wrong come first."""
    rest = {k: v for k, v in fields.items() if k not in ("id", "water_distance")}
    text = [
        F.when(F.expr(OBJECT_ON_TWO_LINES), F.lit('{\n"id":')).otherwise(F.lit('{"id":')),
        F.when(F.expr(ID_IS_TEXT), F.lit('"n/a"')).otherwise(F.col("l_orderkey").cast("string")),
    ]
    if "water_distance" in fields:
        fraction = F.when(F.expr(DISTANCE_IS_FRACTION), F.lit(".5")).otherwise(F.lit(""))
        text += [F.lit(',"water_distance":'), F.col("l_partkey").cast("string"), fraction]
    return F.concat(*text, F.lit(","), F.ltrim(F.to_json(json_column(rest)), F.lit("{")))


def _data_layer(objects: Column) -> Column:
    start = F.when(F.expr(BREAK_BEFORE_BRACKET), F.lit("dataLayer =\n  [")).otherwise(
        F.lit("dataLayer = [")
    )
    end = F.when(F.expr(TRAILING_KEYS), F.lit(',"user":{"login":false}}];')).otherwise(F.lit("}];"))
    script = F.concat(start, F.lit('{"page":"listing",'), objects, end)
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html><head><meta charset="utf-8"><script>\n'),
        F.when(F.expr(NO_DATA_LAYER), F.lit("var x = 1;")).otherwise(script),
        F.lit("\n</script></head>\n<body><h1>"),
        F.expr("concat('Listing ', l_orderkey)"),
        F.lit("</h1></body></html>"),
    )


def _named(name: str, fields: dict) -> Column:
    return F.concat(F.lit(f'"{name}":'), _object_text(fields))


def page_source(target: str) -> Column:
    """HTML of a line item's listing page."""
    if target == "sold":
        home = F.when(F.expr(NO_HOME), F.lit("")).otherwise(
            F.expr("""concat('"property":{"id":', l_orderkey, ',"k":"v"},')""")
        )
        return _data_layer(F.concat(home, _named("sold_property", SOLD)))
    return _data_layer(_named("property", {"forsale": FORSALE, "canonical": CANONICAL}[target]))


def listing_url() -> Column:
    return F.expr(f"concat('{LISTING_URL}', {PROP_TYPE}, '-3rum-', l_orderkey)")


# Columns that a page is made of.
SAID = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def is_plain(schema: StructType) -> Column:
    """Whether all that a line says reads the same in JSON as by itself."""

    def plain(field: StructField) -> Column:
        if field.dataType.typeName() == "string":
            return F.col(field.name).rlike(r"\A[ !#-\[\]-~]*\z")
        if field.dataType.typeName() in ("double", "float"):
            return F.abs(field.name) < F.lit(float("inf"))
        return F.col(field.name).isNotNull()

    return F.coalesce(reduce(and_, [plain(f) for f in schema.fields if f.name in SAID]), F.lit(False))


class PlainText:
    """Texts of the pages of plain lines, as parts, where ``to_json`` writes values one by one."""

    def __init__(self, lines: DataFrame):
        fields = [StructField(f.name, f.dataType, nullable=False) for f in lines.schema.fields]
        self.plain = lines.sparkSession.createDataFrame([], StructType(fields))

    def value(self, expression: str) -> tuple[list[str | Column], bool]:
        """Parts of an expression's value in the page, and whether it may be null."""
        field = self.plain.select(F.expr(expression).alias("x")).schema["x"]
        column = F.expr(expression)
        if field.dataType.typeName() != "string":
            return [column.cast("string")], field.nullable
        if '"' in expression or "chr(" in expression:  # the others have nothing to escape
            # in the object and, with all of the page, once more in the message
            column = F.replace(column, F.lit("\\"), F.lit("\\" * 4))
            column = F.replace(column, F.lit('"'), F.lit("\\" * 3 + '"'))
        return ['"', column, '"'], field.nullable

    def fields(self, fields: dict) -> list[str | Column]:
        """The fields' parts, each with a comma before it; null ones are left out."""
        parts = []
        for name, said in fields.items():
            nullable = False
            if isinstance(said, dict):
                value = ["{", *self.fields(said), "}"]
                value[1] = value[1].removeprefix(",")  # the first is never null
            elif isinstance(said, list):
                value = ["["]
                for item in said:
                    value += [*self.value(item)[0], ","]
                value[-1] = "]"
            else:
                value, nullable = self.value(said[0] if isinstance(said, tuple) else said)
            value = [f',"{name}":', *value]
            parts += [F.coalesce(in_message(value), F.lit(""))] if nullable else value
        return parts


def in_message(parts: list[str | Column]) -> Column:
    """The parts as one text; what is written here is escaped as in a message, columns are so already."""
    joined = []
    for part in parts:
        if isinstance(part, str) and joined and isinstance(joined[-1], str):
            joined[-1] += part
        else:
            joined.append(part)
    escaped = [
        F.lit(json.dumps(p, ensure_ascii=False)[1:-1]) if isinstance(p, str) else p for p in joined
    ]
    return F.concat(*escaped)


def _named_parts(name: str, fields: dict, text: PlainText) -> list[str | Column]:
    rest = {k: v for k, v in fields.items() if k not in ("id", "water_distance")}
    two_lines = F.when(F.expr(OBJECT_ON_TWO_LINES), in_message(['{\n"id":']))
    said = F.when(F.expr(ID_IS_TEXT), in_message(['"n/a"'])).otherwise(F.col("l_orderkey").cast("string"))
    parts = [f'"{name}":', two_lines.otherwise(in_message(['{"id":'])), said]
    if "water_distance" in fields:
        fraction = F.when(F.expr(DISTANCE_IS_FRACTION), F.lit(".5")).otherwise(F.lit(""))
        parts += [',"water_distance":', F.col("l_partkey").cast("string"), fraction]
    return [*parts, *text.fields(rest), "}"]


def plain_message(target: str, lines: DataFrame) -> Column:
    """The message of a plain line's page, joined from parts that are escaped already.

    The same text as ``message`` gives, which writes the page's object as JSON and then once more,
    character by character, the page in the message.
    """
    text = PlainText(lines)
    if target == "sold":
        home = in_message(['"property":{"id":', F.col("l_orderkey").cast("string"), ',"k":"v"},'])
        objects = [F.when(F.expr(NO_HOME), F.lit("")).otherwise(home), *_named_parts("sold_property", SOLD, text)]
    else:
        objects = _named_parts("property", {"forsale": FORSALE, "canonical": CANONICAL}[target], text)
    start = F.when(F.expr(BREAK_BEFORE_BRACKET), in_message(["dataLayer =\n  ["]))
    end = F.when(F.expr(TRAILING_KEYS), in_message([',"user":{"login":false}}];']))
    script = [
        start.otherwise(in_message(["dataLayer = ["])), '{"page":"listing",', *objects, end.otherwise(in_message(["}];"])),
    ]
    return F.concat(
        F.lit('{"url":"'),
        listing_url(),
        F.lit('","source":"'),
        in_message(['<!DOCTYPE html>\n<html><head><meta charset="utf-8"><script>\n']),
        F.when(F.expr(NO_DATA_LAYER), F.lit("var x = 1;")).otherwise(in_message(script)),
        in_message(["\n</script></head>\n<body><h1>Listing "]),
        F.col("l_orderkey").cast("string"),
        F.lit('</h1></body></html>","timestamp":'),
        F.col("l_linenumber").cast("double").cast("string"),
        F.lit("}"),
    )


def message(target: str) -> Column:
    """The message of any line's page."""
    return F.to_json(
        F.struct(
            listing_url().alias("url"),
            page_source(target).alias("source"),
            F.col("l_linenumber").cast("double").alias("timestamp"),
        )
    )


def listing_log(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    """Log record per line item, of the ship date's time."""
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(PAGE_TASKS, -(-lines.count() // PAGE_LINES))
    plain = F.when(F.col("is_plain"), plain_message(target, lines))
    lines = lines.withColumn("is_plain", is_plain(lines.schema)).repartition(tasks, *lines.columns)
    # Looked at before the shuffle, and the text named twice, so that Spark leaves it a projection
    # of its own: the JVM does not compile methods of more than 8,000 bytes.
    lines = lines.withColumn("plain", plain)
    value = F.when(F.col("plain").isNotNull(), F.col("plain")).otherwise(message(target))
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit(dt.date(1990, 1, 1))).cast("long")
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(LISTING_TOPIC).alias("topic"),
        F.expr(PARTITION).alias("partition"),
        (days * 10**12 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("offset"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def ship_date() -> Column:
    """Ingestion date by ship date, from a log record."""
    return F.to_date("timestamp")


def arrival_day() -> Column:
    """Ingestion date by the split into two days, from a log record."""
    return F.when(F.to_date("timestamp") < F.lit(SPLIT), F.lit(DAY_1)).otherwise(F.lit(DAY_2))


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log record per event; one topic per event type, four partitions each."""
    return as_topic_log(table(spark, sf_dir, "events"))


def as_topic_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def order_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing URL per order, with the order's status."""
    url = F.concat(F.lit(f"{LISTING_URL}villa-3rum-"), "o_orderkey")
    return table(spark, sf_dir, "orders").select(url.alias("url"), "o_orderkey", "o_orderstatus")


def flat(df: DataFrame) -> DataFrame:
    """Struct fields as columns named by their path, arrays as comma-separated text."""

    def columns(schema, path: str, name: str):
        for field in schema.fields:
            column, label = f"{path}{field.name}", f"{name}{field.name}"
            kind = field.dataType.typeName()
            if kind == "struct":
                yield from columns(field.dataType, f"{column}.", f"{label}_")
            elif kind == "array":
                yield F.array_join(column, ",").alias(label)
            else:
                yield F.col(column).alias(label)

    return df.select(*columns(df.schema, "", ""))
