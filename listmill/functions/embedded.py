"""JSON objects that listing pages embed in a script, and the page message itself."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill.schemas import PAGE_MESSAGE

# Fixed value: where a page keeps its objects. Greedy on purpose, and one line
# only: the last `"<name>":` before the last `}];` of the line wins, and the
# capture may carry text after the object, which JSON parsing ignores.
DATA_LAYER_PATTERN = r'dataLayer\s*=\s*\[.*"%s":\s*(\{.*)\}\];'

# The same from the first name on. Where a page has the name once it can only match the same
# text, and need not go to the end of the line and back to find it.
FIRST_NAME_PATTERN = DATA_LAYER_PATTERN.replace(r"\[.*", r"\[.*?")

# Names of the embedded objects.
PROPERTY = "property"
SOLD_PROPERTY = "sold_property"


def has_data_layer(source: Column) -> Column:
    return source.rlike(r"dataLayer\s*=\s*\[")


def data_layer_pattern(source: Column, name: str) -> Column:
    """The pattern that finds the object called ``name`` in the page soonest."""
    once = F.regexp_count(source, F.lit(f'"{name}":')) <= 1
    return F.when(once, FIRST_NAME_PATTERN % name).otherwise(DATA_LAYER_PATTERN % name)


def embedded_json(source: Column, name: str) -> Column:
    """Text of the object called ``name`` in the page's data layer, '' without one."""
    return F.call_function("regexp_extract", source, data_layer_pattern(source, name), F.lit(1))


def embedded_object(source: Column, name: str, schema: str) -> Column:
    """The embedded object as a struct: a wrong-typed field is null, no object is a null struct."""
    return F.from_json(embedded_json(source, name), schema)


def parse_message(value: Column) -> Column:
    """Log value -> struct<url, source, timestamp>."""
    return F.from_json(value, PAGE_MESSAGE)


def encode_message(url: Column, source: Column, timestamp: Column) -> Column:
    """Page -> log value; nulls are written out, as a producer writes them."""
    page = F.struct(url.alias("url"), source.alias("source"), timestamp.alias("timestamp"))
    return F.to_json(page, {"ignoreNullFields": "false"})
