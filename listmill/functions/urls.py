"""Keys and types that a listing URL carries in its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_tail(url: Column) -> Column:
    """Text after the last slash; the query string stays on it."""
    return F.substring_index(url, "/", -1)


def url_key(url: Column) -> Column:
    """Last dash-separated token of the URL's tail: the listing id."""
    return F.substring_index(url_tail(url), "-", -1)


def url_type(url: Column) -> Column:
    """First dash-separated token of the URL's tail: the kind of home."""
    return F.substring_index(url_tail(url), "-", 1)


def url_id(url: Column) -> Column:
    """Id under which a URL counts as visited: the text after the last dash of the whole URL.

    Differs from ``url_key`` where the tail has no dash.
    """
    return F.substring_index(url, "-", -1)
