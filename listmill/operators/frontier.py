"""Bookkeeping of URLs to fetch: pending and visited sets, links, fetch results.

A set is a DataFrame of unique rows: pending ``(url)``, visited ``(target, id)``.
Membership is exact. A set is large and what is looked up in it is mostly small, so
candidates are stored and measured first; within the broadcast limit they are looked
up where the set's rows are, and only those found are moved, which are measured too.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from listmill.functions.links import (
    BROKEN,
    HREF_PATTERN,
    RESULT_LIST,
    links,
    links_in_list,
    related_link,
    sitemap,
    sitemap_locs,
)
from listmill.functions.urls import url_id
from listmill.operators.joins import broadcast_if_small, drop_matching, join_unique
from listmill.sources.work import stored, stored_keys

# Default size of one round's sample.
SAMPLE_SIZE = 2400


def _known(members: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """The keys, each there once, that the set has; ``size`` is what they take."""
    # Members and stored keys are there once each: no key is hot, and a set that is
    # stored in buckets by the key stays where it is.
    rows = members.select(*keys.columns).dropna()
    found = rows.join(broadcast_if_small(keys, size), keys.columns, "left_semi")
    known, size = stored_keys(found.distinct(), "known")
    return broadcast_if_small(known, size)


def unvisited(candidates: DataFrame, visited: DataFrame, target: str) -> DataFrame:
    """Candidates (any columns, with ``url``) whose id the target has not visited.

    Candidates without a URL are none. They are stored with their ids, so that what
    they are computed from is computed once.
    """
    rows = candidates.where(F.col("url").isNotNull()).withColumn("_id", url_id(F.col("url")))
    rows = stored(rows, "candidates")
    ids, size = stored_keys(rows.select(F.col("_id").alias("id")).distinct(), "candidates")
    known = _known(visited.where(F.col("target") == target), ids, size)
    return drop_matching(rows, known.withColumnRenamed("id", "_id"), "_id", spread_by=["_id"]).drop("_id")


def _new_members(members: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates that are not in the set, each once; nulls are no members."""
    fresh, size = stored_keys(candidates.dropna().distinct(), "candidates")
    return drop_matching(fresh, _known(members, fresh, size), fresh.columns)


def new_pending(pending: DataFrame, urls: DataFrame) -> DataFrame:
    """URLs to append to the pending set."""
    return _new_members(pending, urls.select("url"))


def pending_add(pending: DataFrame, urls: DataFrame) -> DataFrame:
    """The pending set with the URLs in it."""
    return pending.select("url").unionByName(new_pending(pending, urls))


def pending_remove(pending: DataFrame, done: DataFrame) -> DataFrame:
    """Pending URLs without those that are done."""
    urls, size = stored_keys(done.select("url").dropna().distinct(), "done")
    return drop_matching(pending, broadcast_if_small(urls, size), "url", spread_by=["url"])


def still_pending(added: DataFrame, removed: DataFrame) -> DataFrame:
    """The set from a row per time that a URL was added and per time that it was removed.

    A URL is added only while it is not in the set and removed only while it is, so it is
    there if it was added more often. Few were removed since the tables were last
    folded, and only their rows are brought together.
    """
    times = removed.groupBy("url").agg(F.count(F.lit(1)).alias("_removed"))
    untouched = drop_matching(added.select("url"), times.select("url"), "url", spread_by=["url"])
    again = join_unique(added.select("url"), times, "url", "inner", spread_by=["url"])
    again = again.groupBy("url").agg(F.count(F.lit(1)).alias("_added"), F.max("_removed").alias("_removed"))
    return untouched.unionByName(again.where("_added > _removed").select("url"))


def to_remove(pending: DataFrame, done: DataFrame) -> DataFrame:
    """Those of the URLs that are in the pending set, each once."""
    urls, size = stored_keys(done.select("url").dropna().distinct(), "done")
    return _known(pending, urls, size)


def new_visited(visited: DataFrame, done: DataFrame, target: str) -> DataFrame:
    """Rows to append to the visited set for URLs that are done."""
    ids = done.select(url_id(F.col("url")).alias("id"))
    fresh = _new_members(visited.where(F.col("target") == target), ids)
    return fresh.select(F.lit(target).alias("target"), "id")


def visited_add(visited: DataFrame, done: DataFrame, target: str) -> DataFrame:
    """The visited set with the ids of the URLs in it."""
    return visited.select("target", "id").unionByName(new_visited(visited, done, target))


def sample(pending: DataFrame, n: int = SAMPLE_SIZE, seed: str = "") -> DataFrame:
    """``n`` pending URLs in a pseudo-random order that the seed decides.

    A repeated run draws the same URLs, so a lost executor cannot change the
    sample; give each round its own seed. Each task keeps its first ``n``.
    """
    order = F.md5(F.concat(F.lit(seed), F.col("url")))
    return pending.select("url").orderBy(order, "url").limit(n)


class Round(NamedTuple):
    """A drawn sample: URLs to fetch, and those that were visited already."""

    to_fetch: DataFrame
    stale: DataFrame


def draw(
    pending: DataFrame, visited: DataFrame, target: str, n: int = SAMPLE_SIZE, seed: str = ""
) -> Round:
    """Draw a sample and look it up in the visited set.

    The drawn URLs are looked up once and stored with the answer, at most ``n`` rows.
    """
    drawn = sample(pending, n, seed).select("url", url_id(F.col("url")).alias("id"))
    ids = visited.where(F.col("target") == target).select("id", F.lit(True).alias("seen"))
    # at most n drawn rows, and as many visited ids
    hits = ids.join(F.broadcast(drawn.select("id").distinct()), "id", "left_semi").distinct()
    marked = stored(drawn.join(F.broadcast(hits), "id", "left").select("url", "seen"), "round")
    return Round(
        marked.where(F.col("seen").isNull()).select("url"), marked.where(F.col("seen")).select("url")
    )


def next_round(
    pending: DataFrame, visited: DataFrame, target: str, n: int = SAMPLE_SIZE, seed: str = ""
) -> tuple[DataFrame, DataFrame]:
    """As ``draw``, with the pending set that is left in place of what leaves it."""
    to_fetch, stale = draw(pending, visited, target, n, seed)
    return to_fetch, drop_matching(pending, F.broadcast(stale), "url", spread_by=["url"])


def fetched_ok(fetches: DataFrame) -> DataFrame:
    """Fetches that succeeded."""
    return fetches.where(F.col("status") < 300)


def extract_links(pages: DataFrame, pattern: str = HREF_PATTERN) -> DataFrame:
    """One row per link of each page: the page's other columns and ``link``."""
    return _explode(pages, "html", links(F.col("html"), pattern), "link")


def extract_list_links(pages: DataFrame, block: str = RESULT_LIST) -> DataFrame:
    """As ``extract_links``, for the items of the list in one element of the page."""
    return _explode(pages, "html", links_in_list(F.col("html"), block), "link")


def related_links(pages: DataFrame, rel: str = "prev") -> DataFrame:
    """Set of the URLs that pages name as related."""
    found = _explode(pages.select("html"), "html", F.array(related_link(F.col("html"), rel)), "url")
    return found.where(F.col("url").isNotNull()).distinct()


def sitemap_urls(documents: DataFrame) -> DataFrame:
    """One row per URL of each sitemap document: the other columns and ``url``.

    A document that is not well-formed ends the query with an error.
    """
    parsed = sitemap(F.col("xml"))
    failed = F.raise_error(F.concat(F.lit("broken sitemap: "), F.substring("xml", 1, 200)))
    locs = F.when(parsed[BROKEN].isNotNull(), failed).otherwise(sitemap_locs(parsed))
    return _explode(documents, "xml", locs, "url")


def split_sitemaps(
    documents: DataFrame, counted: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """As ``sitemap_urls``, and the documents that are not well-formed, unchanged.

    ``counted`` gets their number as ``broken`` when the URLs are computed.
    """
    rest = [c for c in documents.columns if c != "xml"]
    parsed = documents.withColumn("_parsed", sitemap(F.col("xml")))
    is_broken = F.col(f"_parsed.{BROKEN}").isNotNull()
    rows = parsed
    if counted is not None:
        rows = parsed.observe(counted, F.count_if(is_broken).alias("broken"))
    urls = rows.select(*rest, F.explode(sitemap_locs(F.col("_parsed"))).alias("url"))
    return urls, parsed.where(is_broken).drop("_parsed")


def _explode(df: DataFrame, text: str, items: Column, name: str) -> DataFrame:
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(items).alias(name))
