import gzip

import pytest
from pyspark.sql import Observation

from listmill.operators import frontier
from listmill.plans.jobs import draw_round, sitemap_round
from listmill.sources.paths import remove_path
from listmill.sources.sitemaps import SITEMAP, read_sitemap_files
from listmill.sources.visited import append_visited, lay_out, read_visited, visited_among
from listmill.sources.pending import add_pending, fold_pending, read_pending, remove_pending
from tests.conftest import final_plan


def urls(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "url string")


def texts(df):
    return sorted(r["url"] for r in df.collect())


def test_unvisited_is_exact_and_per_target(spark):
    visited = spark.createDataFrame([("sold", "1"), ("forsale", "2")], "target string, id string")
    candidates = urls(spark, "http://h/a-1", "http://h/b-2", "http://h/c-1", "http://h/d-3")
    assert texts(frontier.unvisited(candidates, visited, "sold")) == ["http://h/b-2", "http://h/d-3"]


def test_sets_do_not_repeat(spark):
    pending = urls(spark, "u-1", "u-2")
    added = frontier.pending_add(pending, urls(spark, "u-2", "u-3", "u-3"))
    assert texts(added) == ["u-1", "u-2", "u-3"]
    more = spark.createDataFrame([("u-1",), ("u-9",), (None,)], "url string")
    assert texts(frontier.new_pending(added, more)) == ["u-9"]
    assert texts(frontier.pending_remove(added, urls(spark, "u-1", "x"))) == ["u-2", "u-3"]
    visited = spark.createDataFrame([("sold", "1")], "target string, id string")
    both = frontier.visited_add(visited, urls(spark, "a-1", "b-2"), "sold")
    assert sorted(map(tuple, both.collect())) == [("sold", "1"), ("sold", "2")]


@pytest.fixture
def sets(spark, folder):
    """Stored pending and visited sets of a thousand members."""
    spark.range(1000).selectExpr("concat('u-', id) AS url").write.parquet(f"{folder}/pending")
    ids = spark.range(1000).selectExpr("'sold' AS target", "cast(id AS string) AS id")
    ids.write.parquet(f"{folder}/visited")
    return spark.read.parquet(f"{folder}/pending"), spark.read.parquet(f"{folder}/visited")


LOOKUPS = {
    "unvisited": lambda p, v, some: frontier.unvisited(some, v, "sold"),
    "new_pending": lambda p, v, some: frontier.new_pending(p, some),
    "new_visited": lambda p, v, some: frontier.new_visited(v, some, "sold").selectExpr("id AS url"),
    "pending_remove": lambda p, v, some: frontier.pending_remove(p, some),
    "next_round": lambda p, v, some: frontier.next_round(p, v, "sold", 5)[1],
}


@pytest.mark.parametrize("name", LOOKUPS)
def test_a_few_are_looked_up_where_the_set_is(spark, sets, conf, name):
    some = urls(spark, "u-1", "x-7777", None)
    result = LOOKUPS[name](*sets, some)
    expected = texts(result)
    plan = final_plan(result)
    # no row of the set is shuffled but those found; none of this needs Spark's own estimate
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = final_plan(LOOKUPS[name](*sets, some))
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    conf(listmill__broadcastBytes="0")
    beyond = LOOKUPS[name](*sets, some)
    if name != "next_round":  # bounded by its sample
        assert "SortMergeJoin" in final_plan(beyond)
    assert texts(beyond) == expected


def test_a_round_draws_and_looks_up_once(spark, sets):
    to_fetch, rest = frontier.next_round(*sets, "sold", 5)
    for result in (to_fetch, rest):
        plan = final_plan(result)
        assert "TakeOrdered" not in plan and plan.count("Join") <= 1


def test_pending_set_shrinks(spark, folder):
    path = f"{folder}/pending"
    assert texts(read_pending(spark, path)) == []
    assert add_pending(spark, path, urls(spark, "u-1", "u-2", "u-2", None)) == 2
    assert remove_pending(spark, path, urls(spark, "u-1", "u-1", "u-9", None)) == 1
    assert remove_pending(spark, path, urls(spark, "u-1")) == 0
    assert texts(read_pending(spark, path)) == ["u-2"]
    # added again, removed again, added again
    assert add_pending(spark, path, urls(spark, "u-1", "u-2")) == 1
    assert texts(read_pending(spark, path)) == ["u-1", "u-2"]
    assert remove_pending(spark, path, urls(spark, "u-1")) == 1
    assert add_pending(spark, path, urls(spark, "u-1", "u-3")) == 2
    fold_pending(spark, path)
    assert texts(read_pending(spark, path)) == ["u-1", "u-2", "u-3"]
    # later steps and foldings build on the folded tables
    assert remove_pending(spark, path, urls(spark, "u-3")) == 1
    assert add_pending(spark, path, urls(spark, "u-4", "u-1")) == 1
    assert texts(read_pending(spark, path)) == ["u-1", "u-2", "u-4"]
    fold_pending(spark, path)
    assert texts(spark.read.parquet(f"{path}/_folded-2/added")) == ["u-1", "u-2", "u-4"]
    # one that died before it was complete does not count
    remove_path(spark, f"{path}/_folded-2/added/_SUCCESS")
    assert texts(read_pending(spark, path)) == ["u-1", "u-2", "u-4"]
    assert add_pending(spark, path, urls(spark, "u-5")) == 1
    fold_pending(spark, path)
    assert texts(read_pending(spark, path)) == ["u-1", "u-2", "u-4", "u-5"]


def test_few_removed_urls_do_not_shuffle_the_set(spark, folder):
    path = f"{folder}/pending"
    spark.range(1000).selectExpr("concat('u-', id) AS url").write.parquet(path)
    remove_pending(spark, path, urls(spark, "u-1", "u-2"))
    rows = read_pending(spark, path)
    assert "SortMergeJoin" not in final_plan(rows)
    assert rows.count() == 998


def test_candidates_are_computed_once(spark, sets):
    """The sitemaps' XML is parsed by the action that stores the URLs, and not after."""
    documents = spark.createDataFrame(SITEMAPS[:1], "doc int, xml string")
    todo = sitemap_round(documents, sets[1], "sold")
    assert "from_xml" not in final_plan(todo).lower() and "xmltostructs" not in final_plan(todo).lower()
    assert todo.columns == ["doc", "url"] and texts(todo.select("url")) == []


def test_a_draw_drops_visited_urls_from_the_stored_set(spark, sets, folder):
    spark.range(1000, 1003).selectExpr("concat('u-', id) AS url").write.mode("append").parquet(
        f"{folder}/pending"
    )
    drawn = draw_round(spark, f"{folder}/pending", f"{folder}/visited", "sold", n=2000)
    assert texts(drawn) == ["u-1000", "u-1001", "u-1002"]
    assert texts(read_pending(spark, f"{folder}/pending")) == texts(drawn)
    assert draw_round(spark, f"{folder}/pending", f"{folder}/visited", "forsale", n=2).count() == 2


def test_candidates_without_url_are_none(spark, sets):
    assert texts(frontier.unvisited(urls(spark, None, "x-7777"), sets[1], "sold")) == ["x-7777"]


SITEMAPS = [
    (1, "<urlset><url><loc>a-1</loc></url></urlset>"),
    (2, "<urlset><url><loc>b-2</loc></url><url><loc>c"),
    (3, ""),
    (4, "<urlset></urlset>"),
    (5, None),
]


def test_broken_sitemaps_are_not_lost(spark):
    documents = spark.createDataFrame(SITEMAPS, "doc int, xml string")
    with pytest.raises(Exception, match="broken sitemap"):
        frontier.sitemap_urls(documents).collect()
    assert texts(frontier.sitemap_urls(documents.where("doc IN (1, 4, 5)"))) == ["a-1"]
    counted = Observation("broken")
    found, broken = frontier.split_sitemaps(documents, counted)
    assert texts(found) == ["a-1"]
    assert sorted(map(tuple, broken.collect())) == [SITEMAPS[1], SITEMAPS[2]]
    assert counted.get["broken"] == 2


def test_sample_is_repeatable_and_bounded(spark):
    pending = urls(spark, *[f"u-{i}" for i in range(200)])
    first = texts(frontier.sample(pending, 50, "a"))
    assert first == texts(frontier.sample(pending.repartition(7), 50, "a"))
    assert first != texts(frontier.sample(pending, 50, "b"))
    assert len(set(first)) == 50
    assert len(texts(frontier.sample(pending, 500))) == 200


def test_next_round_drops_visited_urls_of_the_sample(spark):
    pending = urls(spark, *[f"u-{i}" for i in range(10)])
    visited = spark.createDataFrame([("sold", str(i)) for i in range(5)], "target string, id string")
    to_fetch, rest = frontier.next_round(pending, visited, "sold", n=100)
    assert texts(to_fetch) == texts(rest) == [f"u-{i}" for i in range(5, 10)]
    to_fetch, rest = frontier.next_round(pending, visited, "sold", n=3, seed="s")
    drawn = set(texts(frontier.sample(pending, 3, "s")))
    seen = {f"u-{i}" for i in range(5)}
    assert set(texts(to_fetch)) == drawn - seen
    assert set(texts(rest)) == set(texts(pending)) - (drawn & seen)


def test_fetched_ok(spark):
    fetches = spark.createDataFrame([("a", 200), ("b", 299), ("c", 300), ("d", 404)], "url string, status int")
    assert texts(frontier.fetched_ok(fetches)) == ["a", "b"]


def test_extraction_keeps_the_page_columns(spark):
    pages = spark.createDataFrame(
        [(1, '<a href="/a"><a href="/b">'), (2, "")], "page_id int, html string"
    )
    assert sorted(map(tuple, frontier.extract_links(pages).collect())) == [(1, "/a"), (1, "/b")]
    related = spark.createDataFrame([("<link rel='prev' href='/p'>",)] * 3 + [("",)], "html string")
    assert texts(frontier.related_links(related)) == ["/p"]


def test_a_set_in_buckets_is_looked_up_where_it_is(spark, sets, conf, folder):
    path = f"{folder}/visited"
    before = read_visited(spark, path).count()
    lay_out(spark, path, 8)
    assert read_visited(spark, path).count() == before
    new = spark.createDataFrame([("sold", "it's new"), ("forsale", "5")], "target string, id string")
    assert append_visited(new, path) == 2
    conf(spark__sql__autoBroadcastJoinThreshold="-1", listmill__broadcastBytes="0")
    ids, _ = frontier.stored_keys(spark.range(0, 2000, 2).selectExpr("cast(id AS string) AS id"), "ids")
    members = read_visited(spark, path).where("target = 'sold'").select("id")
    found = members.join(ids, "id", "left_semi")
    plan = final_plan(found)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    some = urls(spark, "u-1", "v-it's new", "w-5", "x-7777", None)
    assert texts(frontier.unvisited(some, read_visited(spark, path), "sold")) == ["x-7777"]
    fresh = frontier.new_visited(read_visited(spark, path), some, "forsale")
    assert sorted(r["id"] for r in fresh.collect()) == ["1", "7777", "it's new"]
    lay_out(spark, path, 4)
    assert read_visited(spark, path).count() == before + 2


def test_few_ids_are_read_from_their_buckets(spark, sets, folder):
    path = f"{folder}/visited"
    lay_out(spark, path, 8)
    found = visited_among(spark, path, "sold", ["17", "nowhere"])
    assert [r["id"] for r in found.collect()] == ["17"]
    scan = found._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.optionalBucketSet().get().cardinality() <= 2
    with pytest.raises(ValueError):
        visited_among(spark, path, "sold", ["1"] * 1001)


def test_a_layout_that_died_is_none(spark, sets, folder):
    path = f"{folder}/visited"
    lay_out(spark, path, 4)
    lay_out(spark, path, 8)
    remove_path(spark, f"{path}/_buckets-2/_SUCCESS")
    assert read_visited(spark, path).count() == 1000
    assert append_visited(spark.sql("SELECT 'sold' AS target, 'x' AS id"), path) == 1
    lay_out(spark, path, 2)
    assert read_visited(spark, path).count() == 1001


def test_sitemap_files(spark, folder):
    head = '<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    items = "".join(f"<url>\n <loc> http://h/a-{i}&amp;x=1 </loc><priority>1</priority></url>" for i in range(50))
    with open(f"{folder}/a.xml", "w") as f:
        f.write(f"{head}{items}</urlset>")
    with gzip.open(f"{folder}/b.xml.gz", "wt") as f:
        f.write("<sitemapindex><sitemap><loc>http://h/map</loc></sitemap><sitemap/></sitemapindex>")
    rows = read_sitemap_files(spark, folder).collect()
    assert sorted(r["url"] for r in rows) == sorted(f"http://h/a-{i}&x=1" for i in range(50))
    assert {r["file"].rsplit("/", 1)[1] for r in rows} == {"a.xml"}
    maps = read_sitemap_files(spark, folder, SITEMAP).collect()
    assert [r["url"] for r in maps] == ["http://h/map"]
    with open(f"{folder}/c.xml", "w") as f:
        f.write(f"{head}<url><loc>http://h/c</lok></url></urlset>")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_sitemap_files(spark, folder).collect()
