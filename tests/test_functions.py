import random

import pytest
from pyspark.sql import functions as F

from listmill.functions import embedded, links, urls


def values(spark, texts, *columns):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [tuple(r) for r in df.select(*columns).collect()]


# page source, text of "property", text of "sold_property", parsed id of "property"
PAGES = [
    (
        'dataLayer = [{"page":"a","property":{"id":5,"price":10}}];',
        '{"id":5,"price":10}',
        "",
        5,
    ),
    (
        'dataLayer=[{"property":{"id":5},"user":{"a":1}}];',
        '{"id":5},"user":{"a":1}',
        "",
        5,
    ),
    (
        'dataLayer=[{"property":{"id":5},"sold_property":{"id":99}}];',
        '{"id":5},"sold_property":{"id":99}',
        '{"id":99}',
        5,
    ),
    (
        'dataLayer=[{"sold_property":{"id":99},"property":{"id":5}}];',
        '{"id":5}',
        '{"id":99},"property":{"id":5}',
        5,
    ),
    ('dataLayer=[{"property":{"id":5,\n"price":10}}];', "", "", None),
    ('dataLayer=\n [{"property":{"id":5}}];', '{"id":5}', "", 5),
    ('dataLayer=[{"property":{"id":5}}]; z=[{"q":1}];', '{"id":5}}]; z=[{"q":1', "", 5),
    (
        'dataLayer=[{"property":{"id":5,"x":{"property":{"id":6}}}}];',
        '{"id":6}}}',
        "",
        6,
    ),
    ("<html></html>", "", "", None),
    (None, None, None, None),
]


def test_embedded_json_is_what_the_greedy_pattern_finds(spark):
    """Random pages of the parts that matter, with the name not at all, once and more often."""
    rng = random.Random(3)
    parts = ['dataLayer', "dataLayer = [", '"property":', '"property":{', '{"id":5', "}];", "}", "=", "[", " ", "\n"]
    pages = ["".join(rng.choices(parts, k=rng.randint(3, 14))) for _ in range(6000)]
    pages += [f"dataLayer = [{p}}}];" for p in pages[:3000]]
    greedy = F.regexp_extract("x", embedded.DATA_LAYER_PATTERN % "property", 1)
    rows = values(spark, pages, embedded.embedded_json(F.col("x"), "property"), greedy)
    assert all(found == expected for found, expected in rows)
    names = [p.count('"property":') for p, (_, text) in zip(pages, rows, strict=True) if text]
    assert names.count(1) > 100 and sum(n > 1 for n in names) > 100


def test_a_single_name_is_searched_from_the_front(spark):
    """Of pages with the name once, the pattern that goes to the line's end and back reads none."""
    [(pattern,)] = (
        spark.createDataFrame([(PAGES[0][0],)], "x string")
        .select(embedded.data_layer_pattern(F.col("x"), "property"))
        .collect()
    )
    assert pattern == embedded.FIRST_NAME_PATTERN % "property"


def test_embedded_objects(spark):
    rows = values(
        spark,
        [p[0] for p in PAGES],
        embedded.embedded_json(F.col("x"), "property"),
        embedded.embedded_json(F.col("x"), "sold_property"),
        embedded.embedded_object(F.col("x"), "property", "id int")["id"],
    )
    assert rows == [p[1:] for p in PAGES]


OBJECTS = [
    ("", None),
    ('{"id":"abc","price":7}', (None, 7, None, None, None)),
    ('{"id":"5","price":7}', (None, 7, None, None, None)),
    ('{"id":5.0,"price":7}', (None, 7, None, None, None)),
    ('{"id":3000000000,"price":7}', (None, 7, None, None, None)),
    ('{"id":null,"price":7}', (None, 7, None, None, None)),
    ('{"id":5,"price":', (None,) * 5),
    ('[{"id":5}]', (None,) * 5),
    ('{"id":5},"b":{}', (5, None, None, None, None)),
    ('{"id":5,"id":6}', (6, None, None, None, None)),
    ('{"ID":5}', (None,) * 5),
    ('{"id":5,"b":"text"}', (5, None, None, None, None)),
    ('{"id":5,"d":"3"}', (5, None, None, None, None)),
    ('{"id":5,"r":2.5}', (5, None, None, "2.5", None)),
    ('{"id":5,"r":3}', (5, None, None, "3", None)),
    ('{"id":5,"d":3}', (5, None, None, None, 3.0)),
]


def test_parsed_objects(spark):
    schema = "id int, price long, b boolean, r string, d double"
    rows = values(spark, [o[0] for o in OBJECTS], F.from_json("x", schema))
    assert [r[0] if r[0] is None else tuple(r[0]) for r in rows] == [o[1] for o in OBJECTS]


def test_message_round_trip(spark):
    df = spark.createDataFrame(
        [('http://h/å-1"', "<p>\n\t\\</p>", 1.5), (None, None, None)], "url string, s string, t double"
    )
    message = embedded.encode_message(F.col("url"), F.col("s"), F.col("t"))
    assert [tuple(r[0]) for r in df.select(embedded.parse_message(message)).collect()] == [
        tuple(r) for r in df.collect()
    ]
    assert df.select(message).collect()[1][0] == '{"url":null,"source":null,"timestamp":null}'


@pytest.mark.parametrize(
    "url, key, kind, whole",
    [
        ("https://h/bostad/villa-5rum-foo-17123456", "17123456", "villa", "17123456"),
        ("http://x/", "", "", "http://x/"),
        ("", "", "", ""),
        ("abc", "abc", "abc", "abc"),
        ("https://h/bostad/villa-1?x=2-3", "3", "villa", "3"),
        ("https://a-b.org/salda/77", "77", "77", "b.org/salda/77"),
        (None, None, None, None),
    ],
)
def test_urls(spark, url, key, kind, whole):
    x = F.col("x")
    assert values(spark, [url], urls.url_key(x), urls.url_type(x), urls.url_id(x)) == [
        (key, kind, whole)
    ]


def test_sold_links_are_greedy_within_a_line(spark):
    html = (
        '<a href="https://h/salda/a-1">1</a>\n'
        '<a href="https://h/salda/b-2">2</a><a href="https://h/salda/c-3">3</a>\r'
        '<a href="https://h/salda/d-4">4</a>\n'
        '<a href="https://h/salda/none">5</a>\n<a href="http://h/salda/e-5">6</a>'
    )
    [(found,)] = values(spark, [html], links.links(F.col("x"), links.SOLD_LINK_PATTERN))
    assert found == [
        "https://h/salda/a-1",
        # a carriage return does not end the line
        'https://h/salda/b-2">2</a><a href="https://h/salda/c-3">3</a>\r<a href="https://h/salda/d-4',
    ]


LISTS = [
    (
        '<a href="/no">n</a><div class="x" id="result">\n<ul class="l"><li class="a">\n'
        '<a class="c" href="/1?a=1&amp;b=2"><b>1</b><a href="/inner">i</a></a></li><li><a href="/2">2</a></li>'
        '<li><p><a href="/3">3</a></p></li></ul></div><ul><li><a href="/no">n</a></li></ul>',
        ["/1?a=1&b=2", "/2"],
    ),
    # a nested list, then more items
    (
        "<div id='result'><ul><li><a href='/1'>1</a><ul><li><a href='/n'>n</a></li></ul></li>"
        "<li><a href='/2'>2</a></li></ul></div>",
        ["/1", "/2"],
    ),
    # a second list
    ('<p id="result"><ul><li><a href="/1"></a></ul><ul><li><a href="/2"></a></ul>', ["/1", "/2"]),
    # a heading before the list, a tag before the link, upper case
    ('<DIV ID="result"><h1>x<br></h1><UL><LI><img src="i"><A HREF="/1">1</A></LI></UL></DIV>', ["/1"]),
    # items without end tags, several links in one, end tags without start
    (
        '<div id="result"><ul></p><li><a href="/1"></a><a href="/2"></a><li></b><a href="/3"></a></ul></div>'
        '<ul><li><a href="/no"></a></ul>',
        ["/1", "/2", "/3"],
    ),
    # no tags in comments and scripts
    (
        '<div id="result"><!-- </div> --><script>var t = "</div>";</script><ul><li><a href="/1">'
        "</a></li></ul></div>",
        ["/1"],
    ),
    # a bracket in quotes, no quotes, an attribute that looks like another, references by number
    (
        """<div id=result><ul><li><a title="5 > 3" href="/1"></a><li><a href=/2></a><li><a data-x=" href='/bad'" href='/3'>
        </a><li><a href="/4?a&#38;b&#x26;c&#8211;d&eacute;&nope;&#0;"></a><li><a HREF = '/5' href="/second"></a></ul></div>""",
        ["/1", "/2", "/3", "/4?a&b&c–dé&nope;�", "/5"],
    ),
    # values that are empty, missing or end in a slash, attributes without space between, a lone quote
    (
        """<div hidden id="result"><ul><li><a href=></a><a href></a><a href=/1/><i></i></a></li>
        <li><a class="x"href="/2"></a></li><li><a it's href="/3"></a><a x=y' href="/4"/></li></ul></div>""",
        ["/1/", "/2", "/3", "/4"],
    ),
    # what looks like a comment or a script in quotes, and tags in a script
    (
        """<a title="<!--" alt='<script>'></a><script type="a>b">"<div id='result'>"</script>
        <div id="result"><ul><li><a href="/1" title="-->"></a></li></ul></div><!-- <ul> not ended""",
        ["/1"],
    ),
    ("<div id='result'><ul><li><a href='/1'" + " x" * 20000 + "></a></li></ul></div>", ["/1"]),
    ('<div id="result"><div><ul><li><a href="/deep"></a></li></ul></div></div>', []),
    ('<div id="results"><ul><li><a href="/no"></a></li></ul></div>', []),
    ('<br id="result"><ul><li><a href="/no"></a></li></ul>', []),
    ("<p>none</p>", []),
    ("", []),
    (None, None),
]


def test_links_in_list(spark):
    rows = values(spark, [html for html, _ in LISTS], links.links_in_list(F.col("x")))
    assert rows == [(found,) for _, found in LISTS]


@pytest.mark.parametrize(
    "html, href",
    [
        ('<a class="x">1</a><a class="b next_page" href="/p?page=2&amp;a=1">2</a>', "https://h.se/p?page=2&a=1"),
        ("<a href='?page=2' class='next_page'>", "https://h.se/a/?page=2"),
        ("<a class='next_page' href='http://o/x'>", "http://o/x"),
        ("<a class='next_pages' href='/x'>", None),
        (None, None),
    ],
)
def test_next_page(spark, html, href):
    page = F.lit("https://h.se/a/b?page=1/x")
    assert values(spark, [html], links.next_page(F.col("x"), page)) == [(href,)]


@pytest.mark.parametrize(
    "html, href",
    [
        ("<link rel='prev' href='/a'><link rel='prev' href='/b'>", "/a"),
        ('<LINK href="/a?x=1&amp;amp;y=2" REL="prev"/>', "/a?x=1&amp;y=2"),
        ("<link rel='next' href='/n'><link\nrel=\"prev\"\nhref='/p'>", "/p"),
        ("<link rel='prev'><link rel='prev' href='/b'>", "/b"),
        ("<link rel='prev' data-href='/x'>", None),
        ("<a rel='prev' href='/a'>", None),
        ("<link title='a>b' rel=prev href=/p?a=1&#38;b=2>", "/p?a=1&b=2"),
        ("<!-- <link rel='prev' href='/c'> --><link data-y=\" rel='prev'\" href='/n'>", None),
        ("", None),
        (None, None),
    ],
)
def test_related_link(spark, html, href):
    assert values(spark, [html], links.related_link(F.col("x"))) == [(href,)]


def test_sitemap(spark):
    xml = (
        '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
        "<url><loc> https://h/a-1 </loc><lastmod>2020</lastmod></url>"
        "<url><loc>https://h/?a=1&amp;b=2</loc></url></urlset>"
    )
    one = "<urlset><url><loc>x</loc></url></urlset>"
    rows = values(spark, [xml, one, "<urlset></urlset>"], links.sitemap_locs(links.sitemap(F.col("x"))))
    assert rows == [(["https://h/a-1", "https://h/?a=1&b=2"],), (["x"],), (None,)]


def test_url_parts_are_those_of_a_split(spark):
    """Without an array of all parts: the plans of these columns split nothing."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("a/-?Å", k=rng.randint(0, 9))) for _ in range(2000)] + [None]
    x = F.col("x")
    tail = F.element_at(F.split(x, "/"), -1)
    expected = (
        tail,
        F.element_at(F.split(tail, "-"), -1),
        F.element_at(F.split(tail, "-"), 1),
        F.element_at(F.split(x, "-"), -1),
    )
    found = (urls.url_tail(x), urls.url_key(x), urls.url_type(x), urls.url_id(x))
    assert all(r[:4] == r[4:] for r in values(spark, texts, *found, *expected))
    plan = spark.createDataFrame([("a",)], "x string").select(*found)._jdf.queryExecution()
    assert "split(" not in plan.optimizedPlan().toString()
