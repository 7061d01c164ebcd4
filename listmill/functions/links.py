"""Links out of page HTML and URLs out of sitemap XML.

Page HTML is seldom well-formed XML, so Spark's ``xpath`` cannot read it. It is cut into
tags by the grammar of a tag, whose attributes have a value in either kind of quotes, without
quotes, or none; a ``>`` in quotes ends no tag. Values are read attribute by attribute, the first
of a name counts, and character references in them are decoded.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: links to sold listings. Greedy on purpose: two links on one line
# come out as one text. `(?d)` lets `.` stop at a line feed only.
SOLD_LINK_PATTERN = r'(?d)href="(https:.*/salda/.*[0-9])">'

# Every quoted href, one by one.
HREF_PATTERN = r'href="([^"]+)"'

# Id of the element whose direct list holds a result page's links.
RESULT_LIST = "result"

# Elements that have no end tag.
VOID = "area base br col embed hr img input link meta source track wbr".split()

# An attribute: a name, and a value if it has one. Possessive, so that no text takes long.
ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+"""
TAG_NAME = r"</?[a-zA-Z][^\s/>]*+"
TAG = rf"{TAG_NAME}(?:[\s/]++|{ATTRIBUTE})*+>"

# Comments, and elements whose text has no tags, up to their end.
COMMENT = r"<!--.*?(?:-->|$)"
RAW_TEXT = rf"<(?:script(?=[\s/>])(?:[\s/]++|{ATTRIBUTE})*+>.*?</script|style(?=[\s/>])(?:[\s/]++|{ATTRIBUTE})*+>.*?</style)"
NO_TAGS = r"(?is)^<(?:!--|(?:script|style)\b)"

# A character reference; one by number may lack its end.
REFERENCE = r"&(?:#[0-9]{1,9};?|#[xX][0-9a-fA-F]{1,7};?|[a-zA-Z][a-zA-Z0-9]*;)"
REPLACEMENT = 0xFFFD

BROKEN = "_broken"
SITEMAP = f"url array<struct<loc: string>>, {BROKEN} string"


def _decoded(reference: Column) -> Column:
    """The character of a reference; a name that HTML does not know stays as it is."""
    digits = F.regexp_extract(reference, r"^&#([0-9]+)", 1)
    hex_digits = F.regexp_extract(reference, r"^&#[xX]([0-9a-fA-F]+)", 1)
    named = F.create_map(*[F.lit(x) for item in sorted(name2codepoint.items()) for x in item])
    code = (
        F.when(digits != "", digits.cast("long"))
        .when(hex_digits != "", F.conv(hex_digits, 16, 10).cast("long"))
        .otherwise(F.try_element_at(named, F.regexp_extract(reference, "^&([a-zA-Z0-9]+);", 1)).cast("long"))
    )
    no_character = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    code = F.when(no_character, F.lit(REPLACEMENT)).otherwise(code)
    return F.coalesce(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"), reference)


def unescape(text: Column) -> Column:
    """The text with its character references decoded, each once."""
    between = F.split(text, REFERENCE, -1)
    references = F.concat(
        F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), 0), _decoded), F.array(F.lit(""))
    )
    decoded = F.array_join(F.zip_with(between, references, lambda a, b: F.concat(a, b)), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def links(html: Column, pattern: str = HREF_PATTERN) -> Column:
    """All matches of the pattern's first group, in page order, as an array."""
    return F.regexp_extract_all(html, F.lit(pattern), 1)


def links_in_list(html: Column, block: str = RESULT_LIST) -> Column:
    """Links of the list items of an element: ``//*[@id=block]/ul/li/a/@href``.

    The tags are folded from first to last with the stack of elements that are open
    within the block. An end tag closes its element and whatever is open in it; one
    without a start is ignored; an item closes the item before it.
    """
    tags = F.transform(
        _tags(html),
        lambda tag: F.struct(
            _name(tag).alias("name"),
            tag.startswith("</").alias("ends"),
            _is_empty(tag).alias("empty"),
            F.when(_name(tag) == "a", attribute(tag, "href")).otherwise("").alias("href"),
            attribute(tag, "id").alias("id"),
        ),
    )
    texts = F.array().cast("array<string>")
    start = F.struct(texts.alias("stack"), texts.alias("links"))

    def open_tag(state: Column, tag: Column) -> Column:
        name, stack = tag["name"], state["stack"]
        inside = F.size(stack) > 0
        in_item = F.element_at(F.concat(stack, F.array(F.lit(""))), F.size(stack)) == "li"
        parents = F.when(
            inside & (name == "li") & in_item, F.slice(stack, 1, F.size(stack) - 1)
        ).otherwise(stack)
        begins = inside | (tag["id"] == block)
        empty = name.isin(*VOID) | tag["empty"]
        direct = (F.size(parents) == 3) & (F.slice(parents, 2, 2) == F.array(F.lit("ul"), F.lit("li")))
        found = F.when(direct & (tag["href"] != ""), F.array(tag["href"])).otherwise(texts)
        return F.struct(
            F.when(begins & ~empty, F.concat(parents, F.array(name))).otherwise(parents).alias("stack"),
            F.concat(state["links"], found).alias("links"),
        )

    def end_tag(state: Column, tag: Column) -> Column:
        stack = state["stack"]
        behind = F.array_position(F.reverse(stack), tag["name"]).cast("int")
        left = F.when(behind > 0, F.slice(stack, 1, F.size(stack) - behind)).otherwise(stack)
        return F.struct(left.alias("stack"), state["links"].alias("links"))

    return F.aggregate(
        tags,
        start,
        lambda state, tag: F.when(tag["ends"], end_tag(state, tag)).otherwise(open_tag(state, tag)),
        lambda state: state["links"],
    )


def _tags(html: Column) -> Column:
    """The tags of a page, in order."""
    pattern = F.lit(rf"(?is)(?:{COMMENT}|{RAW_TEXT}|{TAG})")
    return F.filter(F.regexp_extract_all(html, pattern, 0), lambda tag: ~tag.rlike(NO_TAGS))


def _name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^</?([a-zA-Z][^\s/>]*)", 1))


def _is_empty(tag: Column) -> Column:
    """Whether the tag ends in ``/>``, and not because a value without quotes does."""
    return tag.endswith("/>") & ~tag.rlike(r"""=\s*[^\s"'>][^\s"'>]*/>$""")


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, '' where it has none."""
    body = F.regexp_replace(tag, f"^{TAG_NAME}", "")
    own = F.filter(
        F.regexp_extract_all(body, F.lit(ATTRIBUTE), 0),
        lambda item: F.lower(F.regexp_extract(item, r"^([^\s/>][^\s/>=]*)", 1)) == name,
    )
    written = F.regexp_replace(F.get(own, F.lit(0)), r"(?s)^[^\s/>][^\s/>=]*\s*=?\s*", "")
    value = F.regexp_replace(written, r"""(?s)^(["'])(.*)\1$""", "$2")
    # most tags do not have it
    mentioned = F.lower(tag).contains(name)
    return F.when(mentioned, F.coalesce(unescape(value), F.lit(""))).otherwise("")


def related_link(html: Column, rel: str = "prev") -> Column:
    """href of the first ``<link>`` with this ``rel`` and a href; null without one."""
    related = F.filter(_tags(html), lambda tag: (_name(tag) == "link") & (attribute(tag, "rel") == rel))
    hrefs = F.filter(F.transform(related, lambda tag: attribute(tag, "href")), lambda h: h != "")
    return F.get(hrefs, F.lit(0))


def next_page(html: Column, url: Column, css_class: str = "next_page") -> Column:
    """href of the first ``<a>`` of this class, as a URL; null without one.

    A href from the root is joined to the page's scheme and host, one with a scheme
    stays, another replaces what follows the page's last slash.
    """
    fitting = F.filter(
        _tags(html),
        lambda tag: (_name(tag) == "a")
        & F.array_contains(F.split(attribute(tag, "class"), r"\s+"), css_class),
    )
    hrefs = F.filter(F.transform(fitting, lambda tag: attribute(tag, "href")), lambda h: h != "")
    href = F.get(hrefs, F.lit(0))
    root = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"^([^?#]*/)", 1)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("/"), F.concat(root, href))
        .otherwise(F.concat(folder, href))
    )


def sitemap(xml: Column) -> Column:
    """A sitemap document as a struct; its text is in field ``BROKEN`` if it is not well-formed."""
    return F.from_xml(xml, SITEMAP, {"columnNameOfCorruptRecord": BROKEN})


def sitemap_locs(document: Column) -> Column:
    """The ``urlset/url/loc`` texts of a parsed sitemap as an array."""
    return F.transform(document["url"], lambda url: url["loc"])
