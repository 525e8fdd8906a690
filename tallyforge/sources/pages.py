"""Product fields from stored pages, as column expressions over their HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import clean_text, compact, ordered_distinct, squeeze
from tallyforge.functions.units import let
from tallyforge.functions.urls import crawl_url, is_http, piece


def decoded(x: Column) -> Column:
    """The five predefined character references and no-break spaces."""
    for name, char in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        x = F.replace(x, F.lit(f"&{name};"), F.lit(char))
    return x


def inner(html: Column, tag: str) -> Column:
    """Text of the first element of that name, tags inside left out; null if there is none."""
    raw = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    return clean_text(decoded(F.regexp_replace(raw, "(?s)<[^>]+>", " ")))


def meta(html: Column, name: str) -> Column:
    raw = F.regexp_extract(html, rf"""(?is)<meta\b[^>]*(?:property|name|itemprop)=["']{name}["'][^>]*content=["']([^"']*)["']""", 1)
    return clean_text(decoded(raw))


def json_ld(html: Column) -> Column:
    """Variants of all linked-data blocks that parse, lists and graphs taken apart by json_ld_nodes."""
    blocks = F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    return F.filter(F.transform(blocks, lambda b: F.trim(b)), lambda b: b != "")


def json_ld_nodes(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, block, type, node) of every object in the blocks: the block itself, list items, or items of its @graph."""
    blocks = pages.select(key, F.posexplode(json_ld(F.col(html))).alias("block", "json"))
    items = F.when(F.col("json").startswith("["), F.from_json("json", "array<string>")).otherwise(
        F.coalesce(F.from_json(F.get_json_object("json", "$['@graph']"), "array<string>"), F.array("json"))
    )
    nodes = blocks.select(key, "block", F.explode(items).alias("node"))
    return nodes.select(key, "block", F.get_json_object("node", "$['@type']").alias("type"), "node")


def products(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The first Product node of each page: name, sku, brand, price, availability."""
    nodes = json_ld_nodes(pages, key, html).filter("type = 'Product'")
    first = nodes.groupBy(key).agg(F.min_by("node", "block").alias("node"))
    get = lambda path: clean_text(F.get_json_object("node", path))
    brand = F.coalesce(get("$.brand.name"), get("$.brand"))
    return first.select(key, get("$.name").alias("title"), get("$.sku").alias("sku"), brand.alias("brand"), get("$.offers.price").alias("price"), F.lower(get("$.offers.availability")).contains("instock").alias("in_stock"))


def title(html: Column) -> Column:
    return F.coalesce(inner(html, "h1"), meta(html, "og:title"), inner(html, "title"))


def links(html: Column) -> Column:
    """Targets of all links, in order, distinct."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*\shref=["']([^"'#][^"']*)["']"""), F.lit(1))
    return ordered_distinct(F.transform(found, lambda u: F.trim(decoded(u))))


def absolute(base: Column, link: Column) -> Column:
    """link seen from base: absolute, host-relative, root-relative or relative to base's folder."""
    origin = F.concat(F.lower(piece(base, "scheme")), F.lit("://"), piece(base, "authority"))
    folder = F.regexp_replace(piece(base, "path"), "[^/]*$", "")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(piece(base, "scheme"), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link)).otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
    )


def images(base: Column, html: Column, most: int = 100) -> Column:
    """Absolute addresses of images, distinct, without inline data, vector graphics and icons."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)<img\b[^>]*\ssrc=["']([^"']+)["']"""), F.lit(1))
    full = F.transform(found, lambda u: absolute(base, F.trim(decoded(u))))
    fine = F.filter(full, lambda u: is_http(u) & ~F.lower(u).rlike(r"^data:|\.svg($|\?)|\.ico($|\?)"))
    return F.slice(F.array_distinct(fine), 1, most)


def table_specs(html: Column) -> Column:
    """array<struct<label, value>> of table rows with two cells and of definition lists."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"), F.lit(1)))
    clean = lambda x: squeeze(decoded(F.regexp_replace(x, "(?s)<[^>]+>", " ")))
    pairs = F.transform(F.filter(cells, lambda c: F.size(c) == 2), lambda c: F.struct(clean(c[0]).alias("label"), clean(c[1]).alias("value")))
    return F.filter(pairs, lambda p: (p["label"] != "") & (p["value"] != "") & (F.length(p["label"]) <= 90) & (F.length(p["value"]) <= 220))


def sitemap_urls(xml: Column) -> Column:
    found = F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda u: crawl_url(decoded(u))))


def fields_present(html: Column) -> Column:
    return compact(*[F.when(c.isNotNull(), F.lit(n)) for n, c in (("title", title(html)), ("description", meta(html, "description")))])


#: Rows of a specification block by their classes, and the longest label and value.
SPEC_ROWS = (
    r'(?is)<p[^>]*max-w-\[320px\][^>]*>(.*?)</p>\s*<div[^>]*whitespace-break-spaces[^>]*>(.*?)</div>',
    r'(?is)<div[^>]*border-b[^>]*>\s*<div[^>]*>\s*<p[^>]*>(.*?)</p>\s*<div[^>]*whitespace-break-spaces[^>]*>(.*?)</div>',
)
LONGEST_LABEL, LONGEST_VALUE = 140, 320


def bare(x: Column) -> Column:
    """Text of a piece of HTML, null where there is none."""
    return clean_text(decoded(F.regexp_replace(x, "(?s)<[^>]+>", " ")))


def row_specs(html: Column) -> Column:
    """array<struct<label, value>> of rows that carry the classes of a specification block, the first of a label winning."""
    fine = lambda p: p["label"].isNotNull() & p["value"].isNotNull() & (F.length(p["label"]).between(1, LONGEST_LABEL)) & (F.length(p["value"]).between(1, LONGEST_VALUE))

    def found(page: Column) -> Column:
        out = []
        for pattern in SPEC_ROWS:
            sides = [F.transform(F.regexp_extract_all(page, F.lit(pattern), F.lit(i)), bare) for i in (1, 2)]
            out.append(F.zip_with(*sides, lambda k, v: F.struct(k.alias("label"), v.alias("value"))))
        return F.filter(F.concat(*out), fine)

    def first_of_label(rows: Column) -> Column:
        return let(F.transform(rows, lambda p: p["label"]), lambda labels: F.filter(rows, lambda p, i: F.array_position(labels, p["label"]) == i + 1))

    # Each step is bound, else it would be worked out again wherever it is named, in lambdas for every row found.
    return let(F.replace(html, F.lit("\\/"), F.lit("/")), lambda page: let(found(page), first_of_label))
