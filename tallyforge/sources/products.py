"""Product records from stored pages, by a profile of where a site keeps what.

A profile orders the places of each field; the first that has something wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.listings import known_brand
from tallyforge.functions.text import clean_text, visible_text
from tallyforge.sources.pages import images, inner, json_ld_nodes, meta, table_specs


@dataclass(frozen=True)
class Profile:
    title: tuple[str, ...] = ("ld", "h1", "og:title", "title")
    price: tuple[str, ...] = ("ld", "meta", "text")
    least_price: int = 0  # smaller numbers in texts are instalments, not prices
    largest_price: bool = False  # of several prices in the text the largest is meant
    id_prefixes: tuple[tuple[str, str], ...] = (("sku", "sku:"), ("productID", ""))


#: Words that say a product can't be had, and money in texts.
GONE = r"нет в наличии|out of stock"
MONEY = r"([0-9][0-9\s ]*)\s*(?:сум|сўм|sum|so'm|uzs)"


def ld_node(pages: DataFrame, key: str) -> DataFrame:
    """(key, node): the first node of a type Product or ProductGroup, a Product before a group."""
    nodes = json_ld_nodes(pages, key).filter(F.lower("type").isin("product", "productgroup"))
    order = F.struct(F.lower("type") != "product", F.col("block"))
    return nodes.groupBy(key).agg(F.min_by("node", order).alias("node"))


def from_ld(path: str) -> Column:
    return clean_text(F.get_json_object("node", path))


def text_price(html: Column, least: int, largest: bool) -> Column:
    amounts = F.transform(F.regexp_extract_all(visible_text(html, 100_000), F.lit("(?iu)" + MONEY), F.lit(1)), lambda m: F.regexp_replace(m, "[^0-9]", "").try_cast("long"))
    fine = F.filter(amounts, lambda x: x >= least)
    return (F.array_max(fine) if largest else F.try_element_at(fine, F.lit(1))).cast("string")


def full_products(pages: DataFrame, profile: Profile, key: str = "page_id") -> DataFrame:
    """One row a page: source_id, title, price_str, in_stock, brand, description, image_urls, specs."""
    rows = pages.select(key, "url", "html").join(ld_node(pages, key), key, "left")
    html = F.col("html")
    offer = lambda f: F.coalesce(from_ld(f"$.offers.{f}"), from_ld(f"$.offers[0].{f}"))
    titles = {"ld": from_ld("$.name"), "h1": inner(html, "h1"), "og:title": meta(html, "og:title"), "title": inner(html, "title")}
    told = offer("price")
    plausible = F.when(F.regexp_replace(told, r"\s", "").try_cast("double") >= profile.least_price, told)
    prices = {
        "ld": plausible, "meta": F.coalesce(meta(html, "product:price:amount"), meta(html, "og:price:amount"), meta(html, "price")),
        "text": text_price(html, profile.least_price, profile.largest_price),
    }
    available = F.lower(F.coalesce(offer("availability"), meta(html, "product:availability")))
    stock = F.when(available.isNotNull(), ~available.rlike("outofstock|discontinued|" + GONE)).otherwise(~F.lower(F.coalesce(html, F.lit(""))).rlike(GONE))
    ids = [F.concat(F.lit(prefix), from_ld(f"$.{name}")) for name, prefix in profile.id_prefixes]
    title = F.coalesce(*[titles[t] for t in profile.title])
    brand = F.coalesce(from_ld("$.brand.name"), F.when(~from_ld("$.brand").startswith("{"), from_ld("$.brand")))
    listed = F.from_json(F.get_json_object("node", "$.additionalProperty"), "array<struct<name:string,value:string>>")
    specs = F.transform(F.coalesce(listed, F.array().cast("array<struct<name:string,value:string>>")), lambda p: F.struct(p["name"].alias("label"), p["value"].alias("value")))
    return rows.select(
        key, "url", F.coalesce(*ids).alias("source_id"), title.alias("title"), F.coalesce(*[prices[p] for p in profile.price]).alias("price_str"), stock.alias("in_stock"),
        known_brand(title, brand).alias("brand"), F.coalesce(from_ld("$.description"), meta(html, "description"), F.lit("")).alias("description"),
        images(F.col("url"), html).alias("image_urls"), F.concat(specs, F.coalesce(table_specs(html), F.array().cast(specs_type()))).alias("specs"),
    )


def specs_type() -> str:
    return "array<struct<label:string,value:string>>"


def faq_answers(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, answer) of the questions in linked data."""
    nodes = json_ld_nodes(pages, key).filter("type = 'FAQPage'")
    items = F.from_json(F.get_json_object("node", "$.mainEntity"), "array<string>")
    return nodes.select(key, F.explode(items).alias("q")).select(key, clean_text(F.get_json_object("q", "$.acceptedAnswer.text")).alias("answer")).filter("answer is not null")


def named_values(pages: DataFrame, json: str, key: str) -> DataFrame:
    """(key, pos, label, value) of every object in a JSON document, at any depth, that has a name and a value or choices.

    The walk is recursive, so it runs in Python; only the key and the document go there.
    """
    import json as parser

    def text(v) -> str:
        return " ".join(str(v).split()) if isinstance(v, (str, int, float)) and not isinstance(v, bool) else ""

    def walk(node):
        todo = [node]
        while todo:
            x = todo.pop()
            if isinstance(x, dict):
                name, value = text(x.get("name")), text(x.get("value"))
                if name and value:
                    yield name, value
                if name and isinstance(x.get("choices"), list):
                    own = [text(c.get("name") if isinstance(c, dict) else c) for c in x["choices"]]
                    if any(own):
                        yield name, ", ".join(c for c in own if c)
                todo.extend(reversed(list(x.values())))
            elif isinstance(x, list):
                todo.extend(reversed(x))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, doc in zip(pdf["k"], pdf["doc"]):
                try:
                    found = list(walk(parser.loads(doc))) if doc else []
                except ValueError:
                    found = []
                rows += [(k, i, n, v) for i, (n, v) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["k", "pos", "label", "value"])

    docs = pages.select(F.col(key).cast("string").alias("k"), F.col(json).alias("doc"))
    out = docs.mapInPandas(run, "k string, pos int, label string, value string")
    return out.select(F.col("k").cast(pages.schema[key].dataType).alias(key), "pos", "label", "value")


def next_data(html: Column) -> Column:
    """JSON of the page's embedded state."""
    return F.nullif(F.regexp_extract(html, r"""(?is)<script[^>]*id=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""", 1), F.lit(""))
