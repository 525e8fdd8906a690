"""Listings walked over stored pages: every listing's chain of next pages, and the products that are found first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.scratch import forget, stored

#: Steps of one length that are taken before longer ones are made of them.
STRIDE = 8


def walked(pages: DataFrame, seeds: DataFrame, most_pages: int) -> DataFrame:
    """(url, seed, depth) of the listing pages that a walk from each seed (column seed) reaches, the seed at depth 1.

    pages: url, next_url.  A page leads to one next page; pages that aren't stored end the walk, and so does a page
    that the walk, or that of another seed with a shorter or equal way, has seen before.  At most `most_pages` pages of
    a seed.

    Only walks go from page to page, over steps that are dealt out by url once for STRIDE of them; the pages beyond a
    walk's end are not followed.  For more pages the steps are joined to steps of STRIDE pages, then of its square and so on,
    so a thousand pages in a row cost a dozen rounds.
    """
    held = pages.select("url", "next_url").filter("url is not null").groupBy("url").agg(F.min("next_url").alias("next_url"))
    starts = seeds.select(F.col("seed").alias("url"), F.lit(True).alias("first")).filter("url is not null").distinct()
    # Of several pages that lead to one the smallest url counts, so every page has one walk that it belongs to.
    into = held.filter("next_url is not null and next_url <> url").groupBy(F.col("next_url").alias("url")).agg(F.min("url").alias("up"))
    # A seed is a beginning of its own: what leads into it is no way to it.
    places = held.select("url").join(starts, "url", "left").join(into, "url", "left").filter("first or up is not null")
    places = stored(places.select("url", F.when(F.col("first").isNull(), F.col("up")).alias("up")), "walk-places")
    walks = places.filter("up is null").select("url", F.col("url").alias("seed"), F.lit(1).cast("long").alias("depth")).filter(F.col("depth") <= most_pages)
    steps, span = places.filter("up is not null").select(F.col("up").alias("a"), F.col("url").alias("b")), 1
    # Steps are as many as pages, and each join has the same rows of them: so one shuffle serves a stride, at any size.
    dealt = lambda x: x.filter("a is not null and b is not null").hint("merge")
    while span < most_pages:
        front = walks
        for _ in range(min(STRIDE, -(-most_pages // span)) - 1):
            front = front.filter(F.col("depth") + span <= most_pages).join(dealt(steps), F.col("url") == F.col("a"))
            front = front.select(F.col("b").alias("url"), "seed", (F.col("depth") + span).alias("depth"))
            walks = walks.unionByName(front)
        span *= STRIDE
        if span < most_pages:
            walks, longer = stored(walks, "walk-pages"), leaps(steps)
            if longer.isEmpty():
                break
            steps = longer
    return walks


def leaps(steps: DataFrame) -> DataFrame:
    """Steps (a, b) of STRIDE steps each, by doubling."""
    at, made = 1, None
    while at < STRIDE:
        on = steps.select(F.col("a").alias("b"), F.col("b").alias("c"))
        steps, before = stored(steps.join(on, "b").select("a", F.col("c").alias("b")), "walk-steps"), made
        if before is not None:
            forget(before)
        at, made = at * 2, steps
    return steps


def found_products(walks: DataFrame, links: DataFrame) -> DataFrame:
    """(product_url, seed, depth, position): each product where it is seen first, by depth, seed and place in the page.

    links: url, position, product_url.
    """
    rows = walks.join(links, "url").filter("product_url is not null")
    first = F.min(F.struct("depth", "seed", "position"))
    return rows.groupBy("product_url").agg(first.alias("f")).select("product_url", "f.seed", "f.depth", "f.position")
