"""Admission rules for records: required fields, soft policy, targeting, contracts, and projections by purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import compact, present
from tallyforge.functions.urls import is_http

#: URL words that open or close a category for crawling.
OPEN_WORDS = r"smartfon|telefon|phone|noutbuk|laptop|notebook|planshet|tablet|televizor|tv|monitor|gaming|aksessuar|accessor|tehnika|electronics|gadget|audio"
CLOSED_WORDS = r"odezhda|obuv|clothes|shoes|mebel|furniture|produkty|food|kosmetika|cosmetic|knigi|books|igrushki|toys"


def missing_required(title: Column, url: Column, source: Column, source_id: Column) -> Column:
    identity = present(source_id) | present(url)
    return compact(*[F.when(~ok, F.lit(n)) for n, ok in (("title", present(title)), ("url", present(url)), ("source", present(source)), ("identity", identity))])


def missing_recommended(price: Column, brand: Column, images: Column, specs: Column, category: Column) -> Column:
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    rules = (("price", ~present(price)), ("brand", ~present(brand)), ("image_urls", none(images)), ("raw_specs", none(specs)), ("category_hint", ~present(category)))
    return compact(*[F.when(bad, F.lit(n)) for n, bad in rules])


def admission(required: Column, recommended: Column) -> Column:
    """ok, partial or drop."""
    return F.when(F.size(required) > 0, "drop").when(F.size(recommended) > 0, "partial").otherwise("ok")


def split_valid(rows: DataFrame, required: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that may go on, and those set aside with what they lack."""
    rows = rows.withColumn("_missing", required)
    return rows.filter(F.size("_missing") == 0).drop("_missing"), rows.filter(F.size("_missing") > 0).withColumnRenamed("_missing", "missing")


def in_targets(value: Column, wanted: str | None) -> Column:
    """Membership in a list of names split at commas, semicolons or line ends; no list wants everything."""
    names = [x.strip().lower() for x in (wanted or "").replace(";", ",").replace("\n", ",").split(",") if x.strip()]
    return F.coalesce(F.lower(F.trim(value)).isin(*names), F.lit(False)) if names else F.lit(True)


def optional(**filters) -> Column:
    """Conjunction of equality filters; those that are None don't narrow, lists mean membership."""
    out = F.lit(True)
    for name, value in filters.items():
        if isinstance(value, (list, tuple)):
            out = out & F.col(name).isin(*value) if value else out
        elif value is not None:
            out = out & (F.col(name) == value)
    return F.coalesce(out, F.lit(False))


def is_electronics_url(url: Column) -> Column:
    u = F.lower(F.coalesce(url, F.lit("")))
    return u.rlike(OPEN_WORDS) & ~u.rlike(CLOSED_WORDS)


def contract_errors(event_id: Column, event_type: Column, url: Column, payload_hash: Column, title: Column) -> Column:
    """Names of the rules that a delivery event breaks, joined by "; "; empty if none."""
    rules = (
        ("event_id is empty", ~present(event_id)), ("event_type is empty", ~present(event_type)), ("source_url is not http", ~is_http(url)),
        ("payload_hash is malformed", ~F.coalesce(payload_hash.rlike("^sha256:[0-9a-f]{64}$"), F.lit(False))), ("title is empty", ~present(title)),
    )
    return F.array_join(compact(*[F.when(bad, F.lit(n)) for n, bad in rules]), "; ")


def minimized(rows: DataFrame, allowed: list[str], most_chars: int = 500, most_items: int = 20) -> DataFrame:
    """Only allowed columns, long strings and arrays cut."""
    kinds = dict(rows.dtypes)
    out = []
    for c in allowed:
        if kinds.get(c) == "string":
            out.append(F.substring(c, 1, most_chars).alias(c))
        elif kinds.get(c, "").startswith("array"):
            out.append(F.slice(c, 1, most_items).alias(c))
        elif c in kinds:
            out.append(F.col(c))
    return rows.select(*out)
