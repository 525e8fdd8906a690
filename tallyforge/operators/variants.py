"""Merging what several parts of a page say about one product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.functions.text import squeeze


def first_source_wins(rows: DataFrame, keys: list[str], rank: str, pos: str, label: str, value: str, stop: tuple[str, ...] = ()) -> DataFrame:
    """One value for each label: that of the source with the lowest rank, and in it the first place.

    Labels over 90 and values over 220 characters, empty ones and stop words are left out.
    """
    clean = rows.withColumns({label: squeeze(F.col(label)), value: squeeze(F.col(value))})
    fine = (F.length(label).between(1, 90)) & (F.length(value).between(1, 220))
    if stop:
        fine &= ~F.lower(label).isin(*stop)
    w = W.partitionBy(*keys, label).orderBy(rank, pos, value)
    return clean.filter(fine).withColumn("_turn", F.row_number().over(w)).filter("_turn = 1").drop("_turn")


def matching_variant(variants: Column, source_id: Column, url: Column) -> Column:
    """Of array<struct<id, url, useful, ...>>: the one with the id, else with the URL, else the first useful, else the first."""
    by_id = F.filter(variants, lambda v: F.coalesce(v["id"] == source_id, F.lit(False)))
    by_url = F.filter(variants, lambda v: F.coalesce(F.rtrim(v["url"], F.lit("/")) == F.rtrim(url, F.lit("/")), F.lit(False)))
    useful = F.filter(variants, lambda v: F.coalesce(v["useful"], F.lit(False)))
    get = lambda a: F.try_element_at(a, F.lit(1))
    return F.coalesce(get(by_id), get(by_url), get(useful), get(variants))


def overlaid(group: Column, variant: Column) -> Column:
    """The variant's value unless it is empty, else the group's."""
    return F.coalesce(F.nullif(F.trim(variant), F.lit("")), group)


def merged_properties(*properties: Column) -> Column:
    """array<struct<name, value>> of all arrays, the first of each name (in any case) and value."""
    none = F.array().cast("array<struct<name:string,value:string>>")
    every = F.flatten(F.array(*[F.coalesce(p, none) for p in properties]))
    clean = F.transform(every, lambda p: F.struct(squeeze(p["name"]).alias("name"), squeeze(p["value"]).alias("value")))
    fine = F.filter(clean, lambda p: (p["name"] != "") & (p["value"] != ""))

    def add(acc, p):
        known = F.exists(acc, lambda x: (F.lower(x["name"]) == F.lower(p["name"])) & (x["value"] == p["value"]))
        return F.when(known, acc).otherwise(F.concat(acc, F.array(p)))

    return F.aggregate(fine, none, add)


def text_pairs(text: Column) -> Column:
    """array<struct<label, value>> of lines "label: value", "label:" with the value on the next line, and dotted leaders."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), squeeze), lambda x: x != "")
    after = F.concat(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), F.array(F.lit("")))

    def pair(line, nxt):
        inline = F.struct(F.trim(F.regexp_extract(line, r"^([^:]+):", 1)).alias("label"), F.trim(F.regexp_extract(line, r"^[^:]+:(.+)$", 1)).alias("value"))
        below = F.struct(F.trim(F.regexp_replace(line, ":$", "")).alias("label"), F.when(nxt.endswith(":"), "").otherwise(nxt).alias("value"))
        leader = F.struct(F.trim(F.regexp_extract(line, r"^(.{2,90}?)\s*[.·•]{2,}\s*(.{1,220})$", 1)).alias("label"), F.regexp_extract(line, r"^(.{2,90}?)\s*[.·•]{2,}\s*(.{1,220})$", 2).alias("value"))
        return F.when(line.endswith(":"), below).when(line.contains(":") & (F.length(line) < 220), inline).otherwise(leader)

    pairs = F.zip_with(lines, after, pair)
    return F.filter(pairs, lambda p: F.length(p["label"]).between(1, 90) & F.length(p["value"]).between(1, 220))


def streamed_text(html: Column) -> Column:
    """Text of streamed component chunks in a page, their escapes undone."""
    chunks = F.regexp_extract_all(html, F.lit(r'self\.__next_f\.push\(\[1,"([\s\S]*?)"\]\)'), F.lit(1))
    plain = F.transform(chunks, lambda c: F.replace(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\")))
    return F.array_join(plain, "\n")


def alternating_pairs(text: Column, heading: str, stop: tuple[str, ...] = ()) -> Column:
    """array<struct<label, value>> of lines after a heading that hold a label and its value in turn."""
    after = F.regexp_extract(text, rf"(?iuUs){heading}[^\n]*\n(.*)$", 1)
    lines = F.filter(F.transform(F.split(after, r"\r?\n"), squeeze), lambda x: x != "")
    if stop:
        end = F.array_position(F.transform(lines, lambda x: F.lower(x).isin(*stop)), True)
        lines = F.when(end > 0, F.slice(lines, 1, F.greatest((end - 1).cast("int"), F.lit(0)))).otherwise(lines)
    n = F.floor(F.size(lines) / 2).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(F.get(lines, i * 2).alias("label"), F.get(lines, i * 2 + 1).alias("value")))
