"""Maps and JSON documents: cleaning, tolerant reading, redaction, canonical text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import clean_text, is_frontend_noise

#: Key words whose values never leave the system.
SENSITIVE = r"token|secret|password|authorization|api_?key|signature|cookie|credential"


def clean_map(m: Column) -> Column:
    """Keys and values cleaned; empty ones dropped; of equal keys the last stays."""
    pairs = F.transform(F.map_entries(m), lambda e: F.struct(clean_text(e["key"]).alias("key"), clean_text(e["value"]).alias("value")))
    fine = F.filter(pairs, lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    last = F.aggregate(fine, F.array().cast("array<struct<key:string,value:string>>"), lambda acc, e: F.concat(F.filter(acc, lambda x: x["key"] != e["key"]), F.array(e)))
    return F.map_from_entries(last)


def clean_specs(m: Column, most: int = 500) -> Column:
    """Trimmed labels and values, empty ones dropped, values cut; the first of equal labels stays."""
    pairs = F.transform(F.map_entries(m), lambda e: F.struct(F.trim(e["key"]).alias("key"), F.substring(F.trim(e["value"]), 1, most).alias("value")))
    fine = F.filter(pairs, lambda e: (e["key"] != "") & F.coalesce(e["value"] != "", F.lit(False)))
    first = F.aggregate(fine, F.array().cast("array<struct<key:string,value:string>>"), lambda acc, e: F.when(F.exists(acc, lambda x: x["key"] == e["key"]), acc).otherwise(F.concat(acc, F.array(e))))
    return F.map_from_entries(first)


def without_noise(m: Column) -> Column:
    return F.map_filter(clean_map(m), lambda k, v: ~is_frontend_noise(k) & ~is_frontend_noise(v))


def present_only(m: Column) -> Column:
    return F.map_filter(m, lambda k, v: v.isNotNull() & (v != ""))


def redacted_map(m: Column, mask: str = "[REDACTED]") -> Column:
    return F.transform_values(m, lambda k, v: F.when(F.lower(k).rlike(SENSITIVE), F.lit(mask)).otherwise(v))


def redacted_json(json: Column, mask: str = "[REDACTED]") -> Column:
    """Scalar values of sensitive keys masked at any depth of a JSON text."""
    return F.regexp_replace(json, rf'(?i)("[^"]*(?:{SENSITIVE})[^"]*"\s*:\s*)("(?:[^"\\]|\\.)*"|-?[0-9.eE+]+|true|false|null)', f'$1"{mask}"')


def canonical_map_json(m: Column) -> Column:
    """JSON of a flat map with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def schema_version(json: Column, paths: tuple[str, ...] = ("$.schema_version", "$.publication.schema_version", "$.structured_payload.schema_version"), default: int = 1) -> Column:
    """First whole number at one of the paths."""
    return F.coalesce(*[F.get_json_object(json, p).try_cast("int") for p in paths], F.lit(default))


def object_or_empty(json: Column) -> Column:
    """The text if it is a JSON object, else {}."""
    return F.when(F.coalesce(F.from_json(json, "map<string,string>").isNotNull() & json.rlike(r"^\s*\{"), F.lit(False)), json).otherwise("{}")


def list_or_empty(json: Column) -> Column:
    return F.coalesce(F.from_json(json, "array<string>"), F.array().cast("array<string>"))


def as_text(value: Column, kind: str) -> Column:
    """Scalars as text, structures as JSON."""
    return F.to_json(value) if kind.startswith(("array", "map", "struct")) else value.cast("string")


def renamed(rows: DataFrame, aliases: dict[str, str], removed: tuple[str, ...] = (), both: bool = False) -> DataFrame:
    """Columns under their new names, or under both; removed ones dropped."""
    for old, new in aliases.items():
        if old in rows.columns:
            rows = rows.withColumn(new, F.col(old)) if both else rows.withColumnRenamed(old, new)
    return rows.drop(*removed)


def key_inventory(rows: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """(keys, field, n): the fields that JSON objects have, and in how many rows."""
    fields = rows.select(*keys, F.explode(F.json_object_keys(json)).alias("field"))
    return fields.groupBy(*keys, "field").agg(F.count("*").alias("n"))


def json_size(json: Column) -> Column:
    """struct<keys, leaves>: names and scalar values of a JSON text at all depths; null for a null text."""
    text = r'"(?:[^"\\]|\\.)*+"'
    named = text + r"\s*:"
    rest = F.regexp_replace(json, named, "")
    leaves = F.regexp_count(rest, F.lit(text + r"|-?\d[\d.eE+-]*|\b(?:true|false|null)\b"))
    return F.struct(F.regexp_count(json, F.lit(named)).alias("keys"), leaves.alias("leaves"))
