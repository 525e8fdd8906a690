"""Runs as rows: totals and status, crawl counters, run-wide status, ranked alerts, seeds of a crawl."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.operators.outbox import upsert

from tallyforge.operators.rollups import rate, severity_rank


def run_totals(items: DataFrame, keys: list[str], failed: Column, has_specs: Column, has_images: Column, finish: Column | None = None) -> DataFrame:
    """Items, failures, coverage of the items that were kept, and failed, partial_failure or completed."""
    kept = ~F.coalesce(failed, F.lit(False))
    reason = F.lit("finished") if finish is None else F.coalesce(F.max(finish), F.lit("finished"))
    out = items.groupBy(*keys).agg(
        F.count("*").alias("items_scraped"), F.count_if(kept).alias("items_persisted"), F.count_if(~kept).alias("items_failed"),
        F.count_if(kept & has_specs).alias("with_specs"), F.count_if(kept & has_images).alias("with_images"), reason.alias("_reason"),
    )
    status = F.when(F.col("_reason") != "finished", "failed").when(F.col("items_failed") > 0, "partial_failure").otherwise("completed")
    return out.withColumns({
        "spec_coverage": rate(F.col("with_specs"), F.col("items_persisted")), "image_coverage": rate(F.col("with_images"), F.col("items_persisted")), "status": status,
    }).drop("_reason")


def merged_counters(rows: DataFrame, run: str, name: str, value: str) -> DataFrame:
    """Counters of all sources of a run added up."""
    return rows.groupBy(run, name).agg(F.sum(value).alias(value))


def stressed(alerts: DataFrame, run: str, source: str, least: int = 2) -> DataFrame:
    """A run-wide alert for each domain in which at least so many sources have a high or critical one."""
    watched = alerts.filter(F.col("domain").isin("delivery_transport", "crm_apply") & (severity_rank(F.col("severity")) >= 2))
    by = watched.groupBy(run, "domain").agg(F.countDistinct(source).alias("n_sources")).filter(F.col("n_sources") >= least)
    code = F.when(F.col("domain") == "crm_apply", "GLOBAL_MULTI_STORE_CRM_APPLY_STRESS").otherwise("GLOBAL_MULTI_STORE_TRANSPORT_STRESS")
    return by.withColumns({"alert_code": code, "severity": F.lit("high")})


def worst_alerts(alerts: DataFrame, keys: list[str], most: int, tie: str) -> DataFrame:
    """The most severe alerts of each key."""
    w = W.partitionBy(*keys).orderBy(severity_rank(F.col("severity")).desc(), tie)
    return alerts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def by_stage(states: DataFrame, stages: list[str]) -> DataFrame:
    """(stage, names) for every stage, those without members included."""
    every = states.sparkSession.createDataFrame([(i, s) for i, s in enumerate(stages)], "pos int, stage string")
    by = states.groupBy("stage").agg(F.array_sort(F.collect_set("name")).alias("names"))
    none = F.array().cast("array<string>")
    return every.join(by, "stage", "left").select("pos", "stage", F.coalesce("names", none).alias("names"))


#: What blocks a release where it fails.
BLOCKING_GATES = ("critical", "high")
BLOCKING_CHECKS = ("unit", "contract", "acceptance", "compatibility", "regression")


def readiness(checks: DataFrame, gates: DataFrame) -> DataFrame:
    """(critical_failures, warnings, action) over checks (category, passed) and gates (severity, passed).

    Failed gates of other severities than critical, high and warning don't count; every failed check counts.
    """
    of = lambda df, kind: df.filter(~F.col("passed")).select(kind.alias("kind"))
    gate = F.when(F.col("severity").isin(*BLOCKING_GATES), "critical").when(F.col("severity") == "warning", "warning")
    check = F.when(F.col("category").isin(*BLOCKING_CHECKS), "critical").otherwise("warning")
    out = of(gates, gate).unionByName(of(checks, check)).agg(F.count_if(F.col("kind") == "critical").alias("critical_failures"), F.count_if(F.col("kind") == "warning").alias("warnings"))
    return out.withColumn("action", F.when(F.col("critical_failures") > 0, "block_release").when(F.col("warnings") > 0, "release_with_caution").otherwise("release"))


def seeds(targets: DataFrame, table: DataFrame) -> DataFrame:
    """(item, url): the seed URLs of each item's targets, from the first of these that gives any.

    targets: (item, explicit array, categories array, brands array, defaults array); table: (category, brand, url) with
    nulls where a URL stands for a category or a brand alone.
    """
    t = table
    c = targets.select("item", F.explode("categories").alias("category"))
    b = targets.select("item", F.explode("brands").alias("brand"))
    both = c.join(b, "item").join(t.filter("category is not null and brand is not null"), ["category", "brand"]).select("item", F.lit(1).alias("tier"), "url")
    by_category = c.join(t.filter("brand is null"), "category").select("item", F.lit(2).alias("tier"), "url")
    by_brand = b.join(t.filter("category is null"), "brand").select("item", F.lit(3).alias("tier"), "url")
    explicit = targets.select("item", F.lit(0).alias("tier"), F.explode("explicit").alias("url"))
    default = targets.select("item", F.lit(4).alias("tier"), F.explode("defaults").alias("url"))
    rows = explicit.unionByName(both).unionByName(by_category).unionByName(by_brand).unionByName(default).distinct()
    return rows.withColumn("_first", F.min("tier").over(W.partitionBy("item"))).filter("tier = _first").select("item", "tier", "url")


def registered(registry: DataFrame | None, runs: DataFrame, now: Column) -> DataFrame:
    """The registry with runs (run_id, store_name, spider_name, category_urls) as running ones.

    A run that is known already runs again and keeps when it started, its counters and its statistics.  A run may come
    once in a call.
    """
    zero = F.lit(0).cast("long")
    new = runs.select(
        "run_id", "store_name", "spider_name", now.alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"), F.lit("running").alias("status"),
        *[zero.alias(f"items_{c}") for c in COUNTED], F.to_json("category_urls").alias("category_urls_json"), F.lit("{}").alias("stats_json"), now.alias("created_at"), now.alias("updated_at"),
    )
    kept = ("started_at", "finished_at", *[f"items_{c}" for c in COUNTED], "stats_json", "created_at")
    return new if registry is None else upsert(registry, new, ["run_id"], kept)


#: The counters of a run, and the names that its statistics may have them under.
COUNTED = {"scraped": ("items_scraped", "item_scraped_count"), "persisted": ("items_persisted",), "failed": ("items_failed", "item_dropped_count")}


def finished(registry: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """The registry with the runs of results (run_id, status, stats map<string,string>) closed.

    Counters are the first of their names that is a number other than 0 in the statistics, else 0.  Results of runs that aren't
    registered change nothing; runs without a result stay as they are.
    """
    told = results.select("run_id", F.col("status").alias("_status"), F.col("stats").alias("_stats"))
    rows, closed = registry.join(told, "run_id", "left"), F.col("_status").isNotNull()
    values = {"finished_at": now, "updated_at": now, "status": F.col("_status"), "stats_json": F.to_json(F.coalesce("_stats", F.create_map().cast("map<string,string>")))}
    for c, names in COUNTED.items():
        known = [F.nullif(F.try_element_at("_stats", F.lit(n)).try_cast("long"), F.lit(0).cast("long")) for n in names]
        values[f"items_{c}"] = F.coalesce(*known, F.lit(0).cast("long"))
    return rows.withColumns({c: F.when(closed, v).otherwise(F.col(c)) for c, v in values.items()}).drop("_status", "_stats")
