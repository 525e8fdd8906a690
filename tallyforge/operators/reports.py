"""Reports over runs: evidence, causes, ranked work, quality summaries, deprecations, import rules, migrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.operators.ranks import positions

#: What to do about an incident, by its domain.
ACTIONS = {
    "store_access": "degrade", "crawl_quality": "degrade", "normalization_quality": "continue", "crm_apply": "degrade",
    "delivery_transport": "degrade", "reconciliation": "degrade", "internal": "continue",
}


def ranked_work(items: DataFrame) -> DataFrame:
    """Items (blocking, priority, phase_order, workstream, code) with their rank: blockers first, then by priority and phase."""
    blockers = F.when(F.col("blocking"), 0).otherwise(1)
    return positions(items, [blockers, "priority", "phase_order", "workstream", "code"], "rank")


def evidence(traces: DataFrame, batches: DataFrame, keys: list[str], order: str, limit: int = 8) -> DataFrame:
    """Half of the limit from the last 80 traces that failed, the rest from the last 15 batches that failed."""
    def last(rows, n):
        return rows.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(F.col(order).desc()))).filter(F.col("_k") <= n).drop("_k")

    a = last(traces, 80).filter("failed").withColumn("kind", F.lit(0))
    b = last(batches, 15).filter("failed").withColumn("kind", F.lit(1))
    a = a.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).filter(F.col("_n") <= limit // 2).drop("_n")
    both = a.select(*keys, "kind", order).unionByName(b.select(*keys, "kind", order))
    turn = F.row_number().over(W.partitionBy(*keys).orderBy("kind", order))
    return both.withColumn("turn", turn).filter(F.col("turn") <= limit)


def confidence(n: Column, has_alerts: Column) -> Column:
    return F.lit(0.55) + F.least(F.lit(0.35), F.lit(0.05) * n) + F.when(has_alerts, 0.05).otherwise(0.0)


def root_cause(traces: DataFrame, keys: list[str], order: str, domain: str = "domain") -> DataFrame:
    """Cause of each key's incident from the codes of its last 40 traces."""
    w = W.partitionBy(*keys).orderBy(F.col(order).desc())
    tail = traces.withColumn("_k", F.row_number().over(w)).filter("_k <= 40")
    code = F.col("code")
    by = tail.groupBy(*keys, domain).agg(
        F.count_if((code == "BLOCK_PAGE") & (F.col("_k") <= 30)).alias("blocked"), F.count_if(code == "CRAWL_FAILURE").alias("failed"),
        F.count_if(code == "CRM_APPLY_REJECTED").alias("rejected"), F.count_if((code == "CRM_APPLY_RETRYABLE") & (F.col("_k") <= 20)).alias("retryable"),
        F.count_if((code == "RECONCILIATION_UNRESOLVED") & (F.col("_k") <= 30)).alias("unresolved"), F.count("*").alias("n"),
    )
    d = F.col(domain)
    cause = (
        F.when((d == "store_access") & (F.col("blocked") > 0), "block page spike").when((d == "crawl_quality") & (F.col("failed") * 2 > F.col("n")), "crawl failures")
        .when((d == "crm_apply") & (F.col("rejected") >= 3), "rejected item surge").when((d == "crm_apply") & (F.col("retryable") > 0), "retryable items")
        .when((d == "reconciliation") & (F.col("unresolved") > 0), "unresolved events").otherwise(F.concat(d, F.lit(" degraded")))
    )
    return by.select(*keys, domain, cause.alias("cause"))


def action_for(domain: Column, critical: Column) -> Column:
    out = F.lit("continue")
    for name, action in ACTIONS.items():
        out = F.when(domain == name, F.lit(action)).otherwise(out)
    return F.when(critical, "disable_store").otherwise(out)


def may_run(enabled: Column, status: Column) -> Column:
    return F.coalesce(enabled, F.lit(True)) & (F.coalesce(status, F.lit("healthy")) != "failing")


def quality_summary(fields: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of confident, suppressed and conflicting fields from resolved fields (score, least, reason)."""
    kept = F.col("reason").isNull()
    return fields.groupBy(*keys).agg(
        F.count_if(kept & (F.col("score") >= F.col("least"))).alias("confident"), F.count_if(F.col("reason") == "suppressed_by_confidence").alias("low_confidence"),
        F.count_if(~kept).alias("suppressed"), F.count_if(F.col("reason") == "suppressed_by_conflict").alias("conflicts"),
    )


def deprecated_uses(flat: DataFrame, notices: DataFrame, key: str) -> DataFrame:
    """Deprecated paths (path, replacement) that flattened records (key, path) still have."""
    return flat.join(notices, "path").groupBy(key, "path", "replacement").agg(F.count("*").alias("n"))


def migration(levels: DataFrame, deprecated: DataFrame, key: str) -> DataFrame:
    """What each surface's changes call for."""
    uses = deprecated.groupBy(key).agg(F.count("*").alias("deprecated"))
    out = levels.join(uses, key, "left").fillna(0, ["deprecated"])
    return out.withColumn("advice", F.when(F.col("level") == "breaking", "dual_shape").when(F.col("deprecated") > 0, "warn_then_remove").otherwise("none"))


def import_edges(sources: DataFrame, module: str = "module", text: str = "text") -> DataFrame:
    """(module, imported) for each import in Python sources: all names of a list, relative ones seen from the module."""
    sources = sources.select(F.col(module).alias("_module"), F.col(text).alias("_text"))
    lists = F.regexp_extract_all(F.col("_text"), F.lit(r"(?m)^[ \t]*import[ \t]+([^\n#;]+)"), F.lit(1))
    plain = F.flatten(F.transform(lists, lambda names: F.split(names, ",")))
    plain = F.transform(plain, lambda n: F.regexp_extract(n, r"^\s*([\w.]+)", 1))
    origins = F.regexp_extract_all(F.col("_text"), F.lit(r"(?m)^[ \t]*from[ \t]+(\.*[\w.]*)[ \t]+import\b"), F.lit(1))
    parts = F.split(F.col("_module"), r"\.")

    def seen(origin: Column) -> Column:
        dots = F.length(F.regexp_extract(origin, r"^(\.*)", 1))
        base, rest = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - dots, F.lit(0))), F.regexp_replace(origin, r"^\.+", "")
        return F.when(dots == 0, origin).otherwise(F.array_join(F.filter(F.concat(base, F.array(rest)), lambda x: x != ""), "."))

    found = F.array_distinct(F.filter(F.concat(plain, F.transform(origins, seen)), lambda x: x != ""))
    return sources.select(F.col("_module").alias("module"), F.explode(found).alias("imported")).distinct()


def import_violations(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Edges that a rule (layer, forbidden) excludes, layers being the first part of a module's name."""
    rows = edges.withColumns({"layer": F.substring_index("module", ".", 1), "forbidden": F.substring_index("imported", ".", 1)})
    return rows.join(rules, ["layer", "forbidden"]).select("module", "imported")


def migrated(old: DataFrame, ids: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Old rows under their new ids (old_id, new_id); orphans and rows that are there already are left out."""
    rows = old.join(ids, old[key] == ids["old_id"]).drop("old_id", key).withColumnRenamed("new_id", key)
    return rows.join(existing.select(key), key, "left_anti")


def message_counts(rows: DataFrame, keys: list[str], code: str, names: dict[str, str]) -> DataFrame:
    """Counters by message code; codes without a counter are left out."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    named = rows.withColumn("counter", F.try_element_at(table, F.col(code))).filter("counter is not null")
    return named.groupBy(*keys, "counter").agg(F.count("*").alias("n"))


def is_html(content_type: Column, disposition: Column | None = None) -> Column:
    """Whether a response is text to be parsed, not a download."""
    kind = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    attached = F.lit(False) if disposition is None else F.coalesce(F.lower(disposition).contains("attachment"), F.lit(False))
    return ((kind == "") | kind.startswith("text/") | (kind == "application/xhtml+xml")) & ~attached


def first_header(headers: Column, names: tuple[str, ...]) -> Column:
    """Value of the first of several synonymous headers that is there, names in any case."""
    low = F.map_from_entries(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    return F.coalesce(*[F.try_element_at(low, F.lit(n.lower())) for n in names])


def single_safe_type(types: Column, allowed: tuple[str, ...] = ("product_found",)) -> Column:
    """Whether an array of event types is one type, and one that may be replayed."""
    own = F.array_distinct(F.transform(types, lambda t: F.lower(F.trim(t))))
    return F.coalesce((F.size(own) == 1) & F.arrays_overlap(own, F.array(*map(F.lit, allowed))), F.lit(False))


def lenient_time(x: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(x), F.try_to_timestamp(F.replace(x, F.lit("Z"), F.lit("+00:00"))))


def duration_ms(start: Column, end: Column) -> Column:
    return F.greatest(F.lit(0), (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1000)


def human_status(name: Column, status: Column, n_alerts: Column, domain: Column, most: int = 200) -> Column:
    return F.substring(F.concat(name, F.lit(": "), status, F.lit(", "), n_alerts.cast("string"), F.lit(" alerts"), F.when(domain.isNotNull(), F.concat(F.lit(", mainly "), domain)).otherwise("")), 1, most)
