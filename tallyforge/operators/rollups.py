"""Roll-ups over runs and sources: rates against service levels, alerts, costs, efficiency, quality gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.windows import micros

#: Fixed values: (metric, numerator, denominator, empty rate, comparison, limit, severity).
SERVICE_LEVELS = (
    ("parse_success_rate", "product_items_yielded_total", "parse_attempts_total", 0.0, "lt", 0.90, "high"),
    ("apply_success_rate", "crm_applied_total", "delivery_items_total", 1.0, "lt", 0.95, "high"),
    ("block_page_rate", "block_pages_total", "listing_pages_seen_total", 0.0, "gt", 0.10, "critical"),
    ("zero_result_category_rate", "categories_zero_result_total", "categories_started_total", 0.0, "gt", 0.20, "warning"),
    ("low_coverage_rate", "normalization_low_coverage_total", "normalization_items_total", 0.0, "gt", 0.35, "warning"),
    ("rejected_item_rate", "crm_rejected_total", "delivery_items_total", 0.0, "gt", 0.15, "high"),
    ("retryable_failure_rate", "crm_retryable_total", "delivery_items_total", 0.0, "gt", 0.10, "warning"),
    ("malformed_response_rate", "malformed_batch_responses_total", "delivery_batches_total", 0.0, "gt", 0.05, "critical"),
    ("unresolved_reconciliation_rate", "reconciliation_failed_total", "reconciliation_started_total", 0.0, "gt", 0.05, "critical"),
    ("duplicate_payload_skip_rate", "duplicate_payload_skipped_total", "delivery_items_total", 0.0, "gt", 0.50, "info"),
)
MIN_ITEMS = 20
SEVERITY = {"info": 0, "warning": 1, "high": 2, "critical": 3}
DOMAIN = {
    "block_page_rate": "store_access", "zero_result_category_rate": "store_access", "parse_success_rate": "crawl_quality",
    "low_coverage_rate": "normalization_quality", "apply_success_rate": "crm_apply", "rejected_item_rate": "crm_apply",
    "retryable_failure_rate": "crm_apply", "malformed_response_rate": "delivery_transport",
    "unresolved_reconciliation_rate": "reconciliation", "duplicate_payload_skip_rate": "internal", "min_items_per_active_store": "internal",
}
COST_WEIGHTS = {
    "http_requests": 1.0, "proxy_requests": 2.0, "browser_pages": 5.0, "retry_attempts": 1.5, "batch_flushes": 0.5,
    "crm_roundtrips": 1.0, "normalization_units": 0.5, "diagnostic_units": 0.2,
}
GATES = (
    ("field_presence_threshold", "field_presence", "ge", 0.75), ("parse_success_threshold", "parse_success", "ge", 0.60),
    ("duplicate_ratio_threshold", "duplicate_ratio", "le", 0.35), ("partial_item_ratio_threshold", "partial_ratio", "le", 0.55),
    ("banned_response_threshold", "banned_rate", "le", 0.10), ("pagination_loop_threshold", "pagination_loops", "le", 5.0),
    ("zero_result_category_threshold", "zero_categories", "le", 10.0),
)


def rate(numerator: Column, denominator: Column, empty: float = 0.0) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(empty))


def number(name: str, have: set) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in have else F.lit(0.0)


def severity_rank(x: Column) -> Column:
    out = F.lit(0)
    for name, rank in SEVERITY.items():
        out = F.when(x == name, F.lit(rank)).otherwise(out)
    return out


def severity_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SEVERITY]), (rank + 1).cast("int"))


def counters_wide(rows: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    return rows.groupBy(*keys).pivot(name, names).agg(F.sum(value)).fillna(0, names)


def service_levels(counters: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key and service level, from one row of counters a key; absent counters are 0."""
    have = set(counters.columns)
    yielded, failed = number("product_items_yielded_total", have), number("product_parse_failed_total", have)
    pages, errors = number("crawl_product_pages_total", have), number("crawl_failures_total", have)
    by_items = yielded + failed > 0
    listing = number("listing_pages_seen_total", have)
    own = {
        "parse_success_rate": (F.when(by_items, yielded).otherwise(pages), F.when(by_items, yielded + failed).otherwise(pages + errors)),
        "block_page_rate": (number("block_pages_total", have), F.when(listing > 0, listing).otherwise(number("crawl_listing_pages_total", have))),
    }
    rows = []
    for metric, top, bottom, empty, comparison, limit, severity in SERVICE_LEVELS:
        n, d = own.get(metric, (number(top, have), number(bottom, have)))
        observed = F.round(rate(n, d, empty), 6)
        breached = observed < limit if comparison == "lt" else observed > limit
        rows.append((metric, observed, limit, comparison, breached, F.lit(severity)))
    items = number("delivery_items_total", have)
    rows.append(("min_items_per_active_store", items, float(MIN_ITEMS), "lt", items < MIN_ITEMS, F.when(items > 0, "warning").otherwise("info")))
    packed = [
        F.struct(
            F.lit(m).alias("metric"), o.alias("observed"), F.lit(li).alias("limit_value"), F.lit(c).alias("comparison"),
            b.alias("breached"), F.when(b, s).alias("severity"),
        )
        for m, o, li, c, b, s in rows
    ]
    return counters.select(*keys, F.inline(F.array(*packed)))


def refined_severity(metric: Column, observed: Column, limit: Column) -> Column:
    """Severity from how far beyond its limit a metric is."""
    gap, over, short = F.abs(observed - limit), observed - limit, limit - observed
    steep = F.when((gap > 0.15) | (observed > limit * 3), "critical").when(gap > 0.05, "high").otherwise("warning")
    return (
        F.when(metric.isin("block_page_rate", "malformed_response_rate", "unresolved_reconciliation_rate"), steep)
        .when((metric == "duplicate_payload_skip_rate") & (observed > 0.85), "high")
        .when(metric.isin("low_coverage_rate", "duplicate_payload_skip_rate"), F.when(gap > 0.25, "warning").otherwise("info"))
        .when(metric.isin("parse_success_rate", "apply_success_rate"), F.when(short > 0.15, "critical").when(short > 0.08, "high").otherwise("warning"))
        .when(metric == "rejected_item_rate", F.when(over > 0.2, "critical").when(over > 0.08, "high").otherwise("warning"))
        .when(metric == "retryable_failure_rate", F.when(over > 0.15, "high").otherwise("warning"))
        .when(metric == "zero_result_category_rate", F.when(over > 0.25, "high").otherwise("warning"))
        .otherwise("warning")
    )


def alert_domain(metric: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in DOMAIN.items() for v in kv]), metric), F.lit("internal"))


def alerts(levels: DataFrame) -> DataFrame:
    """A row for each breached level, with code, domain and the worse of both severities."""
    m, o, li = F.col("metric"), F.col("observed"), F.col("limit_value")
    worse = severity_name(F.greatest(severity_rank(refined_severity(m, o, li)), severity_rank(F.col("severity"))))
    out = levels.filter("breached").withColumns({"alert_code": F.concat(F.lit("THRESHOLD_BREACHED:"), m), "domain": alert_domain(m), "severity": worse})
    text = F.format_string("%s breached SLO (observed=%.4f, threshold=%.4f, cmp=%s)", m, o, li, F.col("comparison"))
    return out.withColumn("message", text)


def service_status(levels: DataFrame, keys: list[str]) -> DataFrame:
    """healthy, degraded or failing by the worst severity among a key's breached levels."""
    worst = F.coalesce(F.max(F.when(F.col("breached"), severity_rank(F.col("severity")))), F.lit(0))
    out = levels.groupBy(*keys).agg(worst.alias("worst"), F.count_if("breached").alias("n_breached"))
    return out.withColumn("status", F.when(F.col("worst") >= 3, "failing").when(F.col("worst") >= 1, "degraded").otherwise("healthy"))


def incident_domain(found: DataFrame, keys: list[str], first: str) -> DataFrame:
    """Domain of a key's first critical alert, else the most frequent among the high ones, else among all.

    Ties go to the domain seen first by the column `first`.
    """
    rank = F.when(F.col("severity") == "critical", 2).when(F.col("severity") == "high", 1).otherwise(0)
    by = found.withColumn("_class", rank).groupBy(*keys, "_class", "domain").agg(F.count("*").alias("n"), F.min(first).alias("_first"))
    order = F.struct("_class", F.when(F.col("_class") == 2, F.lit(0)).otherwise(F.col("n")), -F.col("_first"))
    return by.groupBy(*keys).agg(F.max_by("domain", order).alias("incident_domain"))


def cost_units(have: set) -> Column:
    out = F.lit(0.0)
    for name, weight in COST_WEIGHTS.items():
        out = out + F.lit(weight) * number(name, have)
    return out


def cost_snapshot(counters: DataFrame, keys: list[str]) -> DataFrame:
    """Cost units, yields, efficiency signals and status of each key, from one row of counters a key."""
    have = set(counters.columns)
    rows = counters.withColumn("cost_units", cost_units(have))
    cost = F.greatest(F.col("cost_units"), F.lit(1e-9))
    parsed, applied = number("products_parsed", have), number("products_applied", have)
    rows = rows.withColumns({
        "products_per_unit": F.when((parsed > 0) & (F.col("cost_units") > 0), parsed / F.col("cost_units")),
        "applied_per_unit": F.when((applied > 0) & (F.col("cost_units") > 0), applied / F.col("cost_units")),
    })
    browser, retry, proxy, crm = (F.lit(COST_WEIGHTS[n]) * number(n, have) / cost for n in ("browser_pages", "retry_attempts", "proxy_requests", "crm_roundtrips"))
    requests = number("http_requests", have) + number("proxy_requests", have) + number("browser_pages", have)

    def signal(cond, code, severity):
        return F.when(cond, F.struct(F.lit(code).alias("code"), (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity")))

    signals = F.array_compact(F.array(
        signal(F.col("products_per_unit") < 0.5, "low_products_per_cost_unit", "high"),
        signal(F.col("applied_per_unit") < 0.4, "low_applied_per_cost_unit", "warning"),
        signal(browser > 0.30, "browser_overuse", F.when(browser > 0.30 * 1.3, "high").otherwise("warning")),
        signal(retry > 0.20, "retry_overuse", F.when(retry > 0.20 * 1.5, "critical").otherwise("high")),
        signal(proxy > 0.40, "proxy_overuse", F.when(proxy < 0.40 * 1.2, "warning").otherwise("high")),
        signal((crm > 0.35) & (applied > 0), "crm_roundtrip_heavy", "warning"),
        signal((requests > 0) & (parsed > 0) & (parsed / requests < 0.05) & (F.col("cost_units") > 10), "expensive_low_yield_store", "high"),
    ))
    rows = rows.withColumn("signals", signals)
    has = lambda s: F.exists("signals", lambda x: x["severity"] == s)
    status = (
        F.when(has("critical"), "critical").when(has("high"), "expensive").when(has("warning"), "acceptable")
        .when((F.col("cost_units") > 0) & (F.col("products_per_unit") >= 1.0), "efficient").otherwise("acceptable")
    )
    return rows.select(*keys, "cost_units", "products_per_unit", "applied_per_unit", F.transform("signals", lambda x: x["code"]).alias("signal_codes"), status.alias("status"))


def run_cost(snapshot: DataFrame, run: str, store: str) -> DataFrame:
    """Totals of a run, its five dearest and five least efficient stores, and the worst status among them."""
    rank = F.when(F.col("status") == "efficient", 0).when(F.col("status") == "acceptable", 1).when(F.col("status") == "expensive", 2).otherwise(3)
    from pyspark.sql.window import Window as W

    dear = F.row_number().over(W.partitionBy(run).orderBy(F.col("cost_units").desc(), store))
    weak = F.row_number().over(W.partitionBy(run).orderBy(F.coalesce("products_per_unit", F.lit(-1.0)), store))
    ranked = snapshot.withColumns({"_dear": dear, "_weak": weak, "_rank": rank})
    return ranked.groupBy(run).agg(
        F.sum("cost_units").alias("total_cost_units"),
        F.transform(F.array_sort(F.collect_list(F.when((F.col("_dear") <= 5) & (F.col("cost_units") > 0), F.struct("_dear", store)))), lambda x: x[store]).alias("highest_cost"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_weak") <= 5, F.struct("_weak", store)))), lambda x: x[store]).alias("lowest_efficiency"),
        F.max_by("status", "_rank").alias("overall_status"),
    )


def regression(baseline: Column, current: Column, allowed_pct: Column, lower_is_worse: Column) -> Column:
    """struct<passed, regression_pct, reason> of a metric against its baseline."""
    pct = F.when(lower_is_worse, baseline - current).otherwise(current - baseline) / F.abs(baseline) * 100
    worse = F.when(lower_is_worse, current < baseline * (1 - allowed_pct / 100)).otherwise(current > baseline * (1 + allowed_pct / 100))
    both, from_zero = (baseline == 0) & (current == 0), (baseline == 0) & (current != 0)
    return F.struct(
        F.when(both, True).when(from_zero, False).otherwise(~worse).alias("passed"),
        F.when(both, 0.0).when(from_zero, 100.0).otherwise(pct).alias("regression_pct"),
        F.when(both, "both_zero").when(from_zero, "baseline_zero_nonzero_current").when(worse, "regression_beyond_allowed_delta").otherwise("within_tolerance").alias("reason"),
    )


def quality_gates(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key and gate, from columns of ratios named as in GATES; and `passed` for all of a key's gates."""
    packed = [
        F.struct(F.lit(g).alias("gate"), F.col(c).cast("double").alias("value"), F.lit(t).alias("threshold"), (F.col(c) >= t if op == "ge" else F.col(c) <= t).alias("pass"))
        for g, c, op, t in GATES
    ]
    rows = metrics.withColumn("_gates", F.array(*packed)).withColumn("passed", F.forall("_gates", lambda g: g["pass"]))
    return rows.select(*keys, "passed", F.inline("_gates"))


def stage_averages(rows: DataFrame, keys: list[str], stage: str, value: str) -> DataFrame:
    return rows.groupBy(*keys, stage).agg(F.count(value).alias("n"), F.avg(value).alias("avg_ms"))


def per_minute(rows: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Rows a minute between a key's first and last; null where that is no time at all."""
    span = (micros(F.max(ts)) - micros(F.min(ts))) / 60e6
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), span.alias("_minutes"))
    return out.select(*keys, "n", F.when(F.col("_minutes") > 1e-9, F.col("n") / F.col("_minutes")).alias("per_minute"))


def status_counts(rows: DataFrame, keys: list[str], status: str, known: list[str]) -> DataFrame:
    """Counts of the known states, `other`, total, and whether all rows are in the last known state."""
    counts = [F.count_if(F.col(status) == s).alias(s) for s in known]
    other = F.count_if(~F.coalesce(F.col(status).isin(*known), F.lit(False))).alias("other")
    out = rows.groupBy(*keys).agg(*counts, other, F.count("*").alias("total"))
    return out.withColumn("complete", (F.col("total") > 0) & (F.col(known[-1]) == F.col("total")))
