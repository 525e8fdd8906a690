"""Operating policies over metric rows: back-pressure, bottlenecks, roll-out of features, gates, roll-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.identity import in_canary, rollout_key
from tallyforge.functions.text import compact
from tallyforge.operators.windows import last_n

#: Fixed values of the policies.
MEMORY_WARN, MEMORY_CRITICAL = 384.0, 512.0
QUEUE_WARN, QUEUE_CRITICAL = 100, 200
BATCHES_WARN, BATCHES_CRITICAL = 3, 4
SLOW_STAGES = (("crawl_request", "avg_request_ms", 3000.0), ("normalize", "avg_normalize_ms", 500.0), ("crm_send", "avg_crm_send_ms", 2000.0), ("crm_apply_parse", "avg_batch_apply_ms", 3000.0))
STAGES = ("disabled", "canary", "partial", "full")


def backpressure(memory_mb: Column, queued: Column, batches: Column, queue_limit: Column) -> Column:
    """struct<apply, reason, severity, action>, the first rule that holds."""
    def out(apply, reason, severity, action):
        return F.struct(F.lit(apply).alias("apply"), F.lit(reason).alias("reason"), F.lit(severity).alias("severity"), F.lit(action).alias("action"))

    return (
        F.when(memory_mb >= MEMORY_CRITICAL, out(True, "memory_critical", "critical", "degrade_store"))
        .when(queued >= F.least(F.lit(QUEUE_CRITICAL), queue_limit), out(True, "retryable_queue_critical", "critical", "pause_batches"))
        .when(queued >= QUEUE_WARN, out(True, "retryable_queue_elevated", "high", "slow_down"))
        .when(batches >= BATCHES_CRITICAL, out(True, "batch_inflight_critical", "critical", "pause_batches"))
        .when(batches >= BATCHES_WARN, out(True, "batch_inflight_elevated", "warning", "slow_down"))
        .when(memory_mb >= MEMORY_WARN, out(True, "memory_warning", "warning", "reduce_browser"))
        .otherwise(out(False, "nominal", "warning", "slow_down"))
    )


def throttle(browser: Column, proxy: Column, most_browser: Column, most_proxy: Column) -> Column:
    """struct<mode, new_limit, reason> where browser pages or proxied requests are used up."""
    return F.struct(
        F.when(browser >= most_browser, "browser").when(proxy >= most_proxy, "proxy").otherwise("http").alias("mode"),
        F.when(browser >= most_browser, F.greatest(F.lit(0), most_browser - 1)).when(proxy >= most_proxy, F.greatest(F.lit(0), most_proxy - 1)).alias("new_limit"),
        F.when(browser >= most_browser, "browser_pages_saturated").when(proxy >= most_proxy, "proxy_requests_saturated").otherwise("no_throttle").alias("reason"),
    )


def in_flight(rows: DataFrame, keys: list[str], started: Column) -> DataFrame:
    """Work begun and not ended, never below zero."""
    return rows.groupBy(*keys).agg(F.greatest(F.sum(F.when(started, 1).otherwise(-1)), F.lit(0)).alias("in_flight"))


def bottlenecks(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each stage whose average is over its limit, and for sources that yield under two products a minute."""
    have = set(snapshots.columns)
    parts = [
        F.when(F.col(c) > limit, F.struct(F.lit(stage).alias("stage"), F.col(c).cast("double").alias("observed"), F.lit(limit).alias("limit_value"), F.lit("high").alias("severity")))
        for stage, c, limit in SLOW_STAGES if c in have
    ]
    if {"products_per_minute", "products_total"} <= have:
        slow = (F.col("products_total") >= 10) & (F.col("products_per_minute") < 2.0)
        parts.append(F.when(slow, F.struct(F.lit("product_parse").alias("stage"), F.col("products_per_minute").alias("observed"), F.lit(2.0).alias("limit_value"), F.lit("warning").alias("severity"))))
    return snapshots.select(*keys, F.inline(compact(*parts)))


def narrower(a: Column, b: Column) -> Column:
    """The more cautious of two stages."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, STAGES)), s)
    return F.element_at(F.array(*map(F.lit, STAGES)), F.least(rank(a), rank(b)).cast("int"))


def rollout(feature: Column, store: Column, entity: Column, feature_stage: Column, store_stage: Column, failing: Column, percent: Column) -> Column:
    """struct<stage, enabled, reason>: stages narrow each other, bad health narrows to canary, canaries go by their hash."""
    stage = narrower(feature_stage, store_stage)
    stage = F.when(failing & stage.isin("full", "partial"), "canary").otherwise(stage)
    chosen = in_canary(rollout_key(store, entity, feature), percent)
    enabled = F.when(stage == "disabled", False).when(stage == "full", True).otherwise(chosen)
    reason = F.when(stage == "disabled", "effective_stage_disabled").when(~enabled, "canary_not_selected")
    return F.struct(stage.alias("stage"), enabled.alias("enabled"), reason.alias("reason"))


def gates(flags: DataFrame, results: DataFrame) -> DataFrame:
    """Every gate (gate, flag, severity) with whether its flag (flag, ok) is set; one that is missing fails."""
    out = flags.join(results, "flag", "left").withColumn("passed", F.coalesce("ok", F.lit(False)))
    return out.select("gate", "passed", F.when(F.col("passed"), "info").otherwise(F.col("severity")).alias("severity"))


def batch_summary(results: DataFrame, keys: list[str]) -> DataFrame:
    failed = ~F.col("success")
    return results.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count_if("success").alias("succeeded"), F.count_if(failed).alias("failed"),
        F.count_if(failed & F.col("retryable")).alias("retryable_failed"), F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.count_if(F.col("status") == "ignored").alias("ignored"),
    )


def baseline(snapshots: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, value): means of the sources' means, nulls left out; metrics without any value have no row."""
    means = snapshots.agg(*[F.avg(m).alias(m) for m in metrics])
    return means.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]))).filter("value is not null")


def rollback(critical: Column, rates: dict[str, tuple[Column, float]]) -> Column:
    """Names of the triggers that fire: three critical alerts, or a rate over its limit."""
    return compact(F.when(critical >= 3, F.lit("critical_transport_apply")), *[F.when(rate > limit, F.lit(name)) for name, (rate, limit) in rates.items()])


def health(counters: DataFrame, keys: list[str]) -> DataFrame:
    """healthy, degraded or failing from weighted signals of counters and recent traces."""
    have = set(counters.columns)
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)
    failing = (
        F.when(n("critical_traces") >= 1, 2).otherwise(0) + F.when((n("malformed_traces") >= 2) | (n("reconciliation_failed_total") >= 3), 2).otherwise(0)
        + F.when((n("transport_failures_total") >= 5) & (n("crm_rejected_total") >= 5), 2).otherwise(0)
    )
    signs = (
        (n("error_traces") >= 5) | (n("crm_retryable_total") >= 10), (n("block_pages_total") >= 3) | (n("crawl_failures_total") >= 20),
        n("normalization_low_coverage_total") >= 15, n("duplicate_payload_skipped_total") >= 50, n("delivery_retries_total") >= 15, n("unreconciled_traces") >= 3,
    )
    degraded = n("block_page_traces") + sum((F.when(s, 1).otherwise(0) for s in signs), F.lit(0))
    status = F.when(failing >= 2, "failing").when((failing >= 1) | (degraded >= 2), "degraded").otherwise("healthy")
    return counters.select(*keys, status.alias("health"))


def bottleneck_document(signals: DataFrame, keys: list[str], observed: str, tie: str, most: int = 12) -> DataFrame:
    """(keys, document): JSON with the signals (stage, severity, store_name, ...) counted by stage and severity, and the slowest.

    Counts are added up by stage and severity first, and only `most` signals a key are put in order, so no key's
    signals meet in one row.
    """
    counts = signals.groupBy(*keys, "stage", "severity").agg(F.count("*").alias("n"))
    by = lambda name: counts.groupBy(*keys, name).agg(F.sum("n").alias("n")).groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias(f"counts_by_{name}"), F.sum("n").alias("total_signals")
    )
    slow = last_n(signals, keys, [F.col(observed).desc(), F.col(tie)], most)
    shown = [c for c in signals.columns if c not in (*keys, tie)]
    # One sortable struct a signal: the slowest first, its place told by the negative figure.
    top = slow.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col(observed)).alias("_o"), F.col(tie).alias("_t"), F.struct(*shown).alias("signal")))).alias("_top"))
    rows = by("stage").join(by("severity").drop("total_signals"), keys).join(top, keys)
    document = F.to_json(F.struct(
        F.lit("bottleneck_summary_v1").alias("kind"), "total_signals", "counts_by_stage", "counts_by_severity",
        F.transform("_top", lambda x: x["signal"]).alias("top_signals"),
    ))
    return rows.select(*keys, document.alias("document"))
