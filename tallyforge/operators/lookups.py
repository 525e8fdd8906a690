"""Joins: rule tables, anti joins, ordinal and nearest-in-time matches, differences of metrics and contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.operators.windows import micros


def fits_scope(rule: Column, value: Column) -> Column:
    """A rule without a scope fits everything."""
    return rule.isNull() | (rule == value)


def ranked_rules(labels: DataFrame, rules: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """The best rule for each label and target field.

    labels: (item, label, category, store); rules: (label, field, priority, category, store, deprecated).  Rules are
    ranked by priority, then store-scoped before general, then category-scoped before general, then by field name.
    fields, a table (field): labels that are a field's own name map to it directly, past all rules.
    The rule table is configuration, bounded and broadcast.
    """
    r = rules.select(*[F.col(c).alias(f"rule_{c}") for c in rules.columns])
    hit = (F.col("label") == F.col("rule_label")) & fits_scope(F.col("rule_category"), F.col("category")) & fits_scope(F.col("rule_store"), F.col("store"))
    joined = labels.join(F.broadcast(r), hit)
    rank = W.partitionBy("item", "label", "rule_field").orderBy(
        F.col("rule_priority").desc(), F.col("rule_store").isNull(), F.col("rule_category").isNull(), "rule_field"
    )
    best = joined.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1")
    best = best.select("item", "label", F.col("rule_field").alias("field"), F.col("rule_priority").alias("priority"), F.lit(False).alias("direct"))
    if fields is None:
        return best
    direct = labels.join(F.broadcast(fields.select(F.col("field").alias("_field"))), F.col("label") == F.col("_field"))
    direct = direct.select("item", "label", F.col("_field").alias("field"), F.lit(None).cast("int").alias("priority"), F.lit(True).alias("direct")).distinct()
    return direct.unionByName(best.join(direct.select("item", "label"), ["item", "label"], "left_anti"))


def with_default(rows: DataFrame, table: DataFrame, key: str, default: str = "unknown") -> DataFrame:
    """Dimension lookup in a small table; keys that it lacks get the row of the default member."""
    values = [c for c in table.columns if c != key]
    fallback = F.broadcast(table.filter(F.col(key) == default).select(*[F.col(c).alias(f"_{c}") for c in values]).limit(1))
    out = rows.join(table, key, "left").join(fallback, F.lit(True), "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in values}).drop(*[f"_{c}" for c in values])


def unseen(rows: DataFrame, seen: DataFrame, *keys: str) -> DataFrame:
    return rows.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def nearest_in_time(left: DataFrame, right: DataFrame, by: list[str], ts: str, other_ts: str, left_key: str, tie: str, seconds: int = 300) -> DataFrame:
    """For each row of left the row of right with equal `by` whose time is nearest, within seconds.

    A range join as an equality join: rows of right are copied into the bucket of their time and its neighbours, so
    only rows at most two buckets apart meet.  Ties go to the smaller `tie`.
    """
    bucket = F.floor(F.unix_timestamp(F.col(ts)) / seconds)
    other = F.floor(F.unix_timestamp(F.col(other_ts)) / seconds)
    a = left.withColumn("_bucket", bucket)
    b = right.withColumn("_bucket", F.explode(F.array(other - 1, other, other + 1)))
    joined = a.join(b, [*by, "_bucket"]).withColumn("_gap", F.abs(micros(ts) - micros(other_ts)))
    joined = joined.filter(F.col("_gap") <= seconds * 1_000_000)
    w = W.partitionBy(left_key).orderBy("_gap", tie)
    return joined.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank", "_bucket").withColumn("gap_seconds", F.col("_gap") / 1e6).drop("_gap")


def ordinal_zip(left: DataFrame, right: DataFrame, key: str, pos: str) -> DataFrame:
    """Rows of left with those of right at the same place of the same key; places that right lacks are null."""
    return left.join(right, [key, pos], "left")


def metric_diff(base: DataFrame, now: DataFrame, key: str, value: str) -> DataFrame:
    """(key, baseline, current, change_pct, kind) of a full outer match; change is null on a zero or missing baseline."""
    b, c = base.select(key, F.col(value).alias("baseline")), now.select(key, F.col(value).alias("current"))
    out = b.join(c, key, "full_outer")
    kind = F.when(F.col("baseline").isNull(), "added").when(F.col("current").isNull(), "removed").when(F.col("baseline") == F.col("current"), "same").otherwise("changed")
    change = F.when(F.col("baseline") != 0, F.round((F.col("current") - F.col("baseline")) / F.col("baseline") * 100, 4))
    return out.select(key, "baseline", "current", change.alias("change_pct"), kind.alias("kind"))


def visible_links(links: DataFrame, page: str = "page_id", url: str = "url", hidden: str = "hidden") -> DataFrame:
    """Links of each page without those seen hidden only.

    A page that would lose more than 80 % of at least three links keeps them all.
    """
    by = links.groupBy(page, url).agg(F.bool_and(hidden).alias("trap"))
    share = by.groupBy(page).agg(F.count("*").alias("n"), F.count_if("trap").alias("traps"))
    bypass = (F.col("n") >= 3) & (F.col("traps") > 0.8 * F.col("n"))
    return by.join(share, page).filter(bypass | ~F.col("trap")).select(page, url, bypass.alias("bypassed"))
