"""Log lines as rows: level, time, message, run summaries and progress.  Works on batch and streaming text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Message codes that only clutter, and prefixes that carry nothing.
NOISE = ("FEATURE_ROLLOUT_DECIDED", "RESOURCE_ADMISSION_ALLOWED", "REQUEST_MODE_SELECTED", "parser_resource_gov_v1", '"run_id": "rollout_policy"')
PREFIXES = ("crawl_framework ", "sync_event ", "access_layer ", "resource_gov_event ")
SUMMARY_FIELDS = {"run_id": "run_id", "store": "store", "status": "status", "scraped_items": "scraped", "persisted_items": "persisted", "failed_pdp": "failed", "pages_visited": "pages"}


def level(line: Column) -> Column:
    return F.when(line.rlike(r" ERROR[: ]"), "ERROR").when(line.rlike(r" WARNING:| WARN "), "WARN").otherwise("INFO")


def is_noise(line: Column) -> Column:
    return line.rlike("|".join("\\Q" + x + "\\E" for x in NOISE))


#: Fields of a message's JSON object that its summary is made of.
EVENT = """event string, message_code string, store string, spider string, page string, extracted_count string, source_id string,
  canonical_url string, source_url string, category_url string, details struct<store_name: string>, metrics struct<page: string, product_links: string>,
  correlation struct<store_name: string, source_id: string, source_url: string, category_url: string>"""


def json_summary(j: Column) -> Column:
    """event store= page= items= source_id= url= of an EVENT struct; null without event."""
    get = lambda *paths: F.coalesce(*[F.nullif(j[p] if "." not in p else j[p.split(".")[0]][p.split(".")[1]], F.lit("")) for p in paths])
    event = get("event", "message_code")
    store = F.nullif(get("store", "spider", "correlation.store_name", "details.store_name"), F.lit("*"))
    parts = (
        ("store", store), ("page", get("page", "metrics.page")), ("items", get("extracted_count", "metrics.product_links")),
        ("source_id", get("source_id", "correlation.source_id")),
        ("url", get("canonical_url", "source_url", "category_url", "correlation.source_url", "correlation.category_url")),
    )
    return F.when(event.isNotNull(), F.concat_ws(" ", event, *[F.concat(F.lit(n + "="), v) for n, v in parts]))


def without_prefixes(message: Column) -> Column:
    """The message without the first occurrence of each prefix."""
    for p in PREFIXES:
        message = F.array_join(F.split(message, rf"\Q{p}\E", 2), "")
    return message


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """lines with time, level, message and noise.  A message's JSON is read once, into one struct."""
    line = F.col(column)
    dated = line.rlike(r"^20\S* \S+ .")
    rest = F.when(dated, F.regexp_extract(line, r"^\S+ \S+ (.*)$", 1)).otherwise(line)
    rows = lines.withColumns({"time": F.when(dated, F.regexp_extract(line, r"^\S+ (\S+) ", 1)).otherwise(""), "level": level(line), "message": without_prefixes(rest)})
    marked = F.nullif(F.regexp_extract("message", r"((?:UI_RUN_FINISH|scraper_db_saved).*)$", 1), F.lit(""))
    rows = rows.withColumns({"_marked": marked, "_event": F.from_json(F.regexp_extract("message", r"(\{.*)$", 1), EVENT)})
    message = F.coalesce("_marked", json_summary(F.col("_event")), "message")
    return rows.withColumns({"message": message, "noise": is_noise(line)}).drop("_marked", "_event")


def run_summaries(lines: DataFrame, column: str = "value") -> DataFrame:
    """A row for each summary line: run, store, status and counters."""
    line = F.col(column)
    get = lambda n: F.nullif(F.regexp_extract(line, rf"\b{n}=(\S+)", 1), F.lit(""))
    numbers = ("scraped", "persisted", "failed", "pages")
    fields = [(get(n).try_cast("long") if a in numbers else get(n)).alias(a) for n, a in SUMMARY_FIELDS.items()]
    return lines.filter(line.contains("scrape_run_summary ")).select(*fields)


def progress(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """Distinct saved products, listing pages, warnings and errors of each log."""
    line = F.col(column)
    saved = F.nullif(F.regexp_extract(line, r"raw_product_id=(\d+)", 1), F.lit(""))
    return lines.groupBy(*keys).agg(
        F.countDistinct(saved).alias("products"), F.count_if(line.contains("LISTING_PAGE")).alias("listing_pages"),
        F.count_if(level(line) == "WARN").alias("warnings"), F.count_if(level(line) == "ERROR").alias("errors"),
    )


def first_run_id(lines: DataFrame, keys: list[str], order: str, store: Column, column: str = "value") -> DataFrame:
    """The first run id in each log that begins with the log's store."""
    found = F.nullif(F.regexp_extract(F.col(column), r"\brun_id=(\S+)", 1), F.lit(""))
    rows = lines.withColumn("_run", found).filter(F.col("_run").startswith(F.concat(store, F.lit(":"))))
    return rows.groupBy(*keys).agg(F.min_by("_run", order).alias("run_id"))
