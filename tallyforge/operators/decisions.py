"""Rule decisions over records: back-off, page classes, lifecycle events, delivery results, slow stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import compact, visible_text
from tallyforge.functions.urls import piece

#: Fixed values of the back-off rules.
RETRIED = {408: "http_408_timeout", 429: "http_429_exponential", 500: "http_500_server_error", 502: "http_502_bad_gateway", 503: "http_503_upstream_error", 504: "http_504_gateway_timeout"}
BASE_WAIT, MOST_WAIT, MOST_COOLDOWN = 1.0, 90.0, 300.0
#: Markers of pages that are no content.
CHALLENGE = r"cf-chl|cf_chl|challenge-platform|checking your browser|just a moment"
CAPTCHA = r"captcha|recaptcha|hcaptcha|g-recaptcha"
SCRIPT_APPS = r"__next|react|webpack|__nuxt"
SOFT_404 = r"\b404\s+not\s+found\b|товар\s+не\s+найден|страница\s+не\s+найдена|page\s+not\s+found|product\s+unavailable"
SLOW_MS = {"request": 3000, "product_parse": 1000, "normalize": 500, "crm_send": 2000, "batch_apply": 3000}


def backoff(status: Column, failures: Column, retry_after: Column | None = None, remaining: Column | None = None, reset: Column | None = None) -> Column:
    """struct<reason, retry, wait, cooldown, actions> for an HTTP status after so many failures."""
    nothing = F.lit(None).cast("double")
    retry_after, reset = (nothing if c is None else c.cast("double") for c in (retry_after, reset))
    spent = F.lit(False) if remaining is None else F.coalesce(remaining == 0, F.lit(False))
    wait = F.least(F.lit(MOST_WAIT), F.lit(BASE_WAIT) * F.pow(F.lit(2.0), F.greatest(failures, F.lit(0))))
    told = F.greatest(wait, retry_after, F.when(spent, reset))
    reason = F.lit("policy_not_applicable")
    for code, name in RETRIED.items():
        reason = F.when(status == code, F.lit(name)).otherwise(reason)
    reason = F.when((status == 429) & retry_after.isNotNull(), "http_429_retry_after").when((status == 429) & spent & reset.isNotNull(), "http_429_ratelimit_reset").otherwise(reason)
    reason = F.when(status == 403, "http_403_forbidden").otherwise(reason)
    retry = status.isin(*RETRIED)
    waits = F.when(status == 429, told).when(retry, wait).otherwise(0.0)
    cool = F.when(status == 403, F.least(F.lit(MOST_COOLDOWN), F.greatest(wait, F.lit(5.0)))).when(status.isin(429, 503), F.least(F.lit(MOST_COOLDOWN), waits)).otherwise(0.0)
    actions = F.when(status == 403, "rotate_proxy,rotate_session").when(status.isin(429, 503), "domain_cooldown").otherwise("")
    return F.struct(reason.alias("reason"), retry.alias("retry"), waits.alias("wait"), cool.alias("cooldown"), actions.alias("actions"))


def page_class(status: Column, content_type: Column, html: Column, url: Column, requested: Column, small: int = 256) -> Column:
    """The one signal that a page is no content, in a fixed order; null for content."""
    low, kind = F.lower(F.coalesce(html, F.lit(""))), F.lower(F.coalesce(content_type, F.lit("")))
    size, seen = F.octet_length(F.coalesce(html, F.lit(""))), F.length(visible_text(html))
    marked = low.contains("<html") | low.contains("<!doctype")
    mobile = piece(F.lower(url), "authority").startswith("m.") & ~piece(F.lower(requested), "authority").startswith("m.")
    captcha = low.rlike(CAPTCHA)
    gateway = status.isin(502, 503, 504) | ((status == 200) & low.rlike("bad gateway|service unavailable|gateway time") & (kind.contains("html") | kind.isin("", "text/plain")))
    shell = (status == 200) & ~kind.contains("json") & (size >= 80) & marked & (((F.regexp_count(low, F.lit("<script")) >= 3) & (seen < 120) & low.rlike(SCRIPT_APPS)) | low.rlike("enable javascript|javascript is required"))
    empty = (status == 200) & ~kind.contains("json") & (size < small) & ((size == 0) | (marked & (seen < 40) & ~low.rlike("refresh|location")))
    return (
        F.when(F.coalesce(mobile, F.lit(False)), "mobile_redirect")
        .when(low.rlike(CHALLENGE) & status.isin(200, 403, 503) & ~((status == 403) & captcha), "cloudflare_challenge")
        .when(captcha, "captcha").when(status == 403, "access_denied").when(gateway, "transport_like_error_page")
        .when(shell, "js_shell").when(empty, "empty_shell")
    )


def product_tags(status: Column, html: Column, title: Column, source_id: Column, price: Column, n_specs: Column, n_images: Column, in_stock: Column) -> Column:
    """Ordered tags of what is odd about a product page."""
    from tallyforge.functions.text import present

    has_title, has_price = present(title), present(price)
    rules = (
        ("deleted_product_404", status == 404), ("product_soft_404", (status == 200) & visible_text(html).rlike("(?iuU)" + SOFT_404)),
        ("missing_title", ~has_title), ("missing_source_id", ~present(source_id)), ("missing_price", ~has_price), ("specs_missing", n_specs == 0),
        ("image_only_product", has_title & (n_images > 0) & ~has_price), ("out_of_stock_with_price", (in_stock == False) & has_price),  # noqa: E712
        ("old_price_only", price.rlike("(?iu)было|was") & price.rlike(r"\d")),
    )
    return compact(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules])


def change_hint(price: Column, in_stock: Column, n_specs: Column) -> Column:
    return F.when(in_stock == False, "stock_update").when(price.isNotNull(), "price_update").when(F.coalesce(n_specs, F.lit(0)) == 0, "new_product")  # noqa: E712


def requested_event(hint: Column, deltas: bool = False, price: bool = False, stock: bool = False, specs: bool = False) -> Column:
    """Event that a hint asks for; with deltas off, as they are by default, always product_found."""
    out = F.lit("product_found")
    for on, name, event in ((specs, "spec_update", "characteristic_added"), (stock, "stock_update", "out_of_stock"), (price, "price_update", "price_changed")):
        out = F.when(F.coalesce(hint == name, F.lit(False)), F.lit(event)).otherwise(out) if on and deltas else out
    return out


def lifecycle(requested: Column, listing_id: Column, product_id: Column, spec_signal: Column, deltas: bool = True) -> Column:
    """struct<selected, fallback, reason>: the event asked for if its ids are known, else product_found and why not."""
    known = requested.isin("price_changed", "out_of_stock", "characteristic_added")
    reason = (
        F.when(~known, F.lit(None).cast("string"))
        .when(F.lit(not deltas), "runtime_delta_events_disabled")
        .when(requested.isin("price_changed", "out_of_stock") & listing_id.isNull(), "missing_crm_listing_id")
        .when((requested == "characteristic_added") & product_id.isNull(), "missing_crm_product_id")
        .when((requested == "characteristic_added") & ~F.coalesce(spec_signal, F.lit(False)), "insufficient_spec_change_signal")
    )
    fine = F.coalesce(known, F.lit(False)) & reason.isNull()
    return F.struct(F.when(fine, requested).otherwise("product_found").alias("selected"), reason.isNotNull().alias("fallback"), reason.alias("reason"))


def delivery_result(status: Column, ok: Column, action: Column) -> Column:
    """struct<result, retryable> of a delivery by its HTTP status and the row that answers it."""
    result = (
        F.when(status.isNull(), "transport_failed").when(status.isin(408, 425, 429) | (status >= 500), "retryable_failed")
        .when(status >= 400, "rejected").when(~F.coalesce(ok, F.lit(False)), "rejected").when(action == "ignored", "ignored").otherwise("applied")
    )
    return F.struct(result.alias("result"), result.isin("transport_failed", "retryable_failed").alias("retryable"))


def http_failure(status: Column, body: Column) -> Column:
    """struct<domain, type> of a failed request."""
    text = F.lower(F.coalesce(body, F.lit("")))
    transport = status.isNull() | status.isin(408, 429) | (status >= 500) | (status < 400)
    malformed = (status == 422) | text.rlike("malformed|invalid json")
    kind = (
        F.when(status.isin(408, 504), "timeout").when(transport, "http_error").when(malformed, "malformed_response")
        .when(text.rlike("reject|validation"), "rejected_item").otherwise("http_error")
    )
    domain = F.when(status.isNull() | status.isin(408, 429) | (status >= 500), "transport").when(malformed | (status >= 400), "crm_apply").otherwise("transport")
    return F.struct(domain.alias("domain"), F.coalesce(kind, F.lit("http_error")).alias("type"))


def applied_status(action: Column, ok: Column) -> Column:
    """What an answered row says was done."""
    a = F.lower(F.coalesce(action, F.lit("")))
    return F.when(~ok, "rejected").when(a.isin("created", "updated", "ignored"), a).when(a.isin("matched", "needs_review"), "matched").otherwise("applied")


def row_succeeded(success: Column, status: Column) -> Column:
    words = F.lower(status.cast("string")).isin("ok", "success", "synced", "created", "updated", "matched", "applied", "true")
    return F.coalesce(success, F.lit(False)) | F.coalesce(words | status.try_cast("int").between(200, 299), F.lit(False))


def replay_mode(event_type: Column, mode: Column, has_ids: Column) -> Column:
    """struct<mode, reason>: deltas fall back to a snapshot where the ids they need are unknown."""
    blocked = (event_type != "product_found") & (mode == "delta_if_possible") & ~has_ids
    return F.struct(F.when(blocked, "snapshot_upsert").otherwise(mode).alias("mode"), F.when(blocked, "delta_requires_runtime_ids").alias("reason"))


def resolved_id(response: Column, runtime: Column, catalog: Column) -> Column:
    """struct<id, source>: the first id known, from the response, the run's state, or the catalogue; else a resend."""
    found = F.coalesce(response, runtime, catalog)
    source = F.when(response.isNotNull(), "response").when(runtime.isNotNull(), "runtime").when(catalog.isNotNull(), "catalog").otherwise("resend")
    return F.struct(found.alias("id"), source.alias("source"))


def is_slow(stage: Column, ms: Column) -> Column:
    limit = F.lit(None).cast("int")
    for name, value in SLOW_MS.items():
        limit = F.when(stage == name, F.lit(value)).otherwise(limit)
    return F.coalesce(ms > limit, F.lit(False))


def replay_guard(n_types: Column, safe: Column, items: Column, batches: Column, most_items: int = 20, most_batches: int = 3) -> Column:
    return F.when(n_types != 1, "mixed_event_types").when(~safe, "unsafe_event_type").when(items > most_items, "too_many_items").when(batches > most_batches, "too_many_batches").otherwise("allowed")
