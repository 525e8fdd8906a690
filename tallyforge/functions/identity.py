"""Keys, hashes and times that identify records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import clean_text
from tallyforge.functions.urls import entity_url, source_url

#: Fixed value: the URL name space of name-based identifiers.
URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def sha256(x: Column) -> Column:
    return F.sha2(x.cast("string"), 256)


def identity_key(store: Column, source_id: Column, url: Column) -> Column:
    """store:id, or store: and the first 16 hex digits of the URL's hash; the store in lower case."""
    name = F.lower(F.coalesce(clean_text(store), F.lit("unknown")))
    return F.concat(name, F.lit(":"), F.coalesce(clean_text(source_id), F.substring(sha256(source_url(url)), 1, 16)))


def entity_key(store: Column, source_id: Column, url: Column) -> Column:
    """As identity_key, with the store as it is and the URL in entity form."""
    own = F.nullif(F.trim(F.coalesce(source_id, F.lit(""))), F.lit(""))
    return F.concat(store, F.lit(":"), F.coalesce(own, F.substring(sha256(entity_url(url)), 1, 16)))


def canonical_json(*columns: Column, names: tuple[str, ...]) -> Column:
    """JSON of the columns with keys in order and nulls kept."""
    pairs = sorted(zip(names, columns), key=lambda p: p[0])
    return F.to_json(F.struct(*[c.alias(n) for n, c in pairs]), {"ignoreNullFields": "false"})


def payload_hash(*columns: Column, names: tuple[str, ...]) -> Column:
    return F.concat(F.lit("sha256:"), sha256(canonical_json(*columns, names=names)))


def idempotency_key(entity: Column, payload: Column, event_type: Column, scope: str = "entity_payload") -> Column:
    e, p = F.trim(F.coalesce(entity, F.lit(""))), F.trim(F.coalesce(payload, F.lit("")))
    t = F.trim(F.coalesce(F.nullif(event_type, F.lit("")), F.lit("product_found")))
    raw = F.concat_ws("|", e, t) if scope == "entity_only" else F.concat_ws("|", e, p, t)
    return F.concat(F.lit(f"idemp:v1:{scope}:"), F.substring(sha256(raw), 1, 48))


def event_idempotency_key(event_id: Column) -> Column:
    return F.concat(F.lit("idemp:v1:event_only:"), F.substring(sha256(F.concat(F.lit("event_only|"), event_id)), 1, 48))


def uuid5(name: Column, space: str = URL_SPACE) -> Column:
    """Name-based identifier, version 5."""
    h = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)) + 8))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant,
        F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def outbox_event_id(run_id: Column, identity: Column) -> Column:
    return uuid5(F.concat(F.lit("outbox:"), run_id, F.lit(":"), identity))


def hundredth(key: Column) -> Column:
    """0 to 99 from the first four bytes of the key's SHA-256."""
    return F.conv(F.substring(sha256(key), 1, 8), 16, 10).cast("long") % 100


def in_canary(key: Column, percent: Column) -> Column:
    return F.when(percent <= 0, False).when(percent >= 100, True).otherwise(hundredth(key) < percent)


def rollout_key(store: Column, entity: Column, feature: Column) -> Column:
    e, f = F.nullif(F.trim(entity), F.lit("")), F.nullif(F.trim(feature), F.lit(""))
    middle = F.coalesce(e, F.concat(F.lit("feature:"), f), F.lit("nostore"))
    return F.concat_ws("|", F.lower(F.trim(store)), middle, F.when(e.isNotNull(), f))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 in UTC with Z; no fraction where there are no microseconds.  The session's time zone must be UTC."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(part == "000000", "").otherwise(F.concat(F.lit("."), part)), F.lit("Z"))


def retry_after_seconds(raw: Column, now: Column) -> Column:
    """Seconds to wait, from a number or an HTTP date; never negative."""
    date = F.try_to_timestamp(F.regexp_replace(raw, r"^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    seconds = F.coalesce(F.trim(raw).try_cast("double"), (F.unix_timestamp(date) - F.unix_timestamp(now)).cast("double"))
    return F.greatest(seconds, F.lit(0.0))


def backoff_at(now: Column, attempt: Column, base_seconds: int = 15) -> Column:
    """now plus base * 2^(attempt - 1) seconds."""
    seconds = F.lit(base_seconds) * F.pow(F.lit(2.0), attempt - 1)
    return F.timestamp_seconds(F.unix_micros(now.cast("timestamp")) / F.lit(1e6).cast("double") + seconds)
