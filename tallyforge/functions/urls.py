"""URL forms as column expressions.  Pieces come from one generic pattern, so bad input gives nulls, not errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import clean_text, literal_pattern

PIECES = {
    "scheme": r"^([A-Za-z][A-Za-z0-9+.-]*):",
    "authority": r"^(?:[^:/?#]+:)?//([^/?#]*)",
    "path": r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)",
    "query": r"^[^?#]*\?([^#]*)",
    "fragment": r"^[^#]*#(.*)$",
}
#: Query parameters that only track.
TRACKING = (
    "fbclid", "gclid", "yclid", "openstat", "_openstat", "igshid", "mc_cid", "mc_eid", "mkt_tok", "si", "spm", "ved", "gs_lcp",
    "ref", "referrer", "fb_action_ids", "fb_action_types", "fb_source",
)
TRACKING_PREFIXES = ("utm_", "openstat_")


def piece(url: Column, name: str) -> Column:
    return F.regexp_extract(url, PIECES[name], 1)


def is_http(url: Column) -> Column:
    return F.coalesce(F.lower(piece(url, "scheme")).isin("http", "https") & (piece(url, "authority") != ""), F.lit(False))


def bare_path(path: Column) -> Column:
    """Without slashes at the end; / stays."""
    stripped = F.regexp_replace(path, "/+$", "")
    return F.when(path.isin("", "/"), F.lit("/")).otherwise(stripped)


def source_url(url: Column) -> Column:
    """Lower-case scheme (https if none) and host, path without a slash at the end; no query, no fragment."""
    x = F.coalesce(clean_text(url), F.lit(""))
    scheme = F.coalesce(F.nullif(F.lower(piece(x, "scheme")), F.lit("")), F.lit("https"))
    return F.concat(scheme, F.lit("://"), F.lower(piece(x, "authority")), bare_path(piece(x, "path")))


def entity_url(url: Column) -> Column:
    """Lower-case host; scheme and path as they are; no query, no fragment."""
    x = F.trim(url)
    path = piece(x, "path")
    return F.concat(F.lower(piece(x, "scheme")), F.lit("://"), F.lower(piece(x, "authority")), F.when(path == "", "/").otherwise(path))


def desktop_host(host: Column) -> Column:
    parts = F.split(host, r"\.")
    mobile = (F.size(parts) >= 3) & F.try_element_at(parts, F.lit(1)).isin("m", "mobile", "touch")
    return F.when(mobile, F.regexp_replace(host, r"^[^.]*\.", "")).otherwise(host)


def kept_query(query: Column) -> Column:
    """Query without tracking parameters and nameless ones."""
    def keeps(pair):
        name = F.lower(F.substring_index(pair, "=", 1))
        return (name != "") & ~name.isin(*TRACKING) & ~name.rlike("^(?:" + literal_pattern(TRACKING_PREFIXES) + ")")

    return F.array_join(F.filter(F.split(query, "&"), keeps), "&")


def crawl_url(url: Column) -> Column:
    """The form that tells crawled pages apart: desktop host, no tracking, no slash at the end."""
    x = F.trim(url)
    scheme = F.coalesce(F.nullif(F.lower(piece(x, "scheme")), F.lit("")), F.lit("https"))
    query, fragment = kept_query(piece(x, "query")), piece(x, "fragment")
    return F.concat(
        scheme, F.lit("://"), desktop_host(F.lower(piece(x, "authority"))), bare_path(piece(x, "path")),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"\?[^#]*", "")


def parameter(url: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def page_number(url: Column, name: str = "page") -> Column:
    return F.coalesce(F.greatest(parameter(url, name).try_cast("int"), F.lit(1)), F.lit(1))


def with_page(url: Column, page: Column, name: str = "page") -> Column:
    """url with its page parameter set, first page included."""
    rest = F.array_join(F.filter(F.split(piece(url, "query"), "&"), lambda p: (p != "") & (F.substring_index(p, "=", 1) != name)), "&")
    base = F.regexp_replace(url, r"[?#].*$", "")
    pair = F.concat(F.lit(name + "="), page.cast("string"))
    return F.concat(base, F.lit("?"), F.when(rest != "", F.concat(rest, F.lit("&"), pair)).otherwise(pair))


def id_from_url(url: Column) -> Column:
    """The last number of at least two digits in the path."""
    return F.nullif(F.regexp_extract(piece(url, "path"), r"([0-9]{2,})(?!.*[0-9]{2,})", 1), F.lit(""))


def is_private_host(url: Column) -> Column:
    """Loopback, link-local and private IPv4 ranges, localhost and local names."""
    host = F.lower(F.regexp_replace(piece(url, "authority"), r"^[^@]*@|:[0-9]*$", ""))
    return F.coalesce(host.rlike(r"^(?:localhost|.*\.local|.*\.internal|0\.0\.0\.0|127\..*|10\..*|192\.168\..*|169\.254\..*|172\.(?:1[6-9]|2[0-9]|3[01])\..*|\[?::1\]?)$"), F.lit(False))


def product_url(url: Column, keep_query: bool = True, closing_slash: bool = False) -> Column:
    """Forms in which sites name product pages: with or without query, with or without a slash at the end."""
    full = crawl_url(url)
    bare = full if keep_query else F.regexp_replace(full, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^([^?#]*[^/?#])(?=[?#]|$)", "$1/") if closing_slash else bare
