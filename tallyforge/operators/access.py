"""How a page is to be fetched, decided from a site's profile and what has failed so far.  Only the rules; no fetching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Failures before a browser or a proxy is tried.
SHELL_FAILURES, BROWSER_FAILURES, PROXY_FAILURES = 2, 2, 1
PROXY_SIGNALS = ("access_denied", "transport_like_error_page", "empty_shell", "captcha")


def use_proxy(mode: Column, enabled: Column, required: Column, available: Column, failures: Column) -> Column:
    wanted = required | ((mode == "http_with_proxy") & (failures >= PROXY_FAILURES))
    return F.coalesce(enabled, F.lit(True)) & available & F.coalesce(wanted, F.lit(False))


def use_browser(mode: Column, supported: Column, fallback: Column, signal: Column, failures: Column, ban_signals: Column) -> Column:
    """Needed by the profile, or a fallback after challenges and shells, or after the profile's own ban signals."""
    shell = (signal == "cloudflare_challenge") & (failures >= 1) | signal.isin("js_shell", "empty_shell", "cloudflare_challenge") & (failures >= SHELL_FAILURES)
    banned = F.array_contains(ban_signals, signal) & (failures >= BROWSER_FAILURES)
    climbs = (mode != "http_only") & fallback & F.coalesce(shell | banned, F.lit(False))
    return F.coalesce(supported & ((mode == "browser_required") | climbs), F.lit(False))


def turn_to_proxy(mode: Column, fallback: Column, required: Column, available: Column, signal: Column, failures: Column) -> Column:
    told = signal.isin(*PROXY_SIGNALS) & (failures >= PROXY_FAILURES)
    return F.coalesce(available & (mode != "http_only") & fallback & ~required & (F.coalesce(told, F.lit(False)) | ((mode == "http_with_proxy") & (failures >= 1))), F.lit(False))
