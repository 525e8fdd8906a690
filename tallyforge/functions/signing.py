"""Signed requests: HMAC-SHA256 as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK, INNER, OUTER = 64, 0x36, 0x5C


def padded(key: Column, pad: int) -> Column:
    """The key of a row, filled up to a block and xored with a pad."""
    whole = F.when(F.octet_length(key) > BLOCK, F.sha2(key, 256)).otherwise(F.hex(key))
    digits = F.rpad(whole, 2 * BLOCK, "0")
    byte = lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int").bitwiseXOR(F.lit(pad))
    block = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.lpad(F.hex(byte(i)), 2, "0")), ""))
    return F.when(key.isNotNull(), block)


def hmac_sha256(key: str | bytes | Column, message: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of a text or binary column; null where key or message is null.

    A key that is one value for all rows is padded once here; a key column is padded in each row.
    """
    if isinstance(key, Column):
        binary = key.cast("binary")
        inner, outer = padded(binary, INNER), padded(binary, OUTER)
    else:
        raw = key.encode() if isinstance(key, str) else key
        raw = (hashlib.sha256(raw).digest() if len(raw) > BLOCK else raw).ljust(BLOCK, b"\0")
        inner, outer = (F.lit(bytes(b ^ pad for b in raw)) for pad in (INNER, OUTER))
    first = F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))
    return F.sha2(F.concat(outer, first), 256)


def canonical_request(method: Column, path: Column, body: Column, timestamp: Column, nonce: Column) -> Column:
    """The text that is signed: method, path, hash of the body, time and nonce, a line each."""
    filled = lambda c, none: F.coalesce(F.nullif(c, F.lit("")), F.lit(none))
    body_hash = F.sha2(F.coalesce(body.cast("binary"), F.lit(b"")), 256)
    lines = (F.trim(F.upper(filled(method, "GET"))), filled(path, "/"), body_hash, F.trim(F.coalesce(timestamp, F.lit(""))), F.trim(F.coalesce(nonce, F.lit(""))), F.lit(""))
    return F.concat_ws("\n", *lines)


def signed(rows, secret: str | bytes | Column, name: str = "signature"):
    """Requests (method, path, body, timestamp, nonce) with their signature."""
    return rows.withColumn(name, hmac_sha256(secret, canonical_request(*[F.col(c) for c in ("method", "path", "body", "timestamp", "nonce")])))
