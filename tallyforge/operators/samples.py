"""Bounded samples that don't depend on how rows are dealt: a row's hash decides, not a random number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.windows import last_n


def priority(*columns: str) -> Column:
    """A number in 0..2^32 - 1 from the content of the columns, the same on every run; null counts as a value."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def sampled(rows: DataFrame, ids: list[str], rate: float) -> DataFrame:
    """The share `rate` of rows, by hash of their ids: rows with the same ids stay or go together."""
    return rows.filter(priority(*ids) < int(rate * 2**32)) if rate < 1 else rows


def newest_sample(rows: DataFrame, keys: list[str], ids: list[str], ts: str, rate: float = 1.0, most: int = 10_000) -> DataFrame:
    """Of each key's sampled rows the newest `most`, later ids first where times are equal.

    Each task keeps at most `most` rows a key before anything is shuffled.  Null times are the oldest.
    """
    return last_n(sampled(rows, ids, rate), keys, [F.col(ts).desc(), *[F.col(i).desc() for i in ids]], most)


def even_sample(rows: DataFrame, keys: list[str], ids: list[str], most: int = 10_000) -> DataFrame:
    """Of each key the `most` rows of smallest priority: an even sample of all its rows, however they come in."""
    return last_n(rows, keys, [priority(*ids), *[F.col(i) for i in ids]], most)
