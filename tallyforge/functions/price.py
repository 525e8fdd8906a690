"""Prices and stock from free text; anything ambiguous is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the price rules.
NO_PRICE = r"по\s*договор[ёе]нности|по\s*запросу|narxi\s*kelishiladi|цена\s*не\s*указана|bepul|бесплатно"
INSTALLMENT = r"/\s*(?:мес|month|mo)\b|\b(?:в\s+месяц|ежемесячно|monthly|installment)\b|\bрассроч\w*"
SEVERAL = r"\b(?:было|стало|old\s+price|new\s+price)\b"
RANGE = r"\d[\d\s .,]*\s*[-–—]\s*\d"
FROM = r"^\s*(?:от|from)\b"
CURRENCY = r"сум|сўм|sum|uzs|руб\w*|₽|\$|€|£|¥"
STOCK_FALSE = ("false", "0", "no", "n", "off", "out of stock", "out-of-stock", "нет", "нет в наличии", "недоступно")
STOCK_TRUE = ("true", "1", "yes", "y", "on", "available", "in stock", "in-stock", "да", "есть", "в наличии", "есть в наличии")


def price_number(token: Column) -> Column:
    """Digits of one price token, its separators read as thousands or decimals by what follows them.

    Of several separators the last is a decimal point if at most two characters follow it; a single one is not if
    exactly three digits follow it.
    """
    t = F.replace(F.regexp_replace(token, r"(?U)[\s ]+", ""), F.lit(","), F.lit("."))
    parts = F.split(t, r"\.", -1)
    n = F.size(parts) - 1
    tail = F.element_at(parts, -1)
    whole = F.array_join(F.slice(parts, 1, F.greatest(n, F.lit(1))), "")
    glued = F.array_join(parts, "")
    split = F.concat(whole, F.lit("."), tail)
    return F.when(n == 0, t).when(n == 1, F.when(F.length(tail) == 3, glued).otherwise(t)).otherwise(F.when(F.length(tail) <= 2, split).otherwise(glued))


def price(raw: Column) -> Column:
    """decimal(38,6) of the only price in raw; null if there is none, several, a range, an instalment or a "from"."""
    text = F.regexp_replace(raw, r"(?U)^[\s ]+|[\s ]+$", "")
    bad = text.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in (NO_PRICE, INSTALLMENT, SEVERAL, RANGE, FROM)))
    bare = F.regexp_replace(text, "(?iuU)(?:" + CURRENCY + ")", " ")
    tokens = F.transform(F.regexp_extract_all(bare, F.lit(r"(?U)(\d[\d\s .,]*)"), F.lit(1)), price_number)
    tokens = F.filter(tokens, lambda t: t.rlike("[1-9]"))
    value = F.when(F.size(tokens) == 1, F.try_element_at(tokens, F.lit(1)).try_cast("decimal(38,6)"))
    return F.when(raw.isNotNull() & ~bad & ~text.isin("", "0") & (value > 0), value)


def price_units(raw: Column) -> Column:
    """Whole currency units of price, cut off."""
    return price(raw).cast("long")


def stock(raw: Column) -> Column:
    """True, false, or null where a text doesn't say."""
    text = F.lower(F.trim(raw.cast("string")))
    return F.when(text.isin(*STOCK_FALSE), False).when(text.isin(*STOCK_TRUE), True)
