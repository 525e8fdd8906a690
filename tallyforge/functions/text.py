"""Text cleaning as column expressions.

Patterns carry (?U) where Unicode classes matter and (?iu) where case does: Java's regular expressions are ASCII by
default.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers of front-end payloads inside what should be text.
FRONTEND_MARKERS = ("self.__next_f.push(", "__next_f.push(", "__next_data__", "window.__", "webpack", "<script", "</script")


def literal_pattern(words) -> str:
    return "|".join("\\Q" + w + "\\E" for w in words)


def squeeze(x: Column) -> Column:
    """White space runs, no-break spaces included, become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(x, r"(?U)[\s ]+", " "))


def clean_text(x: Column) -> Column:
    """squeeze, and null for what is empty then."""
    return F.nullif(squeeze(x.cast("string")), F.lit(""))


def clean_title(x: Column) -> Column:
    return squeeze(F.coalesce(x, F.lit("")))


def is_frontend_noise(x: Column) -> Column:
    return F.coalesce(F.lower(clean_text(x)).rlike(literal_pattern(FRONTEND_MARKERS)), F.lit(False))


def title_case(x: Column) -> Column:
    """Every run of letters begins with an upper-case letter and goes on in lower case."""
    runs = F.regexp_extract_all(x, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))), "")


def lookup(x: Column, table: dict) -> Column:
    """Value of x in a small fixed table, or null."""
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    return F.try_element_at(F.create_map(*pairs), x) if pairs else F.lit(None)


def first_match(x: Column, rules) -> Column:
    """Name of the first rule (name, pattern) whose pattern is found in x; null if none is."""
    return F.coalesce(*[F.when(x.rlike(p), F.lit(n)) for n, p in rules])


def first_true(*rules: tuple[Column, object]) -> Column:
    """Value of the first rule (condition, value) that holds; null if none does."""
    (cond, value), *rest = rules
    return reduce(lambda c, r: c.when(r[0], r[1] if isinstance(r[1], Column) else F.lit(r[1])), rest, F.when(cond, value if isinstance(value, Column) else F.lit(value)))


def present(x: Column) -> Column:
    return F.coalesce(F.trim(x.cast("string")), F.lit("")) != ""


def compact(*items: Column) -> Column:
    """Array of the items that are not null."""
    return F.array_compact(F.array(*items))


def ordered_distinct(x: Column) -> Column:
    return F.array_distinct(F.filter(x, lambda v: v.isNotNull() & (v != "")))


def ordered_union(*arrays: Column) -> Column:
    """Distinct values of all arrays in the order they first come."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(a, none) for a in arrays]))


#: What a spec label may end in without meaning it.
LABEL_TAIL = r"\s*[,;]\s*(?:гб|gb|тб|tb|мah|mah|мач|гц|hz|кг|kg|г\b|mm|мм)\s*$"
LABEL_NOISE = r"\s*[\[(]?(?:новинка|sale|акция|хит)[\])]?\s*$"


def spec_label(x: Column) -> Column:
    """Key of a specification label: lower case, ё as е, without noise words, unit tails and a closing colon.

    Compatibility forms (full width, ligatures) are folded for the characters that shops use; there is no built-in
    for the whole of NFKC.
    """
    wide = "".join(chr(0xFF01 + i) for i in range(94)) + "　   №"
    plain = "".join(chr(0x21 + i) for i in range(94)) + "    N"
    s = F.translate(F.coalesce(x, F.lit("")), wide + "ёЁ", plain + "ее")
    s = F.regexp_replace(s, r"(?:\\[trn])+", " ")
    s = squeeze(F.regexp_replace(s, r"""(?iuU)[^\w\s\-+/.,%°"″']""", " "))
    for pattern in (LABEL_NOISE, LABEL_TAIL, r"\s*:\s*$"):
        s = F.regexp_replace(s, "(?iuU)" + pattern, "")
    return F.lower(squeeze(s))


def mask_query(url: Column, names: tuple[str, ...], mask: str = "***") -> Column:
    """Values of the named query parameters replaced by a mask."""
    return F.regexp_replace(url, rf"(?i)([?&](?:{'|'.join(names)})=)[^&#]*", "$1" + mask.replace("*", "\\*"))


def mask_secrets(text: Column) -> Column:
    """Bearer tokens, key=value secrets and credentials in URLs masked in a message."""
    out = F.regexp_replace(text, r"(?i)(bearer\s+)[A-Za-z0-9._~+/=-]+", "$1***")
    out = F.regexp_replace(out, r"(?i)\b(api[_-]?key|token|secret|password|passwd|authorization)(\s*[=:]\s*)(?!\*\*\*|bearer)[^\s,;&]+", "$1$2***")
    return F.regexp_replace(out, r"(?i)(https?://)[^/@\s:]+:[^/@\s]+@", "$1***@")


def visible_text(html: Column, limit: int = 12000) -> Column:
    """Text of a page without scripts, styles and tags, the common character references decoded, cut at limit."""
    s = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]+>", " ")
    for name, char in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        s = F.replace(s, F.lit(f"&{name};"), F.lit(char))
    return F.substring(squeeze(F.coalesce(s, F.lit(""))), 1, limit)
