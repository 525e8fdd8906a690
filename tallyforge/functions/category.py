"""Product categories from titles, specification values, URLs and hints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import first_match, lookup, squeeze
from tallyforge.functions.urls import piece

#: Category words, in the order in which they are tried.
WORDS = (
    ("accessory", r"аксессуар\w*|accessor(?:y|ies)|чехол\w*|cases?|chehol\w*|кабель\w*|kabel\w*|cables?|заряд\w*|zaryad\w*|chargers?|adapters?|power\s*bank|powerbank|стекл\w*|steklo|пленк\w*|plenka|наушник\w*|naushnik\w*|headphones?|earphones?|earbuds?|tws|гарнитур\w*|держател\w*|holder|автодержател\w*|ремеш\w*|remesh\w*|straps?|bands?|braslet\w*|браслет\w*|watch(?:es)?|smart\s*chas\w*|смарт\s*час\w*|умн\w*\s*час\w*|umn\w*\s*chas\w*|rings?|кол\w*ц\w*|kolc\w*|kolts\w*|glasses|очк\w*|ochki|hydrogel"),
    ("tablet", r"планшет\w*|planshet\w*|tablets?|ipad|galaxy\s+tab|surface\s+pro"),
    ("laptop", r"ноутбук\w*|noutbuk\w*|laptops?|notebooks?|macbook|thinkpad|ultrabook"),
    ("tv", r"телевизор\w*|televizor\w*|television|smart\s+tv|tv|oled|qled"),
    ("monitor", r"монитор\w*|monitors?|displays?"),
    ("gaming", r"gaming|игров\w*|gamepad|controller|джойстик\w*|приставк\w*|playstation|xbox|nintendo"),
    ("appliance", r"холодильник\w*|holodilnik\w*|refrigerators?|fridges?|стиральн\w*|washing\s+machines?|посудомо\w*|dishwashers?|микроволнов\w*|microwaves?|плита\w*|варочн\w*|ovens?|духов\w*|кондиционер\w*|konditsioner\w*|air\s+conditioners?"),
    ("phone", r"смартфон\w*|телефон\w*|smartphones?|smartfon\w*|telefon\w*|phones?|mobile(?:\s+phone)?|iphone|pixel\s*\d+"),
)
ALLOWED = ("phone", "laptop", "tv", "tablet", "appliance", "accessory", "monitor", "gaming", "unknown")
ALIASES = {
    "phones": "phone", "mobile": "phone", "smartphone": "phone", "smartphones": "phone", "smartfon": "phone", "smartfony": "phone",
    "telefon": "phone", "telefony": "phone", "смартфон": "phone", "смартфоны": "phone", "телефон": "phone", "телефоны": "phone",
    "tablets": "tablet", "planshet": "tablet", "planshety": "tablet", "планшет": "tablet", "планшеты": "tablet",
    "laptops": "laptop", "notebook": "laptop", "notebooks": "laptop", "noutbuk": "laptop", "noutbuki": "laptop",
    "ноутбук": "laptop", "ноутбуки": "laptop", "television": "tv", "televizor": "tv", "televizory": "tv", "телевизор": "tv",
    "телевизоры": "tv", "accessories": "accessory", "aksessuar": "accessory", "aksessuary": "accessory",
    "аксессуар": "accessory", "аксессуары": "accessory", "appliances": "appliance", "bytovaya tehnika": "appliance",
    "бытовая техника": "appliance", "monitors": "monitor", "монитор": "monitor", "мониторы": "monitor", "игровой": "gaming",
    "игровые": "gaming",
}
RULES = tuple((name, rf"(?U)\b(?:{words})\b") for name, words in WORDS)


def signal_text(x: Column) -> Column:
    """Lower case, percent escapes decoded, separators and punctuation as spaces."""
    decoded = F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)
    s = F.regexp_replace(F.lower(F.coalesce(decoded, F.lit(""))), r"[_/\-|]+", " ")
    return squeeze(F.regexp_replace(s, r"(?U)[^\w\s]+", " "))


def of_text(x: Column) -> Column:
    return first_match(signal_text(x), RULES)


def of_hint(hint: Column) -> Column:
    s = signal_text(hint)
    known = F.when(s.isin(*ALLOWED), s)
    return F.coalesce(known, lookup(s, ALIASES), lookup(F.replace(s, F.lit(" "), F.lit("")), ALIASES), first_match(s, RULES))


def infer(url: Column, title: Column, spec_values: Column, hint: Column) -> Column:
    """By title, specification values, a URL that names anything but phones, the hint, the URL; else unknown."""
    parts = [piece(url, p) for p in ("authority", "path", "query", "fragment")]
    by_url = of_text(F.concat_ws(" ", *parts))
    joined = F.array_join(F.transform(F.coalesce(spec_values, F.array().cast("array<string>")), lambda v: F.trim(v)), " ")
    return F.coalesce(of_text(title), of_text(joined), F.when(by_url != "phone", by_url), of_hint(hint), by_url, F.lit("unknown"))
