"""Brand, model, bar code and compatibility of product listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions import category
from tallyforge.functions.text import clean_title, literal_pattern, spec_label, squeeze

#: Brands by what they make, words that are no names, labels of specifications.
PHONE_BRANDS = (
    "nothing", "infinix", "tecno", "itel", "meizu", "zte", "fly", "alcatel", "blackview", "oukitel", "doogee", "umidigi", "cubot",
    "ulefone", "realme", "oppo", "vivo", "oneplus", "poco", "redmi", "honor", "novey", "benco", "micromax", "lava", "karbonn",
    "coolpad", "wiko", "cat", "agm", "oscal", "hotwav", "hmd", "iphone",
)
OTHER_BRANDS = {
    "apple": "phone laptop", "samsung": "phone tv appliance laptop", "xiaomi": "phone tv laptop appliance", "lg": "phone tv appliance",
    "sony": "phone tv", "huawei": "phone laptop", "nokia": "phone", "motorola": "phone", "google": "phone", "asus": "phone laptop gaming",
    "lenovo": "phone laptop", "microsoft": "laptop", "dell": "laptop", "hp": "laptop", "acer": "laptop", "msi": "laptop gaming",
    "gigabyte": "laptop gaming", "razer": "laptop gaming", "toshiba": "laptop tv appliance", "fujitsu": "laptop", "philips": "tv appliance",
    "hisense": "tv appliance", "tcl": "tv", "artel": "tv appliance", "sharp": "tv appliance", "panasonic": "tv appliance",
    "haier": "tv appliance", "beko": "appliance", "vestel": "appliance", "indesit": "appliance", "bosch": "appliance",
    "siemens": "appliance", "electrolux": "appliance", "whirlpool": "appliance",
}
SMALL_BRANDS = (
    "goodwell", "hofmann", "gorenje", "candy", "smeg", "miele", "kuppersberg", "maunfeld", "luxor", "shivaki", "davoline", "hansa",
    "pyramida", "simfer", "minola", "ferre", "weissgauff",
)
LAPTOP_SIGNS = ("ноутбук", "laptop", "notebook", "macbook", "mac book", "ultrabook", "ультрабук")
TV_SIGNS = r"\b\d{2,3}\s*(?:дюйм|inch|\")|телевизор|television|smart tv|4k|8k|qled|oled|дюйм|inch|\"|'|hdr|uhd|fhd|curved tv"
APPLIANCE_SIGNS = ("холодильник", "стиральн", "кондиционер", "пылесос", "духовка", "духовой", "шкаф", "refrigerator", "washing", "dishwasher")
FOR = r"(?iuU)(?<!\w)для\b|\b(?:for|compatible\s+with|dlya)\b"
FOR_PREFIX = r"(?iuU)^(?:(?:для|dlya|for)\b|compatible\s+with\b|совмест\w*\s+с\b|подходит\s+для\b)\s*"
FOR_SPLIT = r"(?U)\s*(?:,|;|\||/|\band\b|\bи\b)\s*|\s+\+\s+"
FOR_LABELS = ("compatibility", "compatible with", "compatible models", "compatible devices", "совместим", "совместимость", "подходит для")
TOO_GENERAL = ("iphone", "samsung", "xiaomi", "smartphone", "phone", "mobile phone", "телефон", "смартфон")
EDGES = " -–—:;,./"
BRAND_LABELS = ("brand", "бренд", "manufacturer", "производитель", "vendor")
MODEL_LABELS = ("model", "модель", "model name", "наименование модели", "model number", "код модели", "product model")
UNKNOWN = ("-", "n/a", "na", "none", "null", "unknown", "not specified", "не указано", "неизвестно", "нет данных", "отсутствует")
MODEL_NOISE = ("смартфон", "телефон", "smartphone", "mobile", "phone", "tv", "телевизор", "television", "laptop", "notebook", "ноутбук", "tablet", "планшет", "galaxy")
BARCODE_LABEL = r"(?iu)^\s*(?:barcode|ean|ean13|gtin|upc|штрихкод|ean[\s_-]?13)\s*$"


def known_brand(title: Column, told: Column) -> Column:
    """The brand told, else the first word of the title that is one; in an accessory's title only before its "for"."""
    accessory = (category.of_text(title) == "accessory") & title.rlike(FOR)
    text = F.when(F.coalesce(accessory, F.lit(False)), F.regexp_extract(title, rf"^(.*?)(?:{FOR[6:]})".replace("^(", "(?iuU)^(", 1), 1)).otherwise(title)
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\s/\-_]+"), lambda w: F.lower(w).isin(*PHONE_BRANDS, *OTHER_BRANDS, *SMALL_BRANDS))
    first = F.try_element_at(words, F.lit(1))
    return F.coalesce(F.nullif(F.trim(told), F.lit("")), F.when(F.lower(first) == "iphone", "Apple").otherwise(first))


def classified(url: Column, title: Column, hint: Column) -> Column:
    """Category by the shared rules; for titles that only name a brand, by what it makes and signs in the title."""
    none = F.array().cast("array<string>")
    general = category.infer(url, title, none, hint)
    low = F.lower(F.coalesce(title, F.lit("")))
    word = F.try_element_at(F.filter(F.split(low, r"[\s/\-_]+"), lambda w: (F.length(w) >= 2) & ~w.rlike("^[0-9]+$")), F.lit(1))
    makes = F.when(word.isin(*PHONE_BRANDS), F.array(F.lit("phone")))
    for name, what in OTHER_BRANDS.items():
        makes = makes.when(word == name, F.array(*map(F.lit, what.split())))
    has = lambda c: F.array_contains(makes, c) & (F.size(makes) > 1)
    by_brand = (
        F.when(has("laptop") & low.rlike(literal_pattern(LAPTOP_SIGNS)), "laptop").when(has("tv") & low.rlike("(?U)" + TV_SIGNS), "tv")
        .when(has("appliance") & low.rlike(literal_pattern(APPLIANCE_SIGNS)), "appliance").otherwise(F.try_element_at(makes, F.lit(1)))
    )
    return F.when(general != "unknown", general).otherwise(F.coalesce(by_brand, F.lit("unknown")))


def stated(specs: Column, labels: tuple[str, ...]) -> Column:
    """First value of a map under one of the labels that isn't a word for unknown."""
    pairs = F.filter(F.map_entries(specs), lambda e: spec_label(e["key"]).isin(*labels))
    values = F.filter(F.transform(pairs, lambda e: squeeze(e["value"])), lambda v: (v != "") & ~F.lower(v).isin(*UNKNOWN))
    return F.try_element_at(values, F.lit(1))


def model_name(title: Column, brand: Column, hint: Column) -> Column:
    """Title without its brand in front and without words for the kind of product; null for accessories that fit others."""
    t = clean_title(title)
    fits = (category.of_hint(hint) == "accessory") & t.rlike(FOR)
    own = F.trim(F.coalesce(brand, F.lit("")))
    led = (own != "") & F.startswith(F.lower(t), F.lower(own))
    rest = F.when(led, F.ltrim(t.substr(F.length(own) + 1, F.length(t)), F.lit(" -–—:"))).otherwise(t)
    rest = squeeze(F.regexp_replace(rest, rf"(?iuU)\b(?:{literal_pattern(MODEL_NOISE)})\b", " "))
    return F.when(~F.coalesce(fits, F.lit(False)) & (F.length(rest) >= 2), rest)


def barcode(specs: Column) -> Column:
    """First 8, 12, 13 or 14 digits under a bar code label."""
    pairs = F.filter(F.map_entries(specs), lambda e: e["key"].rlike(BARCODE_LABEL))
    digits = F.transform(pairs, lambda e: F.regexp_replace(e["value"], "[^0-9]", ""))
    return F.try_element_at(F.filter(digits, lambda d: F.length(d).isin(8, 12, 13, 14)), F.lit(1))


def is_fit_label(label: Column) -> Column:
    x = squeeze(F.regexp_replace(F.lower(label), r"(?U)[^\w\s]+", " "))
    return F.coalesce(x.rlike("^(?:" + literal_pattern(FOR_LABELS) + ")( |$)"), F.lit(False))


def fits_targets(title: Column, hint: Column, specs: Column) -> Column:
    """What an accessory fits: what its title says after "for", then what its specifications say."""
    t = clean_title(title)
    none = F.array().cast("array<string>")
    tail = F.regexp_replace(t, rf"(?iuU)^.*?(?:{FOR[6:]})", "")
    told = F.transform(F.filter(F.map_entries(specs), lambda e: is_fit_label(e["key"])), lambda e: F.regexp_replace(squeeze(e["value"]), FOR_PREFIX, ""))
    told = F.coalesce(told, none)
    kind = F.coalesce(category.of_hint(hint), category.of_text(t))
    wanted = F.coalesce(kind == "accessory", F.lit(False)) | t.rlike(FOR) | (F.size(told) > 0)
    texts = F.concat(F.when(t.rlike(FOR), F.array(tail)).otherwise(none), told)
    texts = F.filter(F.transform(texts, lambda x: F.btrim(x, F.lit(EDGES))), lambda x: F.length(x) >= 2)
    parts = F.transform(F.flatten(F.transform(texts, lambda x: F.split(x, FOR_SPLIT))), lambda p: F.btrim(squeeze(p), F.lit(EDGES)))
    fine = F.filter(parts, lambda p: (F.length(p) >= 2) & ~F.lower(p).isin(*TOO_GENERAL))
    return F.when(wanted, F.array_distinct(fine)).otherwise(none)


def listing_signature(path: Column, page: Column, found: Column, most: int = 5) -> Column:
    """Hash of a listing page by its path, number and first links."""
    from tallyforge.functions.identity import canonical_json, sha256

    return sha256(canonical_json(path, page, F.array_sort(F.slice(found, 1, most)), F.size(found), names=("path", "page", "head_urls", "total_links")))
