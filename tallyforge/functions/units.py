"""Measures from free text.

One rule holds throughout: a text gives a value only if it names exactly one.  Two quantities, ranges and composites
such as "8 + 256 GB" are null.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import clean_text, lookup, squeeze, title_case

FLAGS = "(?iuU)"
INT, DEC = r"\d+", r"\d+(?:[.,]\d+)?"

#: Spellings of units (Java patterns, case-insensitive).
TB, GB = "TB|ТБ", "GB|ГБ"
INCH, CM = r"inch\w*|дюйм\w*|\"|″|''", "cm|см"
MAH, WH = "mAh|мАч", r"Wh|Вт\s*[·*⋅]?\s*ч"
KG, G = "kg|кг", r"g(?!b)|г(?!б)|грамм\w*|gram\w*"
MP = r"MP|Мп|мегапиксел\w*|megapixel\w*"
HZ = "Hz|Гц|герц"
WATT = r"(?:W|Вт)\b"
LITRE, ML = r"(?:л(?!с)|l(?!b)|литр\w*|litr\w*)\b", r"(?:ml|мл)\b"
YEAR, MONTH = r"yil|year\w*|год\w*|лет|г\.?", r"oy|month\w*|мес\w*"
UP_TO = r"\bup\s*to\b|\bmax(?:imum)?\b|\bдо\b|\bмакс(?:имум)?\b"
CAMERA_PLACES = r"main|rear|back|front|selfie|wide|ultra|macro|depth|tele|основн\w*|тылов\w*|задн\w*|передн\w*|селфи"
KNOWN_RATES = (24, 30, 50, 60, 75, 90, 120, 144, 165, 240)
TRUE_WORDS = ("да", "есть", "yes", "true", "бор", "mavjud", "✓", "+", "1", "ха", "ha", "имеется", "поддерживается", "supported", "бар")
FALSE_WORDS = ("нет", "no", "false", "йўқ", "yo'q", "yoq", "отсутствует", "0", "-", "не поддерживается", "unsupported")
TRUE_INSIDE = r"(?<!\w)(?:да|есть|yes|true|ха|ha|имеется|поддерживается|supported|mavjud|bar|bor)(?!\w)"
FALSE_INSIDE = r"(?<!\w)(?:нет|no|false|йўқ|yo'?q|отсутствует|unsupported|не\s+поддерживается)(?!\w)"
BOOL_UNKNOWN = r"\b(?:n/?a|unknown|not\s+specified|none)\b|не\s+указано|неизвестно"
TV_PLATFORMS = ("android tv", "tizen", "webos", "google tv", "vidaa", "smart tv", "roku", "fire tv", "lg tv", "samsung tv", "яндекс тв", "салют тв")
CAPABILITY = {
    "has_wifi": r"\bwi-?fi\b|802\.11|\b[256](?:\.\d+)?\s*ghz\b",
    "has_bluetooth": r"\bbluetooth\b|\bbt\b|^v?\s*\d(?:\.\d+){0,2}$",
    "hdmi": r"\bhdmi\b|\b[1-9]\d*\s*(?:ports?|inputs?)\b|\b[1-9]\d*\s*(?:порт\w*|разъем\w*)\b|^[1-9]\d*$",
    "nfc": r"\bnfc\b",
}
#: Plausible ranges of typed fields.
PLAUSIBLE = {
    "ram_gb": (1, 128), "storage_gb": (1, 8192), "display_size_inch": (1, 100), "battery_mah": (500, 20000),
    "weight_g": (50, 100000), "weight_kg": (0.05, 80),
}


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body of x, x being written into the plan and evaluated once however often body names it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def once(parser: Callable[..., Column]) -> Callable[..., Column]:
    """A parser of a stripped text as one of a raw text, which is stripped once."""

    @wraps(parser)
    def run(raw: Column, *args, **named) -> Column:
        return let(text_of(raw), lambda x: parser(x, *args, **named))

    return run


def has(x: Column, pattern: str) -> Column:
    return x.rlike(FLAGS + pattern)


def found(x: Column, number: str, unit: str) -> Column:
    """Numbers in front of a unit."""
    return F.regexp_extract_all(x, F.lit(f"{FLAGS}({number})\\s*(?:{unit})"), F.lit(1))


def tokens(x: Column, number: str = INT) -> Column:
    return F.regexp_extract_all(x, F.lit(f"(?U)({number})"), F.lit(1))


def only(values: Column) -> Column:
    return let(values, lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0))))


def as_double(x: Column) -> Column:
    return F.replace(x, F.lit(","), F.lit(".")).try_cast("double")


def joined_quantities(x: Column, number: str, unit: str) -> Column:
    """Two numbers with -, / or + between them, at least one with its unit."""
    return has(x, rf"{number}\s*(?:{unit})\s*[-/+]\s*{number}|{number}\s*[-/+]\s*{number}\s*(?:{unit})")


def between(x: Column, low, high) -> Column:
    return let(x, lambda v: F.when(v.between(low, high), v))


def text_of(raw: Column) -> Column:
    return F.nullif(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""), F.lit(""))


@once
def storage_gb(x: Column) -> Column:
    unit = f"{TB}|{GB}"
    hits = found(x, INT, unit)
    tera = F.size(found(x, INT, TB)) == 1
    value = only(hits).try_cast("long") * F.when(tera, 1024).otherwise(1)
    plain = only(tokens(x)).try_cast("long")
    return F.when(~joined_quantities(x, INT, unit), F.when(F.size(hits) > 0, value).otherwise(plain))


def ram_gb(raw: Column) -> Column:
    """As storage; more than 64 is taken for storage in the wrong field."""
    value = storage_gb(raw)
    return F.when(value <= 64, value)


@once
def display_inch(x: Column) -> Column:
    inch, cm = found(x, r"\d+[.,]?\d*", INCH), found(x, r"\d+[.,]?\d*", CM)
    plain = F.when(~has(x, rf"{DEC}\s*[xх×]\s*{DEC}"), as_double(only(tokens(x, DEC))))
    value = F.when(F.size(inch) > 0, as_double(only(inch))).when(F.size(cm) > 0, F.round(as_double(only(cm)) / 2.54, 1)).otherwise(plain)
    joined = has(x, rf"{DEC}\s*[-/+]\s*{DEC}\s*(?:{CM}|{INCH})")
    return F.when(~joined, between(value, 1.0, 100.0))


@once
def battery_mah(x: Column) -> Column:
    number = r"\d{3,5}"
    hits = found(x, number, MAH)
    value = F.when(F.size(hits) > 0, only(hits)).otherwise(only(tokens(x))).try_cast("long")
    return F.when(~joined_quantities(x, number, MAH), between(value, 500, 20000))


@once
def battery_wh(x: Column) -> Column:
    """A single value with its unit that is out of range gives way to a plain number, as texts like "1 Wh 56" have."""
    hits = found(x, r"\d+[.,]?\d*", WH)
    plain = between(as_double(only(tokens(x, DEC))), 10.0, 200.0)
    value = F.when(F.size(hits) < 2, F.coalesce(between(as_double(only(hits)), 10.0, 200.0), plain))
    return F.when(~joined_quantities(x, DEC, WH), F.round(value, 1))


def _weights(x: Column) -> tuple[Column, Column, Column]:
    kg, g = found(x, r"\d+[.,]?\d*", KG), found(x, r"\d+[.,]?\d*", G)
    fine = ~joined_quantities(x, DEC, f"{KG}|{G}") & (F.size(kg) + F.size(g) == 1)
    return fine, as_double(only(kg)), as_double(only(g))


@once
def weight_g(x: Column) -> Column:
    fine, kg, g = _weights(x)
    return F.when(fine, between(F.coalesce(kg * 1000, g).cast("long"), 50, 50000))


@once
def weight_kg(x: Column) -> Column:
    fine, kg, g = _weights(x)
    return F.when(fine, F.coalesce(F.round(between(kg, 0.1, 50.0), 2), between(F.round(g / 1000, 2), 0.1, 50.0)))


@once
def camera_mp(x: Column) -> Column:
    hits = found(x, INT, MP)
    value = F.when(F.size(hits) > 0, only(hits)).otherwise(only(tokens(x))).try_cast("long")
    several = has(x, CAMERA_PLACES) & has(x, "[-/+]") & (F.size(tokens(x)) > 1)
    return F.when(~joined_quantities(x, INT, MP) & ~several, between(value, 1, 200))


@once
def sim_count(x: Column) -> Column:
    x = F.lower(x)
    kinds = F.regexp_count(x, F.lit(r"(?U)\b(?:e|nano|micro|mini)[-\s]?sim\b"))
    counted = F.nullif(F.regexp_extract(x, r"(?U)\b([1-4])\s*(?:sim|slots?)\b", 1), F.lit("")).cast("int")
    return (
        F.when(x.rlike(r"(?U)\bdual\b|\bduos\b|\bikki\b|\bдва\b|\b2\s*(?:sim|slots?|(?:nano|micro|mini|e)[-\s]?sim)\b"), 2)
        .when(x.rlike(r"(?U)\bsingle\b|\bbitta\b|\bодин\b|\b1\s*(?:sim|slot)\b"), 1)
        .when(counted.isNotNull(), counted)
        .when(kinds > 0, F.least(kinds, F.lit(4)))
    )


@once
def refresh_hz(x: Column) -> Column:
    hits = found(x, INT, HZ)
    plain = only(tokens(x)).try_cast("long")
    value = F.when(F.size(hits) > 0, only(hits).try_cast("long")).otherwise(F.when(plain.isin(*KNOWN_RATES), plain))
    return F.when(~has(x, UP_TO) & ~joined_quantities(x, INT, HZ), value)


def plain_number(x: Column) -> Column:
    return F.when(x.rlike(r"^\d+(?:[.,]\d+)?$"), as_double(x))


@once
def power_w(x: Column, latin_only: bool = False) -> Column:
    """latin_only: know W alone, as an older parser did whose Cyrillic spelling was damaged."""
    unit = r"W\b" if latin_only else WATT
    hits = found(x, DEC, unit)
    value = F.when(F.size(hits) > 0, as_double(only(hits))).otherwise(plain_number(x))
    value = let(value, lambda v: F.when((v > 0) & (v == F.floor(v)), v.cast("long")))
    return F.when(~has(x, rf"{DEC}\s*[-–—/]\s*{DEC}\s*{unit}"), value)


@once
def volume_l(x: Column) -> Column:
    litre, ml = found(x, r"\d+[.,]?\d*", LITRE), found(x, DEC, ML)
    value = F.coalesce(as_double(only(litre)), F.round(as_double(only(ml)) / 1000, 3))
    n = F.size(litre) + F.size(ml)
    return F.when(~has(x, rf"{DEC}\s*[-–—/]\s*{DEC}"), F.when(n == 1, value).when(n == 0, plain_number(x)))


@once
def warranty_months(x: Column) -> Column:
    years, months = found(x, INT, YEAR), found(x, INT, MONTH)
    value = F.coalesce(only(years).try_cast("long") * 12, only(months).try_cast("long"))
    plain = F.when(x.rlike("^[1-9][0-9]{0,2}$"), between(x.try_cast("long"), 1, 120))
    n = F.size(years) + F.size(months)
    fine = ~has(x, UP_TO + r"|\bне\s*более\b") & ~joined_quantities(x, INT, f"{YEAR}|{MONTH}")
    return F.when(fine, F.when(n == 1, value).when(n == 0, plain))


@once
def count_of(x: Column) -> Column:
    """Counts: 2, x2, 2x, 3 ports."""
    rules = (r"^(?:x\s*)?([1-9]\d*)(?:\s*x)?$", r"\b([1-9]\d*)\s*(?:ports?|inputs?|slots?|pcs?|pieces?|шт|разъем\w*)\b", r"\bx\s*([1-9]\d*)\b", r"\b([1-9]\d*)\s*x\b")
    value = F.coalesce(*[F.nullif(F.regexp_extract(x, FLAGS + p, 1), F.lit("")) for p in rules]).try_cast("long")
    return F.when(~x.rlike(r"\d+\.\d+|\d+\s*[-–—/]\s*\d+"), value)


@once
def truth(x: Column) -> Column:
    x = F.lower(x)
    return F.when(x.isin(*TRUE_WORDS), True).when(x.isin(*FALSE_WORDS), False).when(has(x, FALSE_INSIDE), False).when(has(x, TRUE_INSIDE), True)


@once
def capability(x: Column, field: str) -> Column:
    """truth, or else true where the text names the capability itself."""
    x = F.lower(x)
    return F.coalesce(truth(x), F.when(has(x, CAPABILITY[field]) & ~has(x, BOOL_UNKNOWN), True))


@once
def smart_tv(x: Column) -> Column:
    x = F.lower(x)
    return F.when(x.rlike("|".join(TV_PLATFORMS)), True).otherwise(truth(x))


@once
def resolution(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s*[×xXхХ*]\s*", "x")


@once
def energy_class(x: Column) -> Column:
    return F.upper(F.coalesce(F.nullif(F.regexp_extract(x, r"([A-Da-d]\+{0,3})", 1), F.lit("")), x))


#: Brands, colours and canonical spellings.
BRANDS = {
    "эпл": "Apple", "apple": "Apple", "самсунг": "Samsung", "samsung": "Samsung", "сяоми": "Xiaomi", "xiaomi": "Xiaomi",
    "redmi": "Xiaomi", "хуавей": "Huawei", "huawei": "Huawei", "honor": "Honor", "реалми": "Realme", "realme": "Realme",
    "поко": "Poco", "poco": "Poco", "ванплас": "OnePlus", "oneplus": "OnePlus", "нокия": "Nokia", "nokia": "Nokia",
    "сони": "Sony", "sony": "Sony", "лг": "LG", "lg": "LG", "оппо": "Oppo", "oppo": "Oppo", "виво": "Vivo", "vivo": "Vivo",
    "гугл": "Google", "google": "Google", "моторола": "Motorola", "motorola": "Motorola", "зте": "ZTE", "zte": "ZTE",
    "текно": "Tecno", "tecno": "Tecno", "инфиникс": "Infinix", "infinix": "Infinix", "итель": "Itel", "itel": "Itel",
    "nothing": "Nothing", "iphone": "Apple", "novey": "Novey", "benco": "Benco", "hmd": "HMD", "blackview": "Blackview",
    "oukitel": "Oukitel", "doogee": "Doogee", "umidigi": "Umidigi", "cubot": "Cubot", "ulefone": "Ulefone",
    "coolpad": "Coolpad", "fly": "Fly", "флай": "Fly", "alcatel": "Alcatel", "алкатель": "Alcatel", "meizu": "Meizu",
    "мейзу": "Meizu", "hotwav": "Hotwav", "oscal": "Oscal", "agm": "AGM", "cat": "CAT", "асус": "ASUS", "asus": "ASUS",
    "леново": "Lenovo", "lenovo": "Lenovo", "делл": "Dell", "dell": "Dell", "эйсер": "Acer", "acer": "Acer", "хп": "HP", "hp": "HP",
}
COLORS = {
    "чёрный": "Black", "черный": "Black", "qora": "Black", "black": "Black", "белый": "White", "oq": "White", "white": "White",
    "синий": "Blue", "ko'k": "Blue", "blue": "Blue", "голубой": "Blue", "красный": "Red", "qizil": "Red", "red": "Red",
    "зелёный": "Green", "зеленый": "Green", "yashil": "Green", "green": "Green", "серый": "Gray", "kulrang": "Gray",
    "gray": "Gray", "grey": "Gray", "золотой": "Gold", "oltin": "Gold", "gold": "Gold", "розовый": "Pink", "pushti": "Pink",
    "pink": "Pink", "фиолетовый": "Purple", "binafsha": "Purple", "purple": "Purple", "серебристый": "Silver",
    "kumush": "Silver", "silver": "Silver", "оранжевый": "Orange", "to'q sariq": "Orange", "orange": "Orange",
    "жёлтый": "Yellow", "желтый": "Yellow", "sariq": "Yellow", "yellow": "Yellow", "бежевый": "Beige", "beige": "Beige",
    "коричневый": "Brown", "jigarrang": "Brown", "brown": "Brown", "бирюзовый": "Turquoise", "turquoise": "Turquoise",
    "лавандовый": "Lavender", "lavender": "Lavender", "бордовый": "Burgundy", "burgundy": "Burgundy", "мятный": "Mint",
    "mint": "Mint", "графитовый": "Graphite", "graphite": "Graphite", "тёмно-синий": "Navy", "темно-синий": "Navy",
    "navy": "Navy", "коралловый": "Coral", "coral": "Coral", "кремовый": "Cream", "cream": "Cream", "титановый": "Titanium",
    "titanium": "Titanium", "песочный": "Sand", "sand": "Sand",
}
UNKNOWN_WORDS = ("-", "—", "n/a", "na", "none", "null", "unknown", "not specified", "не указано", "неизвестно", "нет данных", "отсутствует", "нет", "йўқ", "yo'q")
FIELD_LABELS = {
    "processor": "processor|cpu|процессор|модель процессора",
    "gpu": r"gpu|graphics(?: processor)?|video card|видеокарта|видеопроцессор|графический процессор",
    "os": "os|операционная система|ос",
    "display_type": "display type|screen type|тип экрана|тип дисплея",
    "display_tech": r"display tech(?:nology)?|screen tech(?:nology)?|технология экрана|технология дисплея",
    "storage_type": "storage type|тип накопителя|тип памяти",
    "display_resolution": "display resolution|screen resolution|разрешение экрана|разрешение",
    "resolution": "resolution|разрешение",
    "energy_class": "energy class|класс энергопотребления|энергокласс",
}
DISPLAY_NAMES = {
    "amoled": "AMOLED", "super amoled": "Super AMOLED", "dynamic amoled": "Dynamic AMOLED", "ltpo amoled": "LTPO AMOLED",
    "oled": "OLED", "ips": "IPS", "ips lcd": "IPS LCD", "lcd": "LCD", "tft": "TFT", "tn": "TN", "va": "VA", "pls": "PLS",
    "qled": "QLED", "mini led": "Mini LED", "micro led": "Micro LED", "retina": "Retina",
}
STORAGE_NAMES = {"ssd": "SSD", "hdd": "HDD", "emmc": "eMMC", "ufs": "UFS", "nvme": "NVMe", "nvme ssd": "NVMe SSD"}
OS_NAMES = (
    ("android", "Android"), ("android tv", "Android TV"), ("ios", "iOS"), ("ipados", "iPadOS"), ("windows", "Windows"),
    ("macos", "macOS"), ("linux", "Linux"), ("ubuntu", "Ubuntu"), ("freedos", "FreeDOS"), ("dos", "DOS"),
    (r"harmony\s*os", "HarmonyOS"), (r"web\s*os", "webOS"), ("tizen", "Tizen"),
)
NO_OS = ("без ос", "без операционной системы", "no os")
EDGES = " :;,-–—"


@once
def brand(x: Column, more: dict | None = None) -> Column:
    return F.coalesce(lookup(F.lower(x), BRANDS | {k.lower(): v for k, v in (more or {}).items()}), title_case(x))


@once
def color(x: Column) -> Column:
    return F.coalesce(lookup(F.lower(x), COLORS), title_case(x))


def labelled_text(raw: Column, field: str) -> Column:
    """Text of a string field without its own label in front; null for words that mean unknown."""
    x = clean_text(raw)
    if field in FIELD_LABELS:
        x = F.regexp_replace(x, rf"(?iuU)^(?:{FIELD_LABELS[field]})\s*[:\-–—]?\s*", "")
    return let(F.btrim(x, F.lit(EDGES)), lambda v: F.when((v != "") & ~F.lower(v).isin(*UNKNOWN_WORDS), v))


def string_field(raw: Column, field: str) -> Column:
    return let(labelled_text(raw, field), lambda x: named_value(x, field))


def named_value(x: Column, field: str) -> Column:
    """The usual name of what a string field says."""
    key = F.lower(F.btrim(squeeze(x), F.lit(EDGES)))
    if field in ("display_resolution", "resolution"):
        return resolution(x)
    if field == "energy_class":
        return energy_class(x)
    if field in ("display_type", "display_tech"):
        return F.coalesce(lookup(key, DISPLAY_NAMES), x)
    if field == "storage_type":
        return F.coalesce(lookup(key, STORAGE_NAMES), x)
    if field == "os":
        out = F.when(key.isin(*NO_OS), F.lit("No OS"))
        for pattern, name in OS_NAMES:  # the first that fits, so "android tv" keeps its tail behind "Android"
            rest = F.trim(F.regexp_replace(x, rf"(?iuU)^{pattern}\b", ""))
            out = out.when(x.rlike(rf"(?iuU)^{pattern}\b"), F.when(rest == "", F.lit(name)).otherwise(F.concat(F.lit(name + " "), rest)))
        return out.otherwise(x)
    return x


#: Names of processors by their model codes.
PROCESSORS = {
    "SM8550": "Snapdragon 8 Gen 2",
    "SM8550-AB": "Snapdragon 8 Gen 2",
    "SM8650-AB": "Snapdragon 8 Gen 3",
    "SM8475": "Snapdragon 8+ Gen 1",
    "SM8450": "Snapdragon 8 Gen 1",
    "SM7435": "Snapdragon 6 Gen 1",
    "SM6375": "Snapdragon 695",
    "SM6225": "Snapdragon 680",
    "Dimensity 9200": "Dimensity 9200",
    "Dimensity 9300": "Dimensity 9300",
    "Dimensity 8200": "Dimensity 8200",
    "Dimensity 7200": "Dimensity 7200",
    "Dimensity 1080": "Dimensity 1080",
    "Dimensity 700": "Dimensity 700",
    "MT6769": "Helio G85",
    "MT6833": "Dimensity 700",
    "MT6893": "Dimensity 1200",
    "A16 Bionic": "Apple A16 Bionic",
    "A17 Pro": "Apple A17 Pro",
    "A18 Pro": "Apple A18 Pro",
    "M1": "Apple M1",
    "M2": "Apple M2",
    "M3": "Apple M3",
    "M3 Pro": "Apple M3 Pro",
    "M3 Max": "Apple M3 Max",
    "Tensor G3": "Google Tensor G3",
    "Tensor G4": "Google Tensor G4",
    "Exynos 2400": "Samsung Exynos 2400",
    "Exynos 2200": "Samsung Exynos 2200",
    "Exynos 1380": "Samsung Exynos 1380",
    "Exynos 1280": "Samsung Exynos 1280",
    "Kirin 9000S": "Huawei Kirin 9000S",
    "i5-1335U": "Intel Core i5-1335U",
    "i7-13700H": "Intel Core i7-13700H",
    "i7-14700HX": "Intel Core i7-14700HX",
    "Ryzen 5 7530U": "AMD Ryzen 5 7530U",
    "Ryzen 7 7840HS": "AMD Ryzen 7 7840HS",
}


def processor(raw: Column, aliases: dict | None = None) -> Column:
    names = {k.lower(): v for k, v in (PROCESSORS if aliases is None else aliases).items()}
    return let(labelled_text(raw, "processor"), lambda x: F.coalesce(lookup(F.lower(x), names), x))


#: Parser of every typed field, by its name.
PARSERS = {
    "ram_gb": ram_gb, "storage_gb": storage_gb, "battery_mah": battery_mah, "display_size_inch": display_inch,
    "processor": processor, "main_camera_mp": camera_mp, "front_camera_mp": camera_mp, "sim_count": sim_count,
    "weight_g": weight_g, "weight_kg": weight_kg, "color": color, "hdmi_count": count_of, "refresh_rate_hz": refresh_hz,
    "power_w": power_w, "volume_l": volume_l, "warranty_months": warranty_months, "battery_wh": battery_wh,
    "usb_c_count": count_of, "smart_tv": smart_tv,
    **{f: (lambda x, f=f: capability(x, f)) for f in CAPABILITY},
    **{f: (lambda x, f=f: string_field(x, f)) for f in ("display_resolution", "display_type", "os", "gpu", "storage_type", "energy_class", "display_tech", "resolution")},
}


def parse_field(raw: Column, field: str) -> Column:
    return PARSERS[field](raw) if field in PARSERS else text_of(raw)


def is_plausible(field: str, value: Column) -> Column:
    if field not in PLAUSIBLE:
        return value.isNotNull()
    low, high = PLAUSIBLE[field]
    number = value.try_cast("double")
    return F.coalesce((F.floor(number) if field in ("ram_gb", "storage_gb", "battery_mah", "weight_g") else number).between(low, high), F.lit(False))
