"""From free-form specification labels to typed columns, with confidence and conflict resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.functions import units
from tallyforge.functions.text import spec_label
from tallyforge.operators.lookups import fits_scope
from tallyforge.sources.scratch import spread, stored

#: Labels of typed fields, for all categories and for phones.
COMMON_LABELS = {
    "ram_gb": ("оперативная память", "озу", "ram"),
    "storage_gb": ("встроенная память", "внутренняя память", "память", "хранилище", "storage"),
    "refresh_rate_hz": ("частота развертки экрана", "частота обновления", "refresh rate"),
    "display_size_inch": ("диагональ экрана", "диагональ"),
    "display_resolution": ("разрешение экрана", "разрешение", "размер изображения"),
    "display_type": ("тип экрана", "тип дисплея", "тип матрицы экрана"),
    "display_tech": ("технология экрана",),
    "processor": ("процессор", "модель процессора"),
    "gpu": ("видеопроцессор", "видеокарта", "gpu"),
    "battery_mah": ("емкость аккумулятора", "аккумулятор", "battery"),
    "battery_wh": ("батарея wh", "батарея, wh", "емкость батареи"),
    "weight_g": ("вес",),
    "weight_kg": ("масса",),
    "color": ("цвет",),
    "sim_count": ("количество sim-карт", "количество sim карт", "sim"),
    "main_camera_mp": ("основная камера",),
    "front_camera_mp": ("фронтальная камера",),
    "volume_l": ("общий объем", "объем"),
    "power_w": ("потребляемая мощность", "мощность"),
    "smart_tv": ("smart tv", "поддержка smart tv"),
    "has_wifi": ("wi-fi", "wifi"),
    "has_bluetooth": ("bluetooth", "стандарт bluetooth", "версия bluetooth"),
    "hdmi": ("hdmi",),
    "hdmi_count": ("количество hdmi",),
    "usb_c_count": ("usb-c", "usb c"),
    "os": ("операционная система", "ос", "версия ос на начало продаж"),
    "energy_class": ("класс энергопотребления", "энергокласс"),
    "warranty_months": ("гарантия",),
}
PHONE_LABELS = {
    "ram_gb": ("объем оперативной памяти", "оперативная память (ram)", "ram (гб)", "объем озу"),
    "storage_gb": ("объем встроенной памяти", "пзу", "rom", "rom (гб)", "объем пзу"),
    "battery_mah": ("емкость батареи", "батарея (мач)", "battery capacity"),
    "main_camera_mp": ("камера", "задняя камера", "основная (тыловая) камера", "тыловая камера", "rear camera", "main camera"),
    "front_camera_mp": ("селфи камера", "передняя камера", "selfie camera", "front camera"),
    "display_size_inch": ("размер экрана", "размер дисплея", "экран", "screen size"),
    "display_type": ("тип дисплея", "тип матрицы", "display type"),
    "refresh_rate_hz": ("частота обновления экрана",),
    "sim_count": ("sim-карта", "sim карта", "тип sim-карты", "тип sim карты", "dual sim", "nano-sim"),
    "has_wifi": ("wi-fi", "стандарт wi-fi", "беспроводные интерфейсы"),
    "has_bluetooth": ("bluetooth", "версия bluetooth", "беспроводные интерфейсы"),
    "processor": ("чипсет", "chipset", "soc", "частота процессора"),
    "os": ("версия ос", "android version"),
    "weight_g": ("масса", "масса, г", "вес, г"),
    "color": ("цвет корпуса", "цвет товара", "расцветка"),
}
DEPRECATED_LABELS = {"ram_gb": ("оперативка",)}
#: (label, field, priority, category, store) of the other scoped rules.
SCOPED_LABELS = (
    ("оперативная память", "ram_gb", 5, "tablet", None), ("встроенная память", "storage_gb", 5, "tablet", None),
    ("масса", "weight_kg", 20, "laptop", None), ("вес", "weight_kg", 20, "laptop", None), ("аккумулятор ноутбука", "battery_wh", 10, "laptop", None),
    ("подсветка", "display_tech", 10, "tv", None), ("разъемы", "hdmi", 10, "tv", None), ("hdmi порты", "hdmi_count", 10, "tv", None),
    ("объем камеры", "volume_l", 10, "appliance", None), ("полезный объем", "volume_l", 10, "appliance", None),
    ("класс энергопотребления", "energy_class", 10, "appliance", None), ("тип sim-карты", "sim_count", 80, None, "mediapark"),
    ("объем оперативной памяти", "ram_gb", 80, None, "mediapark"), ("объем жесткого диска", "storage_gb", 80, None, "mediapark"),
    ("memory", "storage_gb", 70, None, "uzum"), ("ram", "ram_gb", 75, None, "uzum"), ("display", "display_size_inch", 60, None, "uzum"),
    ("screen", "display_size_inch", 55, None, "uzum"),
)
#: Fields that a store's own labels make unreliable.
STORE_DISABLED = {"uzum": ("hdmi",)}
FIELDS = tuple(COMMON_LABELS)
#: Fixed values of the confidence score.
BASE, DIRECT, BY_RULE = 0.58, 0.26, 0.17
NUMERIC = (
    "ram_gb", "storage_gb", "display_size_inch", "battery_mah", "battery_wh", "weight_g", "weight_kg", "main_camera_mp",
    "front_camera_mp", "volume_l", "power_w", "hdmi_count", "usb_c_count", "refresh_rate_hz", "sim_count", "warranty_months",
)
UNIT_HINT = r"gb|гб|tb|тб|mb|мб|mhz|мгц|ghz|ггц|inch|дюйм|\"|″|mah|мач|wh|вт\s*ч|кг|kg|g\b|г\b|mm|мм|cm|см|w\b|вт|l\b|л\b|mp|мп"
LEAST = {"phone": 0.70, "laptop": 0.70, "tablet": 0.70, "tv": 0.60, "appliance": 0.60}
LEAST_DEFAULT = 0.65
DISPLAY_RANGE = {"phone": (3.0, 8.5), "tablet": (5.0, 22.0), "laptop": (9.0, 21.0), "tv": (12.0, 120.0)}


def alias_rules(spark) -> DataFrame:
    """The rule table (label, field, priority, category, store, deprecated); labels as spec_label makes them."""
    rows = [(label, f, 0, None, None, False) for f, labels in COMMON_LABELS.items() for label in labels]
    rows += [(label, f, 0, "phone", None, False) for f, labels in PHONE_LABELS.items() for label in labels]
    rows += [(label, f, -5, None, None, True) for f, labels in DEPRECATED_LABELS.items() for label in labels]
    rows += [(*r, False) for r in SCOPED_LABELS]
    table = spark.createDataFrame(rows, "label string, field string, priority int, category string, store string, deprecated boolean")
    return table.withColumn("label", spec_label(F.col("label")))


def missing_unit(field: Column, raw: Column) -> Column:
    text = F.trim(F.coalesce(raw, F.lit("")))
    bare = text.rlike(r"^\d+(?:[.,]\d+)?$") | (text == "")
    return field.isin(*NUMERIC) & bare & ~text.rlike("(?iuU)" + UNIT_HINT)


def confidence(
    field: Column, raw: Column, direct: Column, priority: Column, deprecated: Column | None = None, ambiguous: Column | None = None,
    store_match: Column | None = None, corrected: Column | None = None, implausible: Column | None = None,
    wrong_category: Column | None = None, swapped: Column | None = None,
) -> Column:
    """Score of one piece of evidence, decimal(5,4) between 0.35 and 0.98."""
    def part(cond, value: float) -> Column:
        return F.lit(0).cast("decimal(5,4)") if cond is None else F.when(F.coalesce(cond, F.lit(False)), F.lit(value).cast("decimal(5,4)")).otherwise(F.lit(0).cast("decimal(5,4)"))

    no_unit = missing_unit(field, raw)
    grounded = ~no_unit & field.isin(*NUMERIC) & (F.length(F.trim(F.coalesce(raw, F.lit("")))) > 2)
    direct = F.coalesce(direct, F.lit(False))
    score = (
        F.lit(BASE).cast("decimal(5,4)") + part(direct, DIRECT) + part(~direct, BY_RULE) + part(priority >= 70, 0.12)
        + part((priority >= 10) & (priority < 70), 0.06) + part(deprecated, -0.06) + part(ambiguous, -0.10) + part(no_unit, -0.08)
        + part(grounded, 0.04) + part(store_match, 0.06) + part(corrected, -0.18) + part(implausible, -0.35)
        + part(wrong_category, -0.08) + part(swapped, -0.05)
    )
    return F.greatest(F.lit(0.35).cast("decimal(5,4)"), F.least(F.lit(0.98).cast("decimal(5,4)"), score)).cast("decimal(5,4)")


def merged_confidence(best: Column, n: Column) -> Column:
    """Of n pieces that agree: the best plus 0.04 for each further one, 0.12 at most."""
    bump = F.least(F.lit(0.12).cast("decimal(5,4)"), (F.lit(0.04).cast("decimal(5,4)") * (n - 1).cast("int")).cast("decimal(5,4)"))
    return F.least(F.lit(0.98).cast("decimal(5,4)"), best + bump).cast("decimal(5,4)")


def least_confidence(category: Column) -> Column:
    out = F.lit(LEAST_DEFAULT)
    for name, value in LEAST.items():
        out = F.when(F.lower(F.trim(category)) == name, F.lit(value)).otherwise(out)
    return out


def equivalent(a: Column, b: Column) -> Column:
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.abs(x - y) < 1e-6).otherwise(F.lower(F.trim(a)) == F.lower(F.trim(b)))


def compatible(a: Column, b: Column) -> Column:
    """Equivalent, or numbers that differ by at most 5 % of the greater."""
    x, y = a.try_cast("double"), b.try_cast("double")
    close = F.abs(x - y) <= 0.05 * F.greatest(F.abs(x), F.abs(y), F.lit(1e-9))
    return equivalent(a, b) | F.coalesce(close, F.lit(False))


def resolve(candidates: DataFrame, keys: list[str], plausible: Column) -> DataFrame:
    """One value for each key (item and field) from candidates (pos, value, confidence, least).

    A value that stands alone or agrees everywhere is kept; values within 5 % of the first give the one with most
    confidence; others conflict and leave nothing.  What is implausible or below `least` is suppressed.
    The order is that of pos; the comparison is with the first value only, as the rule has it.
    """
    rows = candidates.filter("value is not null").withColumn("_ok", plausible)
    packed = F.struct("pos", "value", "confidence", F.col("_ok").alias("ok"))
    grouped = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(packed)).alias("c"), F.max("least").alias("least"))
    first = F.col("c")[0]
    all_same = F.forall("c", lambda x: F.coalesce(equivalent(first["value"], x["value"]), F.lit(False)))
    all_near = F.forall("c", lambda x: F.coalesce(compatible(first["value"], x["value"]), F.lit(False)))
    any_ok = F.exists("c", lambda x: x["ok"])
    best = F.reduce("c", first, lambda acc, x: F.when(x["confidence"] > acc["confidence"], x).otherwise(acc))
    grouped = grouped.withColumns({"n": F.size("c"), "same": all_same, "near": all_near, "any_ok": any_ok, "best": best})
    support = F.size(F.filter("c", lambda x: x["ok"] & F.coalesce(compatible(x["value"], F.col("best.value")), F.lit(False))))
    top = F.array_max(F.transform("c", lambda x: x["confidence"]))
    grouped = grouped.withColumn("score", F.when(F.col("same"), merged_confidence(top, F.col("n"))).otherwise(merged_confidence(F.col("best.confidence"), F.greatest(support, F.lit(1)))))
    chosen = F.when(F.col("same"), first).when(F.col("near"), F.col("best"))
    grouped = grouped.withColumn("chosen", chosen)
    reason = (
        F.when(~F.col("any_ok") | (F.col("same") & ~first["ok"]), "suppressed_by_plausibility")
        .when(F.col("chosen").isNull(), "suppressed_by_conflict")
        .when(~F.col("chosen.ok"), "suppressed_by_plausibility")
        .when(F.col("score") < F.col("least"), "suppressed_by_confidence")
    )
    out = grouped.withColumn("reason", reason)
    return out.select(*keys, F.when(F.col("reason").isNull(), F.col("chosen.value")).alias("value"), "score", "n", "reason")


def typed_specs(items: DataFrame, rules: DataFrame) -> DataFrame:
    """One row an item with all typed fields as strings, from items (item, category, store, specs map<string,string>).

    The rule table is configuration, bounded and broadcast.  Items are dealt out once, by item: what an item's labels
    mean, its values and its fields are then found where they are, and nothing that grows with the items is broadcast.
    """
    known = rules.filter(~F.col("label").isin(*FIELDS)).select("label", "field", "priority", "category", "store")
    # A field's own name means the field, past all rules.
    known = known.unionByName(items.sparkSession.createDataFrame([(f, f, None, None, None) for f in FIELDS], known.schema))
    known = known.groupBy("label").agg(F.collect_list(F.struct("field", "priority", "category", "store")).alias("rules"))
    raw = spread(items.filter("item is not null"), "item").select("item", "category", "store", F.posexplode("specs").alias("pos", "key", "raw")).filter("raw is not null")
    raw = raw.withColumn("label", spec_label(F.col("key"))).join(F.broadcast(known), "label")
    names = lambda rules: F.array_distinct(F.transform(rules, lambda x: x["field"]))
    # Labels have few different texts beside their items: each is parsed once for its field.
    texts = raw.select(F.explode(names("rules")).alias("field"), "raw").distinct()
    fits = F.filter("rules", lambda x: fits_scope(x["category"], F.col("category")) & fits_scope(x["store"], F.col("store")))
    # An item can have several rows: what fits one of them counts for the label in all.
    fits = F.flatten(F.collect_list(fits).over(W.partitionBy("item", "label")))
    joined = raw.withColumn("fits", fits).withColumn("field", F.explode(names("fits")))
    priority = F.array_max(F.transform(F.filter("fits", lambda x: x["field"] == F.col("field")), lambda x: x["priority"]))
    joined = joined.select("item", "category", "store", "pos", "raw", "label", "field", priority.alias("priority"), F.col("label").isin(*FIELDS).alias("direct"))
    for store, disabled in STORE_DISABLED.items():
        joined = joined.filter(~F.coalesce((F.col("store") == store) & F.col("field").isin(*disabled), F.lit(False)))
    value = F.coalesce(*[F.when(F.col("field") == f, units.parse_field(F.col("raw"), f).cast("string")) for f in FIELDS])
    ok = F.coalesce(*[F.when(F.col("field") == f, units.is_plausible(f, F.col("value"))) for f in FIELDS])
    # Stored, so that the parsers are planned once and not with every stage that follows.
    texts = stored(texts.withColumn("value", value).withColumn("ok", ok), "spec-values")
    short = ~F.col("direct") & (F.length("label") < 4)
    scored = joined.join(texts, ["field", "raw"]).withColumn("confidence", confidence(F.col("field"), F.col("raw"), F.col("direct"), F.col("priority"), ambiguous=short))
    scored = scored.withColumn("least", least_confidence(F.coalesce("category", F.lit(""))))
    resolved = resolve(scored, ["item", "field"], F.col("ok")).filter("value is not null")
    return resolved.groupBy("item").pivot("field", list(FIELDS)).agg(F.first("value"))


def cross_checks(rows: DataFrame, category: str = "category") -> DataFrame:
    """Null what contradicts other fields of the row, in a fixed order, and list the reasons in `warnings`.

    Each check sees what the checks before it left.  Columns that the table lacks are skipped.
    """
    c = F.lower(F.trim(F.coalesce(F.col(category), F.lit(""))))
    have = set(rows.columns)
    rows = rows.withColumn("warnings", F.array().cast("array<string>"))

    def drop(rows, needs, bad, columns, warning):
        if not set(needs) <= have:
            return rows
        rows = rows.withColumn("_bad", F.coalesce(bad, F.lit(False)))
        rows = rows.withColumns({x: F.when(~F.col("_bad"), F.col(x)) for x in columns})
        return rows.withColumn("warnings", F.when(F.col("_bad"), F.array_union("warnings", F.array(F.lit(warning)))).otherwise(F.col("warnings"))).drop("_bad")

    mobile = c.isin("phone", "tablet", "laptop")
    size = F.col("display_size_inch")
    fits = size.between(1.0, 100.0)
    for name, (low, high) in DISPLAY_RANGE.items():
        fits = F.when(c == name, size.between(low, high)).otherwise(fits)
    mah, wh = F.col("battery_mah"), F.col("battery_wh")
    g, kg = F.col("weight_g"), F.col("weight_kg")
    heavy = c.isin("laptop", "tv", "appliance") & ~mah.between(500, 50000)
    checks = [
        (("ram_gb", "storage_gb"), mobile & (F.col("ram_gb") > F.col("storage_gb")), ["ram_gb"], "ram_storage_swap_suspected"),
        (("display_size_inch",), ~fits, ["display_size_inch"], "category_mismatch"),
        (("battery_mah", "battery_wh"), heavy | ((c == "laptop") & wh.isNull() & (mah > 25000)), ["battery_mah"], "category_mismatch"),
        (("battery_wh",), wh.isNotNull() & c.isin("phone", "tablet"), ["battery_wh"], "category_mismatch"),
        (("weight_g", "weight_kg"), F.abs(g - F.floor(kg * 1000)) > F.greatest(F.lit(100), F.floor(0.2 * F.greatest(g, F.lit(1)))), ["weight_g", "weight_kg"], "inconsistent_weight_units"),
        (("main_camera_mp",), ~F.col("main_camera_mp").between(1, 200), ["main_camera_mp"], "implausible_value"),
        (("front_camera_mp",), ~F.col("front_camera_mp").between(1, 64), ["front_camera_mp"], "implausible_value"),
        (("volume_l",), (c == "appliance") & ~F.col("volume_l").between(0.01, 800), ["volume_l"], "implausible_value"),
        (("power_w",), (c == "appliance") & ~F.col("power_w").between(1, 30000), ["power_w"], "implausible_value"),
        (("smart_tv",), F.col("smart_tv") & c.isin("appliance", "phone"), ["smart_tv"], "cross_field_conflict"),
        (("hdmi", "hdmi_count"), ~F.col("hdmi") & (F.col("hdmi_count") > 0), ["hdmi_count"], "inconsistent_hdmi_state"),
    ]
    for needs, bad, columns, warning in checks:
        if set(needs) <= have:
            rows = drop(rows, needs, bad, columns, warning)
    return rows


def coverage(mapped: Column, total: Column) -> Column:
    """Share of labels that were mapped; 1 where there was none."""
    return F.coalesce(F.try_divide(mapped, total), F.lit(1.0))
