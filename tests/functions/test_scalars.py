import uuid

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import category, identity, price, text, units, urls

MEASURES = [
    ("storage_gb", "256/512 GB", None), ("storage_gb", "8 GB + 256 GB", None), ("storage_gb", "PCIe 4.0 NVMe 512 GB", 512),
    ("storage_gb", "ROM 128", 128), ("storage_gb", "1 ТБ", 1024), ("ram_gb", "128 GB", None), ("ram_gb", "8 гб", 8),
    ("power_w", "20-30 W", None), ("power_w", "USB PD 20W + 15W", None), ("power_w", "220-240V, 50Hz, 2000W", 2000),
    ("power_w", "1500 Вт", 1500), ("volume_l", "12-15 l", None), ("volume_l", "500 ml", 0.5), ("volume_l", "1.5 л", 1.5),
    ("battery_mah", "5000/6000 mAh", None), ("battery_mah", "Li-Po 5000 mAh", 5000), ("battery_wh", "56.5 Wh", 56.5),
    ("weight_g", "190/210 g", None), ("weight_g", "0.19 kg", 190), ("weight_kg", "1900 g", 1.9),
    ("display_size_inch", "6.1/6.7 inch", None), ("display_size_inch", "2400x1080", None), ("display_size_inch", "164 cm", 64.6),
    ("display_size_inch", "6.7\" / 17 cm", 6.7), ("main_camera_mp", "50+12 MP", None), ("main_camera_mp", "108 MP, f/1.8", 108),
    ("warranty_months", "12/24 months", None), ("warranty_months", "2 years", 24), ("warranty_months", "24", 24),
    ("refresh_rate_hz", "60-120 Hz", None), ("refresh_rate_hz", "up to 120 Hz", None), ("refresh_rate_hz", "VRR 120 Hz", 120),
    ("usb_c_count", "2-3", None), ("usb_c_count", "HDMI 2.1", None), ("usb_c_count", "USB-C x2", 2), ("usb_c_count", "3 ports", 3),
    ("display_resolution", "1920*1080", "1920x1080"), ("display_resolution", "3840×2160", "3840x2160"), ("nfc", "NFC", True),
    ("has_wifi", "802.11ax", True), ("has_wifi", "нет", False), ("smart_tv", "Tizen", True), ("os", "android 14", "Android 14"),
    ("os", "Без ОС", "No OS"), ("energy_class", "a++", "A++"), ("color", "тёмно-синий", "Navy"), ("sim_count", "nano-SIM + eSIM", 2),
    ("storage_type", "Тип накопителя: nvme ssd", "NVMe SSD"), ("processor", "Процессор: неизвестно", None),
]


@pytest.fixture(scope="module")
def measured(spark):
    rows = spark.createDataFrame([(i, raw) for i, (_, raw, _) in enumerate(MEASURES)], "i int, raw string").collect()
    out = {}
    for field in {f for f, _, _ in MEASURES}:
        own = spark.createDataFrame([(r.i, r.raw) for r in rows if MEASURES[r.i][0] == field], "i int, raw string")
        out |= {r.i: r.v for r in own.select("i", units.parse_field(F.col("raw"), field).alias("v")).collect()}
    return out


@pytest.mark.parametrize("i", range(len(MEASURES)))
def test_measure(measured, i):
    assert measured[i] == MEASURES[i][2], MEASURES[i]


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'int'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize("raw,want", [
    ("12 999 000 сум", 12999000), ("по запросу", None), ("0", None), ("100 000 - 120 000 сум", None), (None, None), ("", None),
    ("1.299.000", 1299000), ("1,299.50 $", 1299), ("от 5000", None), ("1000 сум/мес", None), ("999", 999), ("10 000 20 000 old price", None),
])
def test_price(spark, raw, want):
    assert one(spark, price.price_units(F.col("raw")), raw=raw) == want


@pytest.mark.parametrize("raw,want", [("false", False), ("0", False), ("нет", False), ("true", True), ("1", True), ("", None), (None, None), ("maybe", None)])
def test_stock(spark, raw, want):
    assert one(spark, price.stock(F.col("raw")), raw=raw) is want


def test_titles_and_labels(spark):
    assert one(spark, text.title_case(F.col("x")), x="lg-tv o'neil") == "Lg-Tv O'Neil"
    assert one(spark, text.clean_text(F.col("x")), x=" a  b\n") == "a b"
    assert one(spark, text.clean_text(F.col("x")), x="  ") is None
    assert one(spark, text.spec_label(F.col("x")), x=" Объём  памяти, ГБ ") == "объем памяти"
    assert one(spark, text.is_frontend_noise(F.col("x")), x="a <script>") is True


def test_urls(spark):
    u = "HTTPS://m.Shop.example.com/a/b/?utm_source=x&q=1&ref=z#top"
    assert one(spark, urls.crawl_url(F.col("u")), u=u) == "https://shop.example.com/a/b?q=1#top"
    assert one(spark, urls.source_url(F.col("u")), u=u) == "https://m.shop.example.com/a/b"
    assert one(spark, urls.entity_url(F.col("u")), u=u) == "https://m.shop.example.com/a/b/"
    assert one(spark, urls.is_http(F.col("u")), u="ftp://x/y") is False
    assert one(spark, urls.with_page(F.col("u"), F.lit(3)), u="http://a/b?x=1&page=2") == "http://a/b?x=1&page=3"
    assert one(spark, urls.page_number(F.col("u")), u="http://a/b?page=7") == 7
    assert one(spark, urls.is_private_host(F.col("u")), u="http://172.20.1.1:80/") is True


def test_identity(spark):
    assert one(spark, identity.uuid5(F.col("x")), x="outbox:1:a") == str(uuid.uuid5(uuid.NAMESPACE_URL, "outbox:1:a"))
    assert one(spark, identity.identity_key(F.col("s"), F.col("i"), F.lit("http://a/b")), s="Shop", i=" 42 ") == "shop:42"
    assert len(one(spark, identity.entity_key(F.col("s"), F.col("i"), F.lit("http://a/b")), s="Shop", i="")) == 21


@pytest.mark.parametrize("title,url,hint,want", [
    ("Смартфон Samsung Galaxy", "", "", "phone"), ("Case for Samsung Galaxy S24", "", "phone", "accessory"), ("X1", "http://a/noutbuki/1", "", "laptop"),
    ("X1", "http://a/telefony/1", "tv", "tv"), ("X1", "", "", "unknown"),
])
def test_category(spark, title, url, hint, want):
    none = F.array().cast("array<string>")
    assert one(spark, category.infer(F.col("u"), F.col("t"), none, F.col("h")), u=url, t=title, h=hint) == want
