import pytest
from pyspark.sql import functions as F

from tallyforge.functions import listings, records


@pytest.fixture(scope="module")
def get(spark):
    return lambda c: spark.range(1).select(c.alias("v")).first().v


L = F.lit


def test_brand_and_category(get):
    none = L(None).cast("string")
    assert get(listings.known_brand(L("Духовой шкаф Haier X"), none)) == "Haier"
    assert get(listings.known_brand(L("Чехол для Samsung S24"), none)) is None
    assert get(listings.known_brand(L("iPhone 15"), none)) == "Apple" and get(listings.known_brand(L("x"), L(" Acme "))) == "Acme"
    assert get(listings.classified(none, L("Samsung S24"), none)) == "phone"
    assert get(listings.classified(none, L('Samsung UE55 55" 4K'), none)) == "tv" and get(listings.classified(none, L("Qwerty 1"), none)) == "unknown"


def test_model(get):
    assert get(listings.model_name(L("Samsung  Galaxy S24 смартфон"), L("samsung"), L("phone"))) == "S24"
    assert get(listings.model_name(L("Case for S24"), L(None).cast("string"), L("accessory"))) is None
    assert get(listings.model_name(L("TV"), L(""), L(""))) is None


def test_specs(get):
    m = F.create_map(L("Бренд:"), L("unknown"), L("Производитель"), L(" Acme "), L("EAN-13"), L("590 1234 123457"), L("Совместимость"), L("для iPhone 15, Samsung и Pixel 8"))
    assert get(listings.stated(m, listings.BRAND_LABELS)) == "Acme" and get(listings.barcode(m)) == "5901234123457"
    assert get(listings.fits_targets(L("Чехол для Redmi 9 / Phone"), L("accessory"), m)) == ["Redmi 9", "iPhone 15", "Pixel 8"]
    assert get(listings.fits_targets(L("Redmi 9"), L("phone"), F.create_map(L("a"), L("b")))) == []


def test_records(get):
    m = F.create_map(L(" a "), L(" x  y "), L("b"), L(""), L("token"), L("t"))
    assert get(records.clean_map(m)) == {"a": "x y", "token": "t"} and get(records.redacted_map(m))["token"] == "[REDACTED]"
    assert get(records.clean_specs(m)) == {"a": "x  y", "token": "t"} and get(records.present_only(m)) == {" a ": " x  y ", "token": "t"}
    assert get(records.object_or_empty(L("[1]"))) == "{}" and get(records.object_or_empty(L('{"a":1}'))) == '{"a":1}'
    assert get(records.list_or_empty(L("x"))) == [] and get(records.canonical_map_json(F.create_map(L("b"), L(1), L("a"), L(2)))) == '{"a":2,"b":1}'
