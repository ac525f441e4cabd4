from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickhouse.functions import clock, money


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).head().asDict()


def dec(text):
    return F.lit(text).cast(money.MONEY)


def test_spread_keeps_its_digits_on_a_large_price(spark):
    r = one(spark, bps=money.spread_bps(dec("64250.10"), dec("64250.11")),
            mid=money.mid_price(dec("64250.10"), dec("64250.11")))
    assert r["bps"] == Decimal("0.001556")
    assert r["mid"] == Decimal("64250.105")


@pytest.mark.parametrize(("bid", "ask"), [("0", "1"), ("2", "2"), ("3", "2")])
def test_no_spread_for_a_crossed_locked_or_empty_book(spark, bid, ask):
    assert one(spark, s=money.spread_bps(dec(bid), dec(ask)))["s"] is None


def test_product_is_exact(spark):
    got = one(spark, p=money.multiply(dec("64250.12345678"), dec("0.00000001")))["p"]
    assert got == Decimal("64250.12345678") * Decimal("0.00000001")


@pytest.mark.parametrize(("a", "b", "product"), [
    ("0.0000000001234", "1000", "0.0000001234"), ("99999999999", "1.5", "149999999998.5"),
    ("-655074321244085492.17655208886708041", "3.23699358934779",
     "-2120471378413459540.528889261111380611"),
    ("0.000000000000000001", "0.5", "0.000000000000000001"),
    ("0.000000000000000001", "0.499", "0"), ("99999999999999999999", "1.1", None),
    ("99999999999999999999.999999999999999999", "1", "99999999999999999999.999999999999999999"),
])
def test_products_over_the_whole_range(spark, a, b, product):
    got = one(spark, p=money.multiply(dec(a), dec(b)), q=money.multiply(dec(b), dec(a)))
    want = None if product is None else Decimal(product)
    assert got["p"] == got["q"] == want


def test_conversion_keeps_the_decimals_of_a_small_rate(spark):
    assert one(spark, c=money.convert(dec("1000000"), dec("0.000247318")))["c"] == Decimal("247.318")


def test_ratio(spark):
    r = one(spark, r=money.ratio(F.lit(60), F.lit(1440)), z=money.ratio(F.lit(1), F.lit(0)),
            tie=money.ratio(F.lit(1), F.lit(128)))
    assert r == {"r": Decimal("0.041667"), "z": None, "tie": Decimal("0.007813")}


def test_touch_imbalance_of_an_empty_touch(spark):
    r = one(spark, none=money.touch_imbalance(dec("0"), dec("0")),
            some=money.touch_imbalance(dec("3"), dec("1")))
    assert r["none"] is None and r["some"] == Decimal("0.5")


def test_vwap_of_a_zero_volume_group_is_null(spark):
    df = spark.createDataFrame([(Decimal("5"), Decimal("0"))], "p decimal(38,18), q decimal(38,18)")
    assert df.agg(money.vwap(F.col("p"), F.col("q"))).head()[0] is None


def test_bar_floor_before_and_after_the_epoch(spark):
    ts = lambda s: F.lit(s).cast("timestamp")
    r = one(spark, a=clock.bar_floor(ts("2024-01-01 00:07:59.999999"), 300),
            b=clock.bar_floor(ts("1969-12-31 23:59:59"), 60))
    assert str(r["a"]) == "2024-01-01 00:05:00" and str(r["b"]) == "1969-12-31 23:59:00"


def test_millis_truncate_each_end(spark):
    ts = lambda s: F.lit(s).cast("timestamp")
    got = one(spark, d=clock.millis_between(ts("2024-01-01 00:00:00.0009"),
                                            ts("2024-01-01 00:00:00.0011")))
    assert got["d"] == 1


def test_epochs_out_of_range_are_rejected(spark):
    r = one(spark, bad=clock.epoch_millis(F.lit(-1)), ok=clock.epoch_millis(F.lit(1_000)),
            far=clock.epoch_millis(F.lit(2**63 - 1)))
    assert r["bad"] is None and r["far"] is None and str(r["ok"]) == "1970-01-01 00:00:01"


def test_unknown_interval():
    assert clock.interval_seconds("1w") == 7 * 86_400 and len(clock.INTERVAL_SECONDS) == 14
    with pytest.raises(ValueError):
        clock.interval_seconds("7m")
