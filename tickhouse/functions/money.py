"""Price, size and rate arithmetic.

Stored values are ``decimal(38,18)``. Spark caps a product or quotient of two
such columns at scale 6, so products go through :func:`multiply` and ratios are
taken in double and rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(38, 18)
BPS = DecimalType(18, 6)
MINUTES_PER_YEAR = 365 * 24 * 60

# Operands of these types have a product that Spark keeps whole.
_LEFT, _RIGHT = "decimal(19,9)", "decimal(18,9)"
_LIMB = 10**9


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, and kept out of generated code."""
    return F.transform(F.array(value), use)[0]


def _limbs(value: Column) -> Column:
    """A value in units of 1e-18, as five numbers below 1e9 with its sign, lowest first.

    Cuts are towards zero. The minus operator and ``abs`` are of no use here: Spark
    rounds what they return to 34 digits.
    """
    ten = F.lit(_LIMB).cast("decimal(10,0)")

    def cut(whole: Column) -> Column:
        fraction = (value % F.lit(1)).cast("decimal(18,18)") * ten
        upper = fraction.cast("bigint")
        lower = (fraction - upper.cast("decimal(10,0)")).cast("decimal(9,9)") * ten
        units = (whole % ten).cast("bigint")
        rest = ((whole - whole % ten) / ten).cast("bigint")
        return F.array(lower.cast("bigint"), upper, units, rest % F.lit(_LIMB),
                       (rest / F.lit(_LIMB)).cast("bigint"))

    return _bound(F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)), cut)


def _long_product(left: Column, right: Column) -> Column:
    """Product by limbs, rounded half up to 18 decimals; null above 20 integer digits."""
    unit = F.lit(10**18).cast("decimal(19,0)")
    negative = (left < 0) != (right < 0)
    wide = "decimal(38,0)"

    def places(a: Column, b: Column) -> Column:
        sums = []
        for place in range(9):
            total = F.lit(0).cast("bigint")
            for i in range(max(0, place - 4), min(place, 4) + 1):
                total = total + a[i] * b[place - i]
            sums.append(total)
        return F.array(*sums)

    def carried(d: Column) -> Column:
        """Units of 1e-18; the two lowest places lie below one and only round."""
        half = F.when(negative, F.lit(-5 * 10**17)).otherwise(F.lit(5 * 10**17))
        low = d[0].cast(wide) + d[1].cast(wide) * F.lit(_LIMB) + half
        total = _bound(low.cast(wide), lambda x: ((x - x % unit) / unit).cast(wide))
        for place in range(2, 7):
            power = F.lit(Decimal(10 ** (9 * (place - 2)))).cast(wide)
            total = F.try_add(total, F.try_multiply(d[place].cast(wide), power).try_cast(wide))
        return F.when((d[7] == 0) & (d[8] == 0), total.try_cast(wide))

    def written(total: Column) -> Column:
        fraction = total % unit
        parts = (((total - fraction) / unit).cast("decimal(20,0)"),
                 fraction.cast("decimal(18,0)"))
        whole, rest = (F.translate(part.cast("string"), "-", "") for part in parts)
        return F.concat(F.when(negative, "-").otherwise(""), whole, F.lit("."),
                        F.lpad(rest, 18, "0")).try_cast(MONEY)

    return _bound(
        _limbs(left), lambda a: _bound(
            _limbs(right), lambda b: _bound(
                places(a, b), lambda d: _bound(carried(d), written))))


def multiply(left: Column, right: Column) -> Column:
    """Product of two ``decimal(38,18)`` values, exact to 18 decimals (half up beyond).

    Null if the product does not fit, which is never an error. Operands of nine
    decimals and about ten integer digits, which is nearly all of a tape, take a
    single decimal multiplication; others are multiplied limb by limb.
    """
    left, right = left.cast(MONEY), right.cast(MONEY)
    short_left, short_right = left.try_cast(_LEFT), right.try_cast(_RIGHT)
    return (
        F.when((short_left == left) & (short_right == right), short_left * short_right)
        .when(left.isNotNull() & right.isNotNull(), _long_product(left, right))
        .cast(MONEY)
    )


def convert(amount: Column, rate: Column) -> Column:
    """Currency conversion by a reference rate, with all of the rate's decimals."""
    return multiply(amount, rate).cast("decimal(38,8)")


def divide(numerator: Column, denominator: Column) -> Column:
    """Double quotient; null when the denominator is zero or null."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def quantize(value: Column) -> Column:
    """A double as ``decimal(18,6)``, rounded half up on its decimal digits."""
    return F.round(value.cast("decimal(38,12)"), 6).cast(BPS)


def ratio(numerator: Column, denominator: Column) -> Column:
    """A proportion as ``decimal(18,6)``; null on a zero denominator."""
    return quantize(divide(numerator, denominator))


def mid_price(bid: Column, ask: Column) -> Column:
    narrow = "decimal(28,12)"
    return ((bid.cast(narrow) + ask.cast(narrow)) * F.lit("0.5").cast("decimal(1,1)")).cast(MONEY)


def spread_bps(bid: Column, ask: Column) -> Column:
    """Quoted spread over mid in basis points; null unless 0 < bid < ask.

    The subtraction is decimal, so a one-cent spread on a large price keeps all
    its digits; only the final quotient is double.
    """
    mid = (bid.cast("double") + ask.cast("double")) / 2
    quoted = quantize((ask - bid).cast("double") / mid * 10_000)
    return F.when((bid > 0) & (ask > bid), quoted)


def touch_imbalance(bid_size: Column, ask_size: Column) -> Column:
    depth = bid_size.cast("double") + ask_size.cast("double")
    skew = (bid_size - ask_size).cast("double")
    return F.when(depth > 0, quantize(skew / depth))


def quotient(amount: Column, quantity: Column) -> Column:
    """Average price ``amount / quantity`` as ``decimal(28,10)``; null unless quantity > 0.

    Ten decimals absorb the last-bit error of the division, so a one-price group
    has an average equal to that price.
    """
    return F.when(quantity > 0, F.round(divide(amount, quantity), 10).cast("decimal(28,10)"))


def vwap(price: Column, quantity: Column) -> Column:
    """Aggregate: volume-weighted average price, null for a zero-volume group."""
    return quotient(F.sum(multiply(price, quantity)), F.sum(quantity))


def mean(value: Column, scale: int = 6) -> Column:
    """Aggregate: average at ``scale`` digits through an exact decimal sum.

    A double sum depends on the order in which partial sums meet; this does not,
    so a rerun with another partitioning gives the same digits. Dividing
    ``decimal(38,s)`` by ``decimal(20,0)`` keeps scale ``s``, rounded half up.
    """
    exact = value.cast(DecimalType(28, scale))
    total = F.sum(exact).cast(DecimalType(38, scale))
    return total / F.nullif(F.count(exact), F.lit(0)).cast("decimal(20,0)")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum(value * weight) / sum(weight) for ``decimal(18,6)`` values.

    A null value drops out of the numerator only.
    """
    total = F.sum(value * weight.cast("decimal(18,0)")).cast("decimal(38,6)")
    return total / F.nullif(F.sum(weight), F.lit(0)).cast("decimal(20,0)")


def annualised_volatility(log_return: Column, bar_minutes: int = 1) -> Column:
    """Aggregate: realised volatility on a 365-day year."""
    return F.stddev_samp(log_return) * F.sqrt(F.lit(MINUTES_PER_YEAR // bar_minutes))
