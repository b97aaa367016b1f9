"""Exact money arithmetic on primitive columns.

Money is a DOUBLE at every table boundary.  Inside an operator it is a LONG
number of cents: sums are then exact whatever the order the partial sums
arrive in, the columns stay inside generated code, and an overflow raises
under ANSI mode instead of wrapping.

All averages and percentages are rounded in integer arithmetic, halves away from 0.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prices of up to six decimals are whole numbers of this unit.  All others are multiplied as
# decimals, which is exact but slower.
PRICE_UNITS = 10**6
LONG_PRICE, LONG_LINE = 1e9, 1e12
PRICE, QUANTITY = "decimal(27,15)", "decimal(10,0)"


def cents(amount: Column) -> Column:
    """A DOUBLE amount with two decimals as a LONG number of cents."""
    return F.rint(amount * 100).cast("long")


def price_units(price: Column) -> Column:
    """A DOUBLE price as a LONG number of ``1 / PRICE_UNITS``."""
    return F.rint(price * PRICE_UNITS).cast("long")


def in_units(price: Column, quantity: Column | int = 1) -> Column:
    """Whether a price is a whole number of units and ``quantity`` of them stay well inside a LONG."""
    whole = F.rint(price * PRICE_UNITS) / PRICE_UNITS == price
    return whole & (F.abs(price) < LONG_PRICE) & (F.abs(price * quantity) < LONG_LINE)


def decimal_line(quantity: Column, unit_price: Column) -> Column:
    """``quantity * unit_price`` as a decimal of the price's own digits, 15 after the point."""
    return quantity.cast(QUANTITY) * unit_price.cast(PRICE)


def decimal_cents(amount: Column) -> Column:
    """A decimal amount rounded to a LONG number of cents, halves away from 0."""
    return (F.round(amount, 2) * 100).cast("long")


def amount(cents_col: Column, per_unit: float = 100.0) -> Column:
    """LONG cents (or another fixed unit) back to a DOUBLE amount."""
    return cents_col / F.lit(per_unit)


def half_up_div(num: Column, den: Column) -> Column:
    """``num / den`` rounded to a LONG, halves away from 0; NULL where ``den`` is 0 or NULL."""
    den = F.nullif(den.cast("long"), F.lit(0).cast("long"))
    num = num.cast("long")
    size = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -size).otherwise(size)


def line_cents(quantity: Column, unit_price: Column) -> Column:
    """``round(quantity * unit_price, 2)`` in cents, whatever the digits of the price."""
    quick = half_up_div(quantity * price_units(unit_price), F.lit(PRICE_UNITS // 100))
    return F.when(in_units(unit_price, quantity), quick).otherwise(
        decimal_cents(decimal_line(quantity, unit_price))
    )


def margin(price: Column, cost: Column) -> tuple[Column, Column]:
    """``round(price - cost, 2)`` in cents and ``round((price - cost) / price * 100, 2)``."""
    quick = in_units(price) & in_units(cost)
    units = price_units(price) - price_units(cost)
    exact, base = price.cast(PRICE) - cost.cast(PRICE), price.cast(PRICE)
    base = F.nullif(base, F.lit(0).cast(PRICE))
    size = F.call_function("div", F.abs(exact) * 20_000 + base, base * 2)
    share = F.when(exact < 0, -size).otherwise(size)
    return (
        F.when(quick, half_up_div(units, F.lit(PRICE_UNITS // 100))).otherwise(decimal_cents(exact)),
        F.when(quick, percent(units, price_units(price))).otherwise(amount(share)),
    )


def mean_amount(sum_cents: Column, n: Column, places: int = 2) -> Column:
    """``round(avg(amount), places)`` for 0 <= places <= 2."""
    return amount(half_up_div(sum_cents, n * 10 ** (2 - places)), float(10**places))


def mean_count(total: Column, n: Column, places: int = 1) -> Column:
    """``round(avg(integer), places)``."""
    return amount(half_up_div(total * 10**places, n), float(10**places))


def round_amount(sum_cents: Column, places: int = 0) -> Column:
    """A money sum of either sign rounded to fewer than two decimals, halves away from 0."""
    return amount(half_up_div(sum_cents, F.lit(10 ** (2 - places))), float(10**places))


def percent(num: Column, den: Column) -> Column:
    """``round(num / den * 100, 2)``."""
    return amount(half_up_div(num * 10_000, den))
