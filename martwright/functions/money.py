"""Exact money arithmetic.

Sums stay decimal. A quotient is rounded once, from exact integers, half away
from zero: a double quotient would misplace ties such as 1.005, and Spark's
decimal division already rounds before the final ``round`` sees the value.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

_WHOLE = "decimal(38,0)"


def line_total(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(MONEY)


def _whole(value: Column) -> Column:
    """The value in ten-thousandths: a quantity times a price has four decimals."""
    return (value.cast("decimal(38,4)") * 10_000).cast(_WHOLE)


def half_up_ratio(num: Column, den: Column, places: int = 2, times: int = 1) -> Column:
    """``round(times * num / den, places)`` exactly; NULL when ``den`` is zero or NULL.

    ``num`` and ``den`` are integers or decimals with at most four decimals.
    """
    scaled = F.abs(_whole(num)) * F.lit(2 * times * 10**places)
    divisor = F.abs(_whole(den))
    units = F.call_function(
        "div", (scaled + divisor).cast(_WHOLE), (divisor * 2).cast(_WHOLE)
    ).cast("decimal(20,0)")
    value = (units * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(22,{places})")
    signed = F.when(F.signum(num) * F.signum(den) < 0, -value).otherwise(value)
    return F.when(den != 0, signed)


def null_safe_ratio(num: Column, den: Column) -> Column:
    """Unrounded quotient as double; NULL instead of an error on a zero divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))
