"""Exact two-decimal arithmetic.

Money is summed as whole cents in ``bigint``: the sums are exact, do not depend
on task order, and stay on the primitive aggregation path (a sum of
``decimal(10,2)`` needs a 20-digit buffer, which does not fit in a long).
Quotients are rounded once, half up, on integers.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def units(value: Column, scale: int = 2) -> Column:
    """``value`` as a whole number of ``10**-scale`` units.

    For a value with at most ``scale`` decimals the product differs from an
    integer by rounding noise only, which ``rint`` removes.  Not a number,
    infinity and what is too large to count are null.
    """
    return F.rint(value.cast("double") * (10**scale)).try_cast("bigint")


LIMB, LIMBS = 8, 4  # digits in a limb, limbs below the unit
WHOLE = 15  # digits of whole units


class _Split:
    """A double as whole ``10**-scale`` units and limbs below, by arithmetic where that is exact.

    A number of at most 15 digits that ends within the first limb is told by its whole count of that
    limb's last place: the division back gives the same double for no other such number.  All others
    need the digits of their text.
    """

    def __init__(self, value: Column, scale: int):
        self.value = value = value.cast("double")
        self.scale = scale
        self.whole = F.rint(value * 10**scale)
        self.coarse = self.whole / F.lit(float(10**scale)) == value
        self.places = F.rint(value * 10 ** (scale + LIMB))
        self.fine = (F.abs(self.places) < 1e15) & (self.places / F.lit(float(10 ** (scale + LIMB))) == value)
        self.counted = F.abs(value) < float(10 ** (WHOLE - scale))

    def text(self) -> Column:
        """The number's text without its sign; null where arithmetic is enough, and if it is not counted."""
        return F.when(self.counted & ~self.coarse & ~self.fine, F.upper(F.abs(self.value).cast("string")))

    def digits(self, text: Column) -> Column:
        """``WHOLE`` digits of whole units and those of the limbs, without a point."""
        mantissa = F.substring_index(text, "E", 1)
        power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
        # The number without its point, at least one digit before it.
        decimals = F.length(F.substring_index(mantissa, ".", -1)) - power
        digits = F.replace(mantissa, F.lit("."))
        digits = F.lpad(digits, F.greatest(F.length(digits), decimals + 1), F.lit("0"))
        before = F.length(digits) - decimals
        fixed = F.rpad(digits, before + self.scale + LIMB * LIMBS, F.lit("0"))
        return F.lpad(fixed, WHOLE + LIMB * LIMBS, "0")

    def limbs(self, digits: Column) -> list[Column]:
        """Whole units and limbs, given :meth:`digits`."""
        sign = F.signum(self.value).cast("bigint")
        parts = [F.substring(digits, 1, WHOLE)]
        parts += [F.substring(digits, WHOLE + 1 + LIMB * i, LIMB) for i in range(LIMBS)]
        top, first, *rest = [part.cast("bigint") * sign for part in parts]
        places, full, zero = self.places.cast("bigint"), F.lit(10**LIMB), F.lit(0).cast("bigint")
        top = F.when(self.coarse, self.whole.cast("bigint")).when(self.fine, F.call_function("div", places, full)).otherwise(top)
        first = F.when(self.coarse, zero).when(self.fine, places % full).otherwise(first)
        return [F.when(self.counted, c) for c in (top, first, *(F.coalesce(c, zero) for c in rest))]


def unit_limbs(value: Column, scale: int = 4) -> list[Column]:
    """``value`` as whole ``10**-scale`` units, rounded towards 0, and the decimals below, eight to a limb.

    Digits are those of the number's text, so no binary noise comes in.  The limbs reach to the 36th
    decimal (scale 4), which holds every digit of a double from 1e-19 up; later decimals are cut off.
    All limbs have the number's sign.  Not a number, infinity and what reaches
    ``10**(15 - scale)`` are null.
    """
    split = _Split(value, scale)
    return split.limbs(split.digits(split.text()))


def with_unit_limbs(df: DataFrame, column: str, names: list[str], scale: int = 4) -> DataFrame:
    """``df`` with :func:`unit_limbs` of a column as columns ``names``.

    The text and its digits are columns of their own on the way, so each is worked out once a row and
    stands once in the generated code, not once in every limb.
    """
    split, text, digits = _Split(F.col(column), scale), f"{names[0]}_text", f"{names[0]}_digits"
    told = df.withColumn(text, split.text()).withColumn(digits, split.digits(F.col(text)))
    return told.withColumns(dict(zip(names, split.limbs(F.col(digits))))).drop(text, digits)


def carried(limbs: list[Column]) -> Column:
    """Whole units, rounded down, of sums of :func:`unit_limbs`: carries go up from the last limb."""
    full = 10**LIMB
    carry = F.lit(0).cast("bigint")
    for limb in reversed(limbs[1:]):
        total = limb + carry
        carry = F.call_function("div", total - F.pmod(total, F.lit(full)), F.lit(full))
    return limbs[0] + carry


def from_units(count: Column, scale: int = 2) -> Column:
    """Inverse of :func:`units`, as a decimal."""
    return (count.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(
        f"decimal(20,{scale})"
    )


def ratio_half_up(num: Column, den: Column, places: int = 2, factor: int = 1) -> Column:
    """``num * factor / den`` rounded half up (away from zero), as a decimal.

    Null if ``den`` is 0 or null.  ``num`` and ``den`` are whole numbers and
    the work is done in 38-digit decimals, so sums over a whole history cannot
    overflow on the way.
    """
    n = num.cast("decimal(20,0)")
    d = F.nullif(F.abs(den.cast("decimal(20,0)")), F.lit(0))
    doubled = F.abs(n) * F.lit(Decimal(2 * factor * 10**places)) + d
    magnitude = F.call_function("div", doubled, d * F.lit(Decimal(2)))
    negative = (n < 0) != (den < 0)
    return from_units(F.when(negative, -magnitude).otherwise(magnitude), places)


def whole_trips(value: Column) -> Column:
    """Forecast value to a trip count: not below 0, ties to even."""
    return F.bround(F.greatest(value, F.lit(0.0)), 0).cast("bigint")
