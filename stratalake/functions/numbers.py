"""Rounding and exact sums.

Sums of doubles depend on the order in which partitions arrive. Here a double column is split into
whole units of its usual precision (cents for money) and a remainder, which is absent for values within that
precision; both are summed as decimals. Sums are therefore the same on every run and after every task retry.

Bounds: a value below 1e20 that a decimal(28,8) can hold counts with 8 decimals. NaN, infinite and larger values
are in neither sum nor count; the cleaning rules (``IN_RANGE``) reject such rows before and report them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(28,8)"
# Amounts and measures are below this, which leaves room for sums of 1e8 of them in a decimal(28,8).
IN_RANGE = "abs({0}) < 1e12"
# Doubles carry whole numbers exactly up to 2**53.
_EXACT_LIMIT = float(2**53)


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: str | Column, places: int) -> Column:
    """Round half up on the decimal reading of the value; the result is a double, NULL for what no decimal can hold."""
    return F.round(col(value).try_cast(WIDE), places).cast("double")


def ratio(part: Column, count: Column) -> Column:
    """Decimal quotient; NULL where there is nothing to divide by."""
    return F.try_divide(part, count.cast("decimal(20,0)"))


class ExactSum:
    """Mergeable sum and mean of a double column whose values have ``places`` decimals as a rule."""

    def __init__(self, name: str, places: int = 2):
        self.name = name
        self.places = places

    @property
    def columns(self) -> list[str]:
        return [f"{self.name}_units", f"{self.name}_rest", f"{self.name}_n"]

    def _split(self) -> tuple[Column, Column]:
        value, scale = F.col(self.name).cast("double"), float(10**self.places)
        scaled = value * scale
        whole = F.when(F.abs(scaled) < _EXACT_LIMIT, F.rint(scaled)).when(value.isNotNull(), 0.0)
        rest = value - whole / scale
        return whole.cast("bigint"), F.when(rest != 0, rest.try_cast(WIDE))

    def _countable(self) -> Column:
        value = F.col(self.name).cast("double")
        return F.when(F.abs(value) < 1e20, True)

    def partial(self) -> list[Column]:
        """Aggregates over rows."""
        units, rest = self._split()
        names = self.columns
        return [
            F.sum(units.cast("decimal(20,0)")).cast("decimal(28,0)").alias(names[0]),
            F.sum(rest).alias(names[1]),
            F.count(self._countable()).alias(names[2]),
        ]

    def _join(self, units: Column, rest: Column) -> Column:
        whole = units.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-self.places))
        none = F.lit(Decimal(0)).cast(WIDE)
        return (whole + F.coalesce(rest.try_cast(WIDE), none)).cast(WIDE)

    def total(self) -> Column:
        """Sum, as a decimal, over rows that hold partial results."""
        units, rest, _ = self.columns
        return self._join(F.sum(F.col(units).cast("decimal(28,0)")), F.sum(rest))

    def mean(self, factor: int = 1) -> Column:
        """Mean times ``factor``, as a decimal, over rows that hold partial results."""
        return ratio((self.total() * F.lit(Decimal(factor))).cast(WIDE), F.sum(self.columns[2]))

    def total_of_rows(self) -> Column:
        """Sum, as a decimal, straight from the column."""
        units, rest = self._split()
        return self._join(F.sum(units.cast("decimal(20,0)")), F.sum(rest))

    def mean_of_rows(self) -> Column:
        return ratio(self.total_of_rows(), F.count(self._countable()))
