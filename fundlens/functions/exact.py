"""Order-independent moments: sums of integers cut into digits, averages and deviations from them.

A double sum depends on the order of its rows.  Here every value is an integer
number of units, cut into digits of 21 bits; the digits are summed as longs
(inside codegen, no overflow below 2^41 rows) and put together once per group.
So a result is the same for any partitioning, any retry and any engine that
rounds values the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 21
MASK = (1 << BITS) - 1
WIDE = "decimal(38,0)"
# A value is split at 2^40: whole multiples, the rest below, and 10^-12 as the smallest fraction kept.
COARSE = float(1 << 40)
FRACTION = 10**12


def digits(value: Column, count: int = 3) -> list[Column]:
    """An integer cut into ``count`` digits of 21 bits, the last one with the sign."""
    low = [F.shiftright(value, BITS * i).bitwiseAND(MASK) for i in range(count - 1)]
    return [*low, F.shiftright(value, BITS * (count - 1))]


def _join(parts: list[Column]) -> Column:
    """The integer of summed digits; null where it has more than 38 decimal digits."""
    total = None
    for i, part in enumerate(parts):
        term = F.try_multiply(part.cast("decimal(38,0)"), F.lit(str(1 << (BITS * i))).cast(WIDE))
        total = term if total is None else F.try_add(total, term)
    return total


def _join_double(parts: list[Column]) -> Column:
    total = F.lit(0.0)
    for i in reversed(range(len(parts))):
        total = total + parts[i].cast("double") * F.lit(float(1 << (BITS * i)))
    return total


@dataclass(frozen=True)
class UnitMoments:
    """Count, sum and sum of squares of a column in units of 10^-scale, by named aggregates."""

    value: Column
    scale: int
    name: str

    def units(self) -> Column:
        if self.scale == 0:
            return self.value.cast("bigint")
        return F.round(self.value.cast("double") * F.lit(10**self.scale)).cast("bigint")

    def _finite(self) -> Column:
        v = self.value.cast("double")
        return ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))

    def aggregates(self, squares: bool = True) -> list[Column]:
        u = F.when(self._finite(), self.units())
        c, b, a = digits(u)
        sums = [c, b, a]
        if squares:
            # u^2 = (a 2^42 + b 2^21 + c)^2, cut into digits again
            terms = [c * c, 2 * b * c, 2 * a * c + b * b, 2 * a * b, a * a]
            low = [t.bitwiseAND(MASK) for t in terms]
            high = [F.shiftright(t, BITS) for t in terms]
            sums += [low[0], *[high[i] + low[i + 1] for i in range(4)], high[4]]
        strange = F.sum(F.when(~self._finite(), self.value.cast("double")))
        return [
            F.count(u).alias(f"{self.name}_n"),
            strange.alias(f"{self.name}_strange"),
            *[F.sum(s).alias(f"{self.name}_{i}") for i, s in enumerate(sums)],
        ]

    def _parts(self, lo: int, hi: int) -> list[Column]:
        return [F.col(f"{self.name}_{i}") for i in range(lo, hi)]

    def average(self) -> Column:
        n, total = F.col(f"{self.name}_n"), self._parts(0, 3)
        value = F.coalesce(_join(total).cast("double"), _join_double(total)) / F.lit(float(10**self.scale)) / n
        return F.coalesce(F.col(f"{self.name}_strange"), F.when(n > 0, value))

    def stddev(self) -> Column:
        """Sample standard deviation: null without rows, and for one row, as ``stddev_samp``."""
        n, total, square = F.col(f"{self.name}_n"), self._parts(0, 3), self._parts(3, 9)
        exact = F.try_subtract(
            F.try_multiply(n.cast(WIDE), _join(square)), F.try_multiply(_join(total), _join(total))
        ).cast("double")
        rough = n * _join_double(square) - _join_double(total) * _join_double(total)
        spread = F.greatest(F.coalesce(exact, rough), F.lit(0.0))
        value = F.sqrt(spread / (n.cast("double") * (n - 1))) / F.lit(float(10**self.scale))
        strange = F.when(F.col(f"{self.name}_strange").isNotNull(), F.lit(float("nan")))
        return F.coalesce(strange, F.when(n > 1, value))


@dataclass(frozen=True)
class WideMean:
    """Average of a double column of any magnitude up to 1e30, kept to 10^-12, by named aggregates.

    A value is split without error into whole multiples of 2^40, the whole rest
    and the fraction, which is rounded half up to 10^-12.
    """

    value: Column
    name: str

    def aggregates(self) -> list[Column]:
        v = self.value.cast("double")
        finite = ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
        ratio = v / F.lit(COARSE)
        coarse = F.when(v < 0, F.ceil(ratio)).otherwise(F.floor(ratio))  # towards 0, so that nothing is rounded
        rest = v - coarse.cast("double") * F.lit(COARSE)
        whole = F.floor(rest)
        fraction = F.floor((rest - whole.cast("double")) * F.lit(float(FRACTION)) + F.lit(0.5))
        parts = [*digits(coarse), *digits(whole, 2), *digits(fraction, 2)]
        return [
            F.count(F.when(finite, 1)).alias(f"{self.name}_n"),
            F.sum(F.when(~finite, v)).alias(f"{self.name}_strange"),
            *[F.sum(F.when(finite, p)).alias(f"{self.name}_{i}") for i, p in enumerate(parts)],
        ]

    def average(self) -> Column:
        n = F.col(f"{self.name}_n")
        part = [F.col(f"{self.name}_{i}") for i in range(7)]
        whole = F.try_add(F.try_multiply(_join(part[:3]), F.lit(str(1 << 40)).cast(WIDE)), _join(part[3:5]))
        exact = F.try_add(F.try_multiply(whole, F.lit(str(FRACTION)).cast(WIDE)), _join(part[5:]))
        rough = (_join_double(part[:3]) * F.lit(COARSE) + _join_double(part[3:5])) * F.lit(float(FRACTION)) + _join_double(part[5:])
        value = F.coalesce(exact.cast("double"), rough) / F.lit(float(FRACTION)) / n
        return F.coalesce(F.col(f"{self.name}_strange"), F.when(n > 0, value))


__all__ = ["UnitMoments", "WideMean", "digits"]
