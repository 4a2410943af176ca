"""Column-level helpers: quoting, name resolution, guarded division, exact sums.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing runs Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.window import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType

# Fixed value: the divisor guard every ratio feature adds to its denominator,
# so a zero denominator yields a large finite number instead of null.
EPS = 1e-9


def qcol(name: str) -> Column:
    """Column by its exact name, safe for names with spaces, dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold_name(name: str) -> str:
    """Case-, space- and underscore-insensitive form of a column name."""
    return re.sub(r"[\s_]+", "", name).lower()


def resolve_columns(df: DataFrame, candidates: Iterable[str]) -> list[str]:
    """Physical columns of ``df`` matching any candidate, in candidate order.

    Names are compared after :func:`fold_name`, so ``In Need`` and ``inneed``
    or ``Country ISO3`` and ``country_iso3`` match each other.  Pure metadata:
    no Spark job is started.
    """
    by_fold: dict[str, list[str]] = {}
    for name in df.columns:
        by_fold.setdefault(fold_name(name), []).append(name)
    found: list[str] = []
    for cand in candidates:
        for name in by_fold.get(fold_name(cand), []):
            if name not in found:
                found.append(name)
    return found


def resolve_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First existing column among ``candidates`` (folded match), else None."""
    found = resolve_columns(df, candidates)
    return found[0] if found else None


def coalesce_existing(
    df: DataFrame, candidates: Sequence[str], dtype: DataType | str | None = None
) -> Column | None:
    """First non-null value across the candidate columns that exist.

    Returns None when no candidate exists; with ``dtype`` each input is
    ``try_cast`` first, so malformed text becomes null instead of failing.
    """
    names = resolve_columns(df, candidates)
    if not names:
        return None
    cols = [qcol(n) if dtype is None else qcol(n).try_cast(dtype) for n in names]
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def typed_null(dtype: DataType | str) -> Column:
    return F.lit(None).cast(dtype)


def safe_ratio(num: Column, den: Column, eps: float = EPS) -> Column:
    """``num / (den + eps)``: never null for non-null inputs, never raises."""
    return num / (den + F.lit(eps))


def guarded_ratio(num: Column, den: Column, guard: Column | None = None) -> Column:
    """``num / den`` where ``guard`` (default ``den``) is positive, else null."""
    g = den if guard is None else guard
    return F.when(g > 0, num / den)


def sum_measure(
    c: Column, exact_scale: int | None = None, over: WindowSpec | None = None
) -> Column:
    """Sum of a double measure.

    ``exact_scale=None`` is a plain double sum (fast, but the last bits depend
    on how rows are partitioned).  With ``exact_scale=k`` every value is
    rounded half up to ``10**-k`` units (a smaller value counts as 0) and summed
    as integers, so the total is identical for any partitioning and in any SQL
    engine that rounds the same way.  The sums are longs, inside codegen, and
    do not overflow for values below 9e18 units; a NaN makes the total NaN.
    """
    parts = measure_parts(c, exact_scale)
    summed = [agg(p) if over is None else agg(p).over(over) for agg, p in parts]
    return measure_total(summed, exact_scale)


def measure_parts(c: Column, exact_scale: int | None = None) -> list[tuple[Callable[[Column], Column], Column]]:
    """(aggregate, value) pairs whose results :func:`measure_total` puts together.

    Each aggregate may be applied again to its own results, so totals can be
    taken in levels (per salt, then per key) without losing exactness.
    """
    if exact_scale is None:
        return [(F.sum, c.cast(DoubleType()))]
    value = c.cast(DoubleType())
    units = F.when(~F.isnan(value), F.round(value * 10**exact_scale).cast("bigint"))
    # two long sums, of the high and the low 32 bits, cannot overflow where one would
    return [(F.sum, F.shiftright(units, 32)), (F.sum, units.bitwiseAND(0xFFFFFFFF)), (F.max, F.isnan(value))]


def measure_total(summed: Sequence[Column], exact_scale: int | None = None) -> Column:
    """The total from the aggregated parts of :func:`measure_parts`."""
    if exact_scale is None:
        return summed[0]
    high, low, nan = summed
    total = high.cast("decimal(19,0)") * F.lit(2**32).cast("decimal(10,0)") + low.cast("decimal(19,0)")
    return F.when(nan, F.lit(float("nan"))).otherwise(total.cast(DoubleType()) / F.lit(float(10**exact_scale)))
