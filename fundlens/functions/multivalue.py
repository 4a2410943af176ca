"""Multi-valued text fields (comma-joined lists inside one string column)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol


def split_multi(df: DataFrame, column: str, sep: str = ",", lower: bool = False):
    """Array column of the trimmed, non-empty values of ``column``."""
    parts = F.split(qcol(column), re.escape(sep))
    parts = F.transform(parts, lambda x: F.lower(F.trim(x)) if lower else F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def explode_multi(
    df: DataFrame,
    column: str,
    sep: str = ",",
    out: str | None = None,
    lower: bool = False,
    keep_empty: bool = True,
) -> DataFrame:
    """One row per trimmed value of a multi-valued string field.

    ``a, b,,c`` becomes three rows ``a``, ``b``, ``c``.  With ``keep_empty``
    (the default) a null or value-less field keeps its row with a null value
    (``explode_outer``); otherwise such rows are dropped.  Narrow: no shuffle.
    """
    target = out or column
    values = split_multi(df, column, sep, lower)
    gen = (F.explode_outer(values) if keep_empty else F.explode(values)).alias(target)
    keep = [qcol(c) for c in df.columns if c != target]
    return df.select(*keep, gen)
