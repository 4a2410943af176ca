"""Column expressions shared by the operators (pure ``pyspark.sql.functions``)."""

from fundlens.functions.columns import (
    EPS,
    coalesce_existing,
    fold_name,
    guarded_ratio,
    qcol,
    resolve_column,
    resolve_columns,
    safe_ratio,
    sum_measure,
    typed_null,
)
from fundlens.functions.multivalue import explode_multi, split_multi

__all__ = [
    "EPS",
    "coalesce_existing",
    "explode_multi",
    "fold_name",
    "guarded_ratio",
    "qcol",
    "resolve_column",
    "resolve_columns",
    "safe_ratio",
    "split_multi",
    "sum_measure",
    "typed_null",
]
