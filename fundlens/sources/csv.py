"""CSV inputs: header line, quoted fields with line breaks, ``"`` escaped by ``"``.

Records may span lines, so Spark's own reader gives each file to one task.
``split_records=True`` reads a file with many (``fundlens.sources.csv_split``).
A CRLF inside a quoted field is returned as LF by Spark's parser.  Convert once
to a columnar table (``fundlens.sinks.tables.save_table``) and read that for
everything else.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fundlens.functions.columns import qcol
from fundlens.session import run_concurrently
from fundlens.sources.csv_split import read_split_csv

# The CSV dialect of the inputs.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
}
TAG_PREFIX = "#"
FILE_RECORDS = 100_000
NULL_SENTINEL = "\u0000"  # never produced by a text field; marks "no null token"


def drop_tag_row(df: DataFrame, prefix: str = TAG_PREFIX) -> DataFrame:
    """Remove the semantic-tag record: all its non-empty fields start with ``#``, and it has one.

    A data row with some field that starts with ``#`` is kept, a tag record
    with empty cells is dropped.  The filter is narrow.
    """
    filled = F.filter(F.array(*[qcol(c).cast("string") for c in df.columns]), lambda v: v.isNotNull() & (v != ""))
    return df.filter(~((F.size(filled) > 0) & F.forall(filled, lambda v: v.startswith(prefix))))


# Types tried for a text column, narrowest first.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _fitting_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """(at, bits): per column, by its place in ``columns``, a bit per type of INFERRED that all its values have.

    Nulls fit all types; a column without values has no row.  The values come
    one under the other, so one short expression serves every column: an
    expression per column makes code too long to be compiled in a wide table.
    """
    values = F.array(*[F.struct(F.lit(i).alias("at"), F.trim(qcol(c)).alias("value")) for i, c in enumerate(columns)])
    value, day = F.col("value"), r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    number = value.rlike(r"^[+-]?(?!0[0-9])[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?$")
    rows = df.select(F.inline(values)).filter("value IS NOT NULL").select("at", "value", number.alias("number"))
    number = F.col("number")
    extra = {"int": number, "bigint": number, "double": number, "date": value.rlike(day + "$"), "timestamp": value.rlike(day)}
    bits = F.lit(0)
    for i, kind in enumerate(INFERRED):
        # the pattern first: a cast of text that is no number may throw inside, which costs far more
        ok = extra.get(kind, F.lit(True)) & value.try_cast(kind).isNotNull()
        bits = bits + F.when(ok, 1 << i).otherwise(0)
    return rows.groupBy("at").agg(F.bit_and(bits).alias("bits"))


def text_types(dfs: Mapping[str, DataFrame]) -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    """Per dataset the inferred type of each text column, and the error of each dataset that failed.

    A column's type is the narrowest of INFERRED that all its values have: the
    meet of its values in the lattice of types, a ``bit_and`` per column.  Each
    dataset is one aggregate; all run as concurrent jobs, one wave.
    """

    def one(df: DataFrame) -> dict[str, str] | str:
        text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
        if not text:
            return {}
        try:
            found = {r["at"]: r["bits"] for r in _fitting_types(df, text).collect()}  # one row per column with values
        except Exception as exc:  # noqa: BLE001 - reported per dataset
            return f"{type(exc).__name__}: {exc}".splitlines()[0]
        kinds = {c: next((k for j, k in enumerate(INFERRED) if bits >> j & 1), None) for at, c in enumerate(text) if (bits := found.get(at)) is not None}
        return {c: k for c, k in kinds.items() if k}

    if not dfs:
        return {}, {}
    spark = next(iter(dfs.values())).sparkSession
    done = run_concurrently(spark, {n: (lambda d=df: one(d)) for n, df in dfs.items()}, resolve_checkpoint=False)
    return {n: r for n, r in done.items() if isinstance(r, dict)}, {n: r for n, r in done.items() if isinstance(r, str)}


def cast_text(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``df`` with the named text columns trimmed and cast."""
    return df.select(*[F.trim(qcol(c)).try_cast(kinds[c]).alias(c) if c in kinds else qcol(c) for c in df.columns])


def infer_text_types(df: DataFrame) -> DataFrame:
    """Cast each text column to the first type of INFERRED that all its values have (one pass).

    Unlike the reader's own inference this runs after the tag record is gone.
    A column without values stays text, and so does one whose numbers are
    written with leading zeros (codes).
    """
    kinds, failed = text_types({"data": df})
    if failed:
        raise RuntimeError(failed["data"])
    return cast_text(df, kinds["data"])


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s fields by name, ``try_cast`` to their types.

    Absent fields become typed nulls; malformed values become null.
    """
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(qcol(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_csv_dataset(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer_schema: bool = False,
    drop_tags: bool = True,
    options: Mapping[str, str] | None = None,
    multi_line: bool = True,
    empty_as_null: bool = True,
    split_records: bool = False,
) -> DataFrame:
    """Read one CSV dataset (file, folder or glob).

    Text is read as strings, the tag row (if any) is dropped, then
    ``schema`` is applied with ``try_cast``.  ``infer_schema=True`` infers
    the types once the tag row is gone (:func:`infer_text_types`, an extra
    pass over the data).  ``multi_line=False``
    makes large files splittable across tasks, for inputs known to have no
    line break inside a quoted field; ``split_records=True`` does so for
    inputs that have them, provided quotes follow the dialect (a record that
    breaks it raises).  As with Spark's default options, an
    empty field reads as null whether quoted or not; ``empty_as_null=False``
    keeps a quoted empty field (``""``) as an empty string.
    """
    opts = dict(CSV_OPTIONS)
    opts["multiLine"] = "true" if multi_line else "false"
    if not empty_as_null:
        # unquoted empty fields still become null; "" no longer matches nullValue
        opts["nullValue"] = NULL_SENTINEL
    opts.update(options or {})
    df = read_split_csv(spark, path, opts) if split_records else spark.read.options(**opts).csv(path)
    if drop_tags:
        df = drop_tag_row(df)
    if schema is not None:
        return apply_schema(df, schema)
    return infer_text_types(df) if infer_schema else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` in the same dialect (header, ``"``-doubled quotes).

    Files hold at most FILE_RECORDS records, as a reader whose records may span lines gives a file to one task.
    """
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "mode")}
    opts["maxRecordsPerFile"] = str(FILE_RECORDS)
    opts["quoteAll"] = "false"
    df.write.mode(mode).options(**opts).csv(path)


@dataclass
class LoadResult:
    """Loaded DataFrames by name, and the error text of each one that failed."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)

    def failures_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            sorted(self.failures.items()), "dataset string, error string"
        )


def load_datasets(
    spark: SparkSession,
    registry: Mapping[str, str],
    base_dir: str | None = None,
    schemas: Mapping[str, StructType] | None = None,
    **kwargs,
) -> LoadResult:
    """Read every dataset of ``registry`` (name → file); failures are reported, not raised.

    With ``infer_schema`` the types of all datasets without a schema are
    inferred in one wave of concurrent jobs (:func:`text_types`); the other
    ``kwargs`` go to :func:`read_csv_dataset`.
    """
    result, infer = LoadResult(), kwargs.pop("infer_schema", False)
    for name, file_name in registry.items():
        path = f"{base_dir.rstrip('/')}/{file_name}" if base_dir else file_name
        try:
            result.frames[name] = read_csv_dataset(
                spark, path, schema=(schemas or {}).get(name), **kwargs
            )
        except Exception as exc:  # noqa: BLE001 - reported per dataset
            result.failures[name] = f"{type(exc).__name__}: {exc}".splitlines()[0]
    if infer:
        kinds, failed = text_types({n: df for n, df in result.frames.items() if n not in (schemas or {})})
        for name, found in kinds.items():
            result.frames[name] = cast_text(result.frames[name], found)
        for name, why in failed.items():
            del result.frames[name]
            result.failures[name] = why
    return result
