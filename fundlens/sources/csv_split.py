"""Multi-line CSV read by many tasks per file: a quote-parity scan.

A line break ends a record only outside quotes, that is after an even number
of quote characters since the file's start.  So:

1. every byte range of a file (a split of Spark's text source) counts the
   quotes of its lines, natively, with a partial aggregate;
2. a prefix sum over the few ranges of a file gives the state at each start,
   and for a range that starts inside a record the range where that record began;
3. every range cuts its lines at the true record ends.  A record that crosses
   ranges arrives as fragments, at most two per range, which are put together
   by a small shuffle on the range where the record began;
4. the records are parsed by Spark's CSV parser (``from_csv``).

Only the table of ranges (a few numbers per ``spark.sql.files.maxPartitionBytes``)
passes through the driver, as Spark's own list of ranges does.  The file is read
three times: for the counts, the whole records and the fragments.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUT_SCHEMA = "file long, owner long, place long, first boolean, record string"


class MalformedCsv(ValueError):
    """A record whose quotes do not follow the dialect, so that its end is not certain."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start): each physical line with its file's hash and its range's first byte."""
    lines = spark.read.text(path, lineSep="\n").select("value", "_metadata.file_path", "_metadata.file_block_start")
    return lines.select("value", F.xxhash64("file_path").alias("file"), F.col("file_block_start").alias("start"), "file_path")


def scan_ranges(lines: DataFrame, quote: str = '"') -> DataFrame:
    """Per range of a file: the parity of its quotes, whether any line changes it, its lines, those that end in CR, any not blank."""
    count = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    cr = F.col("value").endswith("\r").cast("int").alias("cr")
    filled = (~F.col("value").isin("", "\r")).cast("int").alias("filled")
    counted = lines.select("file", "start", "file_path", count.alias("quotes"), cr, filled)
    return counted.groupBy("file", "start").agg(
        F.min("file_path").alias("file_path"),
        F.max("file_path").alias("other_path"),
        (F.sum("quotes") % 2).cast("int").alias("odd"),
        F.max(F.col("quotes") % 2).cast("int").alias("closes"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("cr").alias("cr"),
        F.max("filled").alias("filled"),
    )


def range_states(ranges) -> tuple[dict[tuple[int, int], int | None], set[int], set[tuple[int, int]]]:
    """The state at the start of every range, the files whose lines end in CRLF (more than half of them), the headers' ranges.

    (file, start) -> None where the range starts between records, else the
    start of the range where its first record began: a prefix sum of the
    parities.  A range inside one record from end to end hands on the record's
    beginning.
    """
    states: dict[tuple[int, int], int | None] = {}
    files: dict[int, str] = {}
    balance: dict[int, int] = {}
    headers: dict[int, tuple[int, int]] = {}
    last, inside, began = None, 0, 0
    for file, start, path, other, odd, closes, lines, cr, filled in sorted(ranges):
        if filled:
            headers.setdefault(file, (file, start))
        balance[file] = balance.get(file, 0) + 2 * cr - lines
        if files.setdefault(file, path) != path or path != other:
            raise RuntimeError(f"two files share a hash: {path}, {files[file]}")
        if file != last:
            last, inside, began = file, 0, start
        states[file, start] = began if inside else None
        if not inside or closes:
            began = start  # the range has a record's beginning of its own
        inside ^= odd
    return states, {f for f, n in balance.items() if n > 0}, set(headers.values())


class RecordCutter:
    """Cuts the lines of one task, given in order, into whole records and fragments."""

    def __init__(self, states, quote: str, sep: str, whole: bool):
        import re

        q, s = re.escape(quote), re.escape(sep)
        cell = f"(?:{q}(?:[^{q}]|{q}{q})*{q}|[^{q}{s}]*)"
        (self.states, self.crlf, self.headers), self.quote, self.whole = states, quote, whole
        self.proper = f"^{cell}(?:{s}{cell})*$"
        self.range = None
        self.open: list[str] = []  # lines of the record that has not ended
        self.owner = None  # the range where the open record began, if not this one
        self.inside = 0
        self.unread = False  # this range holds its file's header, and no record of it was seen

    def enter(self, file: int, start: int) -> None:
        if (file, start) not in self.states:
            raise RuntimeError("the file's ranges changed between the two scans; read it again")
        self.range, self.owner = (file, start), self.states[file, start]
        self.inside, self.unread = int(self.owner is not None), (file, start) in self.headers

    def leave(self) -> Iterator[tuple]:
        """The record that the range leaves open is a fragment."""
        if self.open:
            yield self.fragment()
        self.open, self.owner = [], None

    def fragment(self) -> tuple:
        file, start = self.range
        first = self.unread and self.owner is None
        if self.owner is None:
            self.unread = False
        return file, start if self.owner is None else self.owner, start, first, "\n".join(self.open)

    def feed(self, lines) -> Iterator[tuple]:
        """Rows of CUT_SCHEMA for some further lines (an Arrow array) of the current range."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.range[0] in self.crlf:
            lines = pc.replace_substring_regex(lines, "\r\\z", "")
        odd = pc.count_substring(lines, self.quote).to_numpy(zero_copy_only=False) & 1
        before = (self.inside + np.cumsum(odd) - odd) & 1
        begins = np.flatnonzero(before == 0)
        head = int(begins[0]) if len(begins) else len(lines)
        ends_open = int(self.inside + odd.sum()) & 1
        if head:
            self.open += lines.slice(0, head).to_pylist()
            if len(begins) or not ends_open:
                if self.owner is not None:
                    yield self.fragment()
                else:
                    yield from self.records(pa.array(["\n".join(self.open)]))
                self.open, self.owner = [], None
        self.inside = ends_open
        if not len(begins):
            return
        if ends_open:
            self.open = lines.slice(int(begins[-1])).to_pylist()
        stop = int(begins[-1]) if ends_open else len(lines)
        offsets = np.append(begins[:-1] if ends_open else begins, stop) - head
        if len(offsets) > 1:
            if len(offsets) == stop - head + 1:
                whole = lines.slice(head, stop - head)  # no record has a line break
            else:
                groups = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines.slice(head, stop - head))
                whole = pc.binary_join(groups, "\n")
            yield from self.records(whole)

    def records(self, records) -> Iterator[tuple]:
        """Whole records: checked, blank ones skipped, the first of a file marked."""
        import pyarrow.compute as pc

        records = records.filter(pc.not_equal(pc.utf8_length(records), 0))
        if not len(records):
            return
        if self.whole:
            check_records(records, self.quote, self.proper)
            file, start = self.range
            if self.unread:
                yield file, start, start, True, records.slice(0, 1)
                records = records.slice(1)
            yield file, start, start, False, records
        self.unread = False


def check_records(records, quote: str, proper: str) -> None:
    """Raise where a record with quotes does not match the dialect: its end would be a guess."""
    import pyarrow.compute as pc

    quoted = records.filter(pc.match_substring(records, quote))
    bad = quoted.filter(pc.invert(pc.match_substring_regex(quoted, proper)))
    if len(bad):
        raise MalformedCsv(
            "a quote stands inside an unquoted field or after a quoted one, so record ends are not certain; "
            f"read the file without split_records: {bad[0].as_py()[:200]!r}"
        )


def cut_records(lines: DataFrame, states, quote: str, sep: str, whole: bool) -> DataFrame:
    """Rows of CUT_SCHEMA: the whole records, or the fragments of those that cross ranges."""
    shared = lines.sparkSession.sparkContext.broadcast(states)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cutter = RecordCutter(shared.value, quote, sep, whole)
        names = ["file", "owner", "place", "first", "record"]

        def emit(rows, is_whole):
            for file, owner, place, first, text in rows:
                if is_whole != whole:
                    continue
                texts = text if is_whole else pa.array([text], pa.string())
                for at in range(0, len(texts), 4096):
                    part = texts.slice(at, 4096)
                    same = [pa.array(np.full(len(part), v, np.int64)) for v in (file, owner, place)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(np.full(len(part), first)), part], names=names)

        def split_kinds(rows):
            for row in rows:
                yield from emit([row], not isinstance(row[4], str))

        for batch in batches:
            file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            change = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(file)]):
                if lo == hi:
                    continue
                if cutter.range != (int(file[lo]), int(start[lo])):
                    yield from split_kinds(cutter.leave())
                    cutter.enter(int(file[lo]), int(start[lo]))
                yield from split_kinds(cutter.feed(batch.column(0).slice(lo, hi - lo)))
        yield from split_kinds(cutter.leave())

    return lines.select("value", "file", "start").mapInArrow(run, CUT_SCHEMA)


def joined_fragments(fragments: DataFrame, quote: str, sep: str) -> DataFrame:
    """The records that cross ranges, put together from their fragments in file order."""
    import re

    q, s = re.escape(quote), re.escape(sep)
    cell = f"(?:{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}|[^{q}{s}]*+)"
    parts = F.array_sort(F.collect_list(F.struct("place", "record")))
    text = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    whole = fragments.groupBy("file", "owner").agg(F.bool_or("first").alias("first"), text.alias("record"))
    proper = F.col("record").rlike(f"\\A{cell}(?:{s}{cell})*+\\z")
    failed = F.raise_error(F.concat(F.lit("record ends are not certain; read the file without split_records: "), F.left("record", F.lit(200))))
    return whole.select("first", F.when(proper, F.col("record")).otherwise(failed).alias("record"))


def read_split_csv(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """The CSV at ``path`` (file, folder or glob, header in each file) as text columns.

    Equal to the reader's one-task ``multiLine`` result for files in the
    dialect of ``options``: quotes only around whole fields, doubled inside.
    A record that breaks the dialect raises instead of being cut by guess.
    In files that end their lines by CRLF, a CRLF within quotes reads as LF.
    """
    quote, sep = options.get("quote", '"'), options.get("sep", options.get("delimiter", ","))
    if options.get("escape", quote) != quote or len(quote) != 1 or options.get("header") != "true":
        raise ValueError("split_records needs a header and quotes escaped by doubling")
    names = spark.read.options(**{**options, "multiLine": "true"}).csv(path).columns  # reads one record
    lines = _lines(spark, path)
    states = range_states([tuple(r) for r in scan_ranges(lines, quote).collect()])  # one row per range
    whole = cut_records(lines, states, quote, sep, True).select("first", "record")
    records = whole
    if any(owner is not None for owner in states[0].values()):
        parts = cut_records(lines, states, quote, sep, False)
        records = whole.unionByName(joined_fragments(parts, quote, sep))
    ddl = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)
    parse = {k: v for k, v in options.items() if k not in ("header", "multiLine")}
    return records.filter(~F.col("first")).select(F.from_csv("record", ddl, parse).alias("r")).select("r.*")


__all__ = ["MalformedCsv", "read_split_csv"]
