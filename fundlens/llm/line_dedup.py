"""Line deduplication: repeated runs of lines, found with distributed prefix doubling.

Every line is an id (a hash).  Lines that occur once in the corpus end every
run, so only maximal stretches of repeated lines with enough words enter the
suffix structure.  Prefix doubling ranks the windows of 1, 2, 4, ... lines of
all remaining suffixes: the rank of a window is the order of its pair of
half-window ranks in a distributed sort of the distinct pairs, so ranks at
level k are the suffix array cut after 2^k lines.  The suffixes that agree in
their first n lines (an LCP interval of depth n) are those with the same pair
of level floor(log2 n) ranks at both ends of the n lines.

A run is deleted where it has at least ``min_words`` words and an earlier copy
(by id, then line).  It is enough to look up the shortest long-enough windows
from every line forwards and backwards: each line of a repeated run lies in one
of them inside the run, and a shorter window has a copy wherever a longer one
has.  So the deleted lines are exactly those in later copies of maximal runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import written
from fundlens.operators.join import broadcast_if_small

MIN_WORDS = 25
NO_ID = -(2**63)
KEY = ("id", "h")  # a document: its id and the hash of its text


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = qcol(text_col).cast("string")
    return docs.select(F.coalesce(qcol(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def lines_of(rows: DataFrame) -> DataFrame:
    """(id, h, place, line, words) of every line of every non-empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):  # a bounded number of lines at a time
                part = batch.slice(lo, 1024)
                lines = [t.as_py().split(b"\n") for t in part.column(2).cast(pa.binary())]
                count = np.array([len(x) for x in lines])
                owner = pa.array(np.repeat(np.arange(len(lines)), count))
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                ids = np.array([digest(line) for x in lines for line in x], np.uint64).view(np.int64)
                words = np.array([len(line.split()) for x in lines for line in x], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(place.astype(np.int32)), pa.array(ids), pa.array(words)],
                    names=["id", "h", "place", "line", "words"],
                )

    return rows.filter("text <> ''").select(*KEY, "text").mapInArrow(run, "id long, h long, place int, line long, words int")


def shortest_windows(words: np.ndarray, min_words: int) -> list[list[int]]:
    """Per start in one stretch, the lengths of the shortest windows with ``min_words`` from it and to some end."""
    sums = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    out: list[set[int]] = [set() for _ in range(n)]
    ends = np.searchsorted(sums, sums[:-1] + min_words)
    for start in np.flatnonzero(ends <= n):
        out[start].add(int(ends[start] - start))
    starts = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1
    for end in np.flatnonzero(starts >= 0):
        out[starts[end]].add(int(end + 1 - starts[end]))
    return [sorted(s) for s in out]


def stretches(repeated: DataFrame, min_words: int) -> DataFrame:
    """(id, h, place, line, lengths): lines of stretches with enough words, with the window lengths to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("id", "h", "place", "line", "lengths")}
            for i, h, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                cols = rows.values
                place, line, words = (np.asarray(cols.field(k)) for k in ("place", "line", "words"))
                order = np.unique(place, return_index=True)[1]  # rows that repeat an id and text are one
                place, line, words = place[order], line[order], words[order]
                for part in np.split(np.arange(len(place)), np.flatnonzero(np.diff(place) != 1) + 1):
                    if words[part].sum() >= min_words:
                        out["id"] += [i] * len(part)
                        out["h"] += [h] * len(part)
                        out["place"] += place[part].tolist()
                        out["line"] += line[part].tolist()
                        out["lengths"] += shortest_windows(words[part], min_words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["id"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["place"], pa.int32()), pa.array(out["line"], pa.int64()), pa.array(out["lengths"], pa.list_(pa.int32()))],
                names=list(out),
            )

    per_text = repeated.groupBy(*KEY).agg(F.collect_list(F.struct("place", "line", "words")).alias("rows"))
    return per_text.mapInArrow(run, "id long, h long, place int, line long, lengths array<int>")


def doubled(level: DataFrame, k: int) -> DataFrame:
    """Ranks of windows of 2^k lines from those of 2^(k-1): (id, h, place, rank)."""
    half = 1 << (k - 1)
    second = level.select(*KEY, (F.col("place") - half).alias("place"), F.col("rank").alias("second"))
    pairs = written(level.join(second, [*KEY, "place"]), "pairs")
    # ids after a global sort rise with the order; written, so that every use sees the same ids
    ordered = pairs.select("rank", "second").distinct().orderBy("rank", "second")
    names = written(ordered.select("rank", "second", F.monotonically_increasing_id().alias("name")), "names")
    return pairs.join(names, ["rank", "second"]).select(*KEY, "place", F.col("name").alias("rank"))


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, h, ranges): per document the merged line ranges (lo, hi) that repeat an earlier run."""
    lines = written(lines_of(keyed(docs, id_col, text_col)), "lines")
    often = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("line")
    repeated = lines.join(often, "line")
    kept = written(stretches(repeated, min_words), "stretches")
    longest = kept.select(F.max(F.array_max("lengths")).alias("n")).first()["n"] or 0

    level = kept.select(*KEY, "place", F.col("line").alias("rank"))
    levels = level.withColumn("k", F.lit(0))
    for k in range(1, longest.bit_length()):
        level = written(doubled(level, k), f"rank{k}")
        levels = levels.unionByName(level.withColumn("k", F.lit(k)))

    windows = kept.select(*KEY, "place", F.explode("lengths").alias("n")).withColumn("k", F.floor(F.log2(F.col("n") + 0.5)).cast("int"))
    at = windows.withColumn("tail", (F.col("place") + F.col("n") - F.expr("shiftleft(1, k)")).cast("int"))
    head = levels.select(*KEY, "k", "place", F.col("rank").alias("first"))
    tail = levels.select(*KEY, "k", F.col("place").alias("tail"), F.col("rank").alias("last"))
    named = written(at.join(head, [*KEY, "k", "place"]).join(tail, [*KEY, "k", "tail"]).select(*KEY, "place", "n", "first", "last"), "windows")
    interval = ["n", "first", "last"]
    earliest = named.groupBy(*interval).agg(F.min(F.struct(*KEY, "place")).alias("copy"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    own = F.struct(*KEY, "place")
    met = named.join(earliest.drop("copies"), interval).filter(own > F.col("copy"))
    same = (F.col("copy.id") == F.col("id")) & (F.col("copy.h") == F.col("h"))
    lo = F.when(same, F.greatest(F.col("place"), F.col("copy.place") + F.col("n"))).otherwise(F.col("place"))
    ranges = met.select(*KEY, lo.alias("lo"), (F.col("place") + F.col("n")).alias("hi"))
    per_text = ranges.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("ranges"))
    return per_text.mapInArrow(_merge, "id long, h long, ranges array<struct<lo:int,hi:int>>")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    for batch in batches:
        merged = []
        for ranges in batch.column(2).to_pylist():
            out: list[dict] = []
            for r in ranges:
                if out and r["lo"] <= out[-1]["hi"]:
                    out[-1]["hi"] = max(out[-1]["hi"], r["hi"])
                elif r["lo"] < r["hi"]:
                    out.append(r)
            merged.append(out)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(merged, kind)], names=["id", "h", "ranges"])


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, count_col: str | None = None, drop_emptied: bool = False
) -> DataFrame:
    """``docs`` with the lines of later copies of repeated runs deleted; all columns kept.

    ``count_col`` adds the number of deleted lines; ``drop_emptied`` drops rows
    all of whose lines are deleted.  The first copy is that of the smallest id
    (null ids come first), then the first line; copies inside one document
    count too.  Rows alike in id and text are one document and get the same
    result.  Null and empty texts stay as they are.
    """
    found = broadcast_if_small(written(later_copies(docs, id_col, text_col, min_words), "ranges"))
    text = qcol(text_col).cast("string")
    row = F.struct(*[qcol(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, F.coalesce(qcol(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    joined = rows.join(found, [*KEY], "left")
    inside = lambda i: F.exists("ranges", lambda r: (i >= r["lo"]) & (i < r["hi"]))
    left = F.filter(F.split("text", "\n"), lambda line, i: ~inside(i))
    changed = joined.select(
        "row",
        F.when(F.col("ranges").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.coalesce(F.aggregate("ranges", F.lit(0), lambda s, r: s + r["hi"] - r["lo"]), F.lit(0)).alias("deleted"),
    )
    if drop_emptied:
        changed = changed.filter("NOT (deleted > 0 AND text = '')")
    count = [F.col("deleted").alias(count_col)] if count_col else []
    return changed.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns], *count)
