"""N-gram Jaccard self-join over count-vector points, with bounded nodes.

A document is the set of its distinct word shingles.  Shingles are hashed into
GROUPS groups; the group counts are the document's point.  For two points the
sum of coordinate minima bounds the overlap of the sets from above, and for two
boxes (nodes) the sum of the minima of their upper corners bounds every pair
between them: the test of an R-tree join.  Counts of unrelated texts are too
alike for boxes over all documents to prune, so the tree's top level is a
directory of cells: two sets of similarity t share one of the first
n - ceil(t n) + 1 shingles in any common order, and a cell holds the documents
with a given one.  The order puts shingles that are frequent in a bounded
sample last, so a passage shared by many documents makes no cells; it affects
speed only, any order gives all pairs.

Equal sets are collapsed first.  In every cell all members are compared with a
hub (linear work), and linked documents get one component.  Only cells that
still hold several components go on: one of up to NODE members is one node
whose pairs across components go on if their sizes allow a link; a larger one
(which has several hubs) is cut into nodes whose boxes and points are compared.
The pairs that are left are bounded by finer points, whose groups grow with the set (about
FINE shingles each, so long texts are pruned like short ones), and verified on
the whole sets, which travel once per star of pairs.
Thus copies are never expanded into all pairs, no task holds a whole cell, and
no link between different sets is lost for the components.

The number of links needs every pair, but only within components, as a link
joins its ends: a component is dealt into chunks, and each pair of chunks
counts the links between its sets, which leave it as one number per set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import id_and_text, slices, written
from fundlens.llm.graph import ROWS_PER_TASK, components
from fundlens.llm.shingles import mix, shingle_sets
from fundlens.operators.join import SizedSide, broadcast_if_small, skew_join

WIDTH = 5
GROUPS = 64
NODE = 64  # members of a node
FINE = 4  # shingles of a group of a fine point, on average
CHUNK_SHINGLES = 1 << 20  # of the members of a chunk, on average
TASK_SHINGLES = 1 << 21  # of the pairs that one task compares, on average
BUCKET_ROWS = 50_000  # members of small cells that one task compares, on average
SLAB = 1 << 20  # pairs looked at together
EARLIER = 8  # cells of a set that are known where it is met in the next one
PACKED_SHINGLES = 500_000  # of the sets whose directory shingles one task unpacks, on average
HUBS = 2  # of a cell of more than a node; smaller ones have one
ORDER_SAMPLE = 4_000  # documents whose shingle counts fix the order
PERCENT = 75
MOVED = 2_000_000  # rows of two or three ids up to which a side is broadcast; beyond it is shuffled


def tasks_for(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for a stage of so many rows: a few rows need not go through every shuffle partition."""
    return 4 + rows // rows_per_task


def _texts(batch: pa.RecordBatch, i: int) -> list[bytes]:
    return [t.as_py() or b"" for t in batch.column(i).cast(pa.binary())]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def shingle_arrays(rows: DataFrame, width: int) -> DataFrame:
    """(id, shingles array<long>) of an (id, text) frame with long ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            h, owner = shingle_sets(_texts(batch, 1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(h.view(np.int64), owner, batch.num_rows)], names=["id", "shingles"])

    return rows.select("id", "text").mapInArrow(run, "id long, shingles array<long>")


def sample_counts(rows: DataFrame, width: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that occur in 2 or more of about ``sample`` documents, and in how many."""
    n = rows.count()
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    part = rows.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < math.ceil(min(1.0, sample / n) * (1 << 20)))
    counts = shingle_arrays(part, width).select(F.explode("shingles").alias("s")).groupBy("s").count().filter("count >= 2").coalesce(8)
    table = counts.toArrow()  # bounded by the sample
    s = table["s"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(s)
    return s[order], table["count"].to_numpy()[order]


def fine_point(h: np.ndarray) -> bytes:
    """Group counts of one set, about FINE shingles a group: the number of bits of a group, then the counts."""
    bits = max(6, math.ceil(math.log2(max(len(h), 1) / FINE)))
    counts = np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return bytes([bits]) + counts.astype(np.uint8 if len(h) == 0 or counts.max() < 256 else np.uint32).tobytes()


def _counts(point: bytes) -> np.ndarray:
    bits = point[0]
    return np.frombuffer(point, np.uint8 if len(point) == 1 + (1 << bits) else np.uint32, offset=1).astype(np.int64)


def overlap_bound(a: bytes, b: bytes) -> int:
    """No pair of sets with these fine points has more in common: the sum of the minima of their counts.

    Groups are the leading bits of a hash, so the finer point is summed up to the coarser one.
    """
    x, y = sorted((_counts(a), _counts(b)), key=len)
    return int(np.minimum(x, y.reshape(len(x), -1).sum(1)).sum())


def points(rows: DataFrame, width: int, percent: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(id, n, k1, k2, prefix, point, fine): set size, set digest, directory shingles in order, group counts, finer ones."""
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = shared.value
        for batch in (part for b in batches for part in slices(b, 1)):
            rows_n = batch.num_rows
            h, owner = shingle_sets(_texts(batch, 1), width)
            n = np.bincount(owner, minlength=rows_n)
            freq = np.zeros(len(h), np.int64)
            if len(common) and len(h):
                at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                freq = np.where(common[at] == h, counts[at], 0)
            point = np.bincount(owner * GROUPS + (h >> np.uint64(58)).astype(np.int64), minlength=rows_n * GROUPS).astype(np.int32)
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            sets = np.split(h, first[1:]) if rows_n else []
            k1, k2 = np.zeros(rows_n, np.uint64), np.zeros(rows_n, np.uint64)
            full = np.flatnonzero(n)
            if len(full):
                k1[full] = np.add.reduceat(h, first[full])
                k2[full] = np.add.reduceat(h * (h | np.uint64(1)), first[full])
            by = np.argsort((owner.astype(np.int64) << 32) | np.minimum(freq, (1 << 32) - 1), kind="stable")  # hashes are in order already
            h, o = h[by], owner[by]
            keep = np.arange(len(h)) - np.repeat(first, n) < np.repeat(n - -(-percent * n // 100) + 1, n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n.astype(np.int64)),
                    pa.array(k1.view(np.int64)),
                    pa.array(k2.view(np.int64)),
                    _lists(h[keep].view(np.int64), o[keep], rows_n),
                    _lists(point, np.repeat(np.arange(rows_n), GROUPS), rows_n),
                    pa.array([fine_point(s) for s in sets], pa.binary()),
                ],
                names=["id", "n", "k1", "k2", "prefix", "point", "fine"],
            )

    schema = "id long, n long, k1 long, k2 long, prefix array<long>, point array<int>, fine binary"
    return rows.select("id", "text").mapInArrow(run, schema)


SHARED = "cell long, id long, n long, i long"


def _blob(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def shared_cells(reps: DataFrame, tasks: int) -> DataFrame:
    """(cell, id, n, i) of every directory shingle that two or more sets have.

    A task packs the shingles of a batch into buckets by hash.  A shingle that
    repeats within the batch is known to be shared: its rows leave at once, and
    its bucket only hears of it, so a bucket gets one entry per batch of even
    the commonest shingle.  The bucket returns the rows of what it saw twice.
    """
    buckets = 2 * int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        lists = batch.column(2)
        count = np.asarray(lists.value_lengths())
        cell = np.asarray(lists.flatten()).astype(np.int64)
        i = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
        id_, n = (np.repeat(np.asarray(batch.column(k)), count) for k in (0, 1))
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        same = np.concatenate([[False], cell[1:] == cell[:-1]])
        again = same | np.concatenate([same[1:], [False]])
        return cell, id_[order], n[order], i[order], again, again & ~same

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, id_, n, i, again, _ = flat(batch)
            yield pa.RecordBatch.from_arrays([pa.array(x[again]) for x in (cell, id_, n, i)], names=["cell", "id", "n", "i"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, id_, n, i, again, first = flat(batch)
            i = np.where(again, -1, i)  # told, not asked
            keep = ~again | first
            cell, id_, n, i = cell[keep], np.where(again, 0, id_)[keep], np.where(again, 0, n)[keep], i[keep]
            bucket = (mix(cell.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            parts = [(b, order[starts[b] : starts[b + 1]]) for b in range(buckets) if starts[b + 1] > starts[b]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in parts], pa.int32())]
                + [pa.array([_blob(x[p].astype(t)) for _, p in parts], pa.binary()) for x, t in ((cell, np.int64), (id_, np.int64), (n, np.int32), (i, np.int32))],
                names=["bucket", "cell", "id", "n", "i"],
            )

    def shared(table: pa.Table) -> pa.Table:
        types = {"cell": np.int64, "id": np.int64, "n": np.int32, "i": np.int32}
        cell, id_, n, i = (np.concatenate([np.frombuffer(zstandard.decompress(b.as_py()), t) for b in table[c]]) for c, t in types.items())
        order = np.argsort(cell, kind="stable")
        cell, id_, n, i = cell[order], id_[order], n[order], i[order]
        same = np.concatenate([[False], cell[1:] == cell[:-1]])
        seen = (same | np.concatenate([same[1:], [False]])) & (i >= 0)
        return pa.table({"cell": cell[seen], "id": id_[seen], "n": n[seen].astype(np.int64), "i": i[seen].astype(np.int64)})

    rows = reps.select("id", "n", "prefix")
    packed = rows.mapInArrow(pack, "bucket int, cell binary, id binary, n binary, i binary")
    return rows.mapInArrow(at_once, SHARED).unionByName(packed.groupBy("bucket").applyInArrow(shared, SHARED).coalesce(tasks))


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """The overlap from which two sets of these sizes are linked: overlap (100 + p) >= p (na + nb)."""
    return F.ceil(percent * (na + nb) / F.lit(100.0 + percent) - 1e-9)


def _sized(df: DataFrame, side: SizedSide) -> DataFrame:
    """``df``, made from a side's frame, hinted for broadcast where the side was found small."""
    return F.broadcast(df) if side.small else df


def points_of(ids: DataFrame, point_of: DataFrame, tasks: int) -> SizedSide:
    """The rows of ``point_of`` whose id is in ``ids``, materialized and sized."""
    wanted = broadcast_if_small(ids.distinct().coalesce(tasks), MOVED)
    return SizedSide.of(point_of.join(wanted, "id", "left_semi"), MOVED)


def verified(pairs: DataFrame, point_of: DataFrame, rows: DataFrame, width: int, percent: int, tasks: int | None = None) -> DataFrame:
    """The linked ones of distinct ``pairs`` (a, b): bounded by their fine points, then compared as whole sets.

    The pairs that are left are seen as stars: of its two ends the one with
    more pairs is the hub.  A hub's members are dealt into chunks of about NODE
    members and CHUNK_SHINGLES shingles; a member's set is sent once to each of
    its stars, the hub's once to each chunk, and never once per pair.  ``tasks``
    bounds those that make the list of pairs.
    """

    pairs = written(pairs.distinct(), "pairs", tasks)
    held = points_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), point_of.select("id", "n", "fine"), tasks_for(pairs.count()))

    def side(x: str) -> DataFrame:
        return held.frame.select(F.col("id").alias(x), F.col("n").alias("n" + x), F.col("fine").alias("p" + x))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (np.asarray(batch.column(i)) for i in (2, 3))
            need = percent * (na + nb) / (100 + percent) - 1e-9
            points = zip(batch.column(4), batch.column(5))
            near = [overlap_bound(x.as_py(), y.as_py()) >= least for (x, y), least in zip(points, need.tolist())]
            yield batch.select([0, 1, 2, 3]).filter(pa.array(near, pa.bool_()))

    met = pairs.join(_sized(side("a"), held), "a").join(_sized(side("b"), held), "b")
    met = met.filter("100 * least(na, nb) >= %d * greatest(na, nb)" % percent)
    likely = met.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(bounded, "a long, b long, na long, nb long")
    likely = written(likely, "likely")
    few = tasks_for(likely.count())
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("nb").alias("other")), F.struct(F.col("b").alias("id"), F.col("na").alias("other"))))
    degree = likely.select(ends.alias("e")).groupBy("e.id").agg(F.count(F.lit(1)).alias("deg"), F.sum("e.other").alias("load"))
    degree = SizedSide.of(degree.coalesce(few), MOVED)
    of = lambda x: _sized(degree.frame.select(F.col("id").alias(x), F.struct("deg", "id", "load").alias("d" + x)), degree)
    turned = likely.join(of("a"), "a").join(of("b"), "b").withColumn("hub", F.greatest("da", "db"))
    member = F.when(F.col("hub.id") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    chunks = F.ceil(F.greatest(F.col("hub.deg") / NODE, F.col("hub.load") / CHUNK_SHINGLES))
    star = turned.select(F.col("hub.id").alias("hub"), member.alias("id"), F.pmod(F.xxhash64(member, F.lit(7)), chunks).alias("chunk"))
    star = written(star, "stars", few)
    seats = star.unionByName(star.select("hub", F.col("hub").alias("id"), "chunk").distinct().coalesce(few))
    # texts without a pair are not moved where the list of the others can be broadcast
    sought = broadcast_if_small(seats.select("id").distinct().coalesce(few), MOVED)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            h, owner = shingle_sets(_texts(batch, 1), width)
            at = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            blobs = [h[lo:hi].tobytes() for lo, hi in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["id", "set"])

    def compare(table: pa.Table) -> pa.Table:
        hub = table["hub"][0].as_py()
        ids = table["id"].to_numpy()
        held = [np.frombuffer(x.as_py(), np.uint64) for x in table["set"]]
        centres = [x for i, x in zip(ids, held) if i == hub and len(x)]  # several where rows repeat the id

        def near(x: np.ndarray, centre: np.ndarray) -> bool:
            at = np.minimum(np.searchsorted(centre, x), len(centre) - 1)
            both = int((centre[at] == x).sum())
            return 100 * both >= percent * (len(x) + len(centre) - both)

        linked = {i for i, x in zip(ids.tolist(), held) if i != hub and len(x) and any(near(x, c) for c in centres)}
        other = np.array(sorted(linked), np.int64)
        return pa.table({"a": np.minimum(other, hub), "b": np.maximum(other, hub)})

    moved = rows.join(sought, "id", "left_semi").select("id", "text").mapInArrow(sets, "id long, set binary")
    seated = moved.join(broadcast_if_small(seats, MOVED), "id").select("hub", "chunk", "id", "set")
    load = likely.agg(F.sum(F.col("na") + F.col("nb"))).first()[0] or 0
    return written(seated.groupBy("hub", "chunk").applyInArrow(compare, "a long, b long"), "linked", 8 + load // TASK_SHINGLES)


def _alike(na: Column, nb: Column, ia: Column, ib: Column, percent: int) -> Column:
    """Sizes and places allow a link whose first common shingle is this cell's."""
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return sizes & (F.least(na - ia, nb - ib) >= _needed(na, nb, percent))


def node_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of different components in a common cell that boxes and points let through.

    ``members``: cell, id, n, i (place in the prefix), point, component, size (of the cell).
    """
    step = math.log(100 / percent)
    band = F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    salt = F.pmod(F.xxhash64("id", "cell"), F.ceil(F.col("size") / NODE)).cast("int")
    row = F.struct("id", "n", "i", "component", "point")
    nodes = members.withColumn("band", band).withColumn("salt", salt).groupBy("cell", "band", "salt").agg(F.collect_list(row).alias("rows"))
    left = nodes.select("cell", F.col("band").alias("band_a"), F.col("salt").alias("salt_a"), F.col("rows").alias("ra"))
    right = nodes.select(
        "cell", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band_a"), F.col("band").alias("band_b"), F.col("salt").alias("salt_b"), F.col("rows").alias("rb")
    )
    # every pair of nodes of a cell whose sizes can match, once
    met = left.join(right, ["cell", "band_a"]).filter("band_a < band_b OR salt_a <= salt_b").select("ra", "rb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(col: pa.ListArray, r: int) -> tuple[np.ndarray, ...]:
            s = col.slice(r, 1).flatten()
            f = {name: s.field(name) for name in ("id", "n", "i", "component")}
            p = np.asarray(s.field("point").flatten()).reshape(len(s), GROUPS)
            return *(np.asarray(f[k]) for k in ("id", "n", "i", "component")), p

        for batch in batches:
            out_a, out_b = [], []
            for r in range(batch.num_rows):
                ia, na, pa_, ca, va = read(batch.column(0), r)
                ib, nb, pb_, cb, vb = read(batch.column(1), r)
                least = percent * (na.min() + nb.min()) / (100 + percent)
                if np.minimum(va.max(0), vb.max(0)).sum() < least - 1e-9:
                    continue  # the boxes share too little for any pair
                need = percent * (na[:, None] + nb[None]) / (100 + percent) - 1e-9
                ok = (ca[:, None] != cb[None]) & (ia[:, None] != ib[None])
                ok &= np.minimum((na - pa_)[:, None], (nb - pb_)[None]) >= need
                x, y = np.nonzero(ok)
                if len(x):
                    near = np.minimum(va[x], vb[y]).sum(1) >= need[x, y]
                    x, y = x[near], y[near]
                    out_a.append(np.minimum(ia[x], ib[y]))
                    out_b.append(np.maximum(ia[x], ib[y]))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    rows_met = members.agg(F.sum("size")).first()[0] or 0  # two for every pair
    few = tasks_for(rows_met, 2 * SLAB)
    return met.coalesce(few).mapInArrow(run, "a long, b long").distinct().coalesce(few)


def cell_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of different components in cells of up to NODE members that sizes and places let through.

    ``cells``: cell, id, n, i, component, of a written table, and ``rest`` if known: at most so many shingles
    of the set, from its place in this cell on, are in a set of another component whose prefix ends no sooner.
    A task compares the cells of a bucket, about BUCKET_ROWS members.  No points travel here: a set may be in
    many cells, and :func:`verified` bounds every pair once, by its fine points.

    Sets that are much alike meet in most of their cells.  Every member brings the EARLIER cells before this
    one in its own list, and a pair with one of them in common is left to that cell: its places there are no
    later, so it is let through there if it is here.
    """
    has_rest = "rest" in cells.columns

    def run(table: pa.Table) -> pa.Table:
        names = ("cell", "id", "n", "i", "component", *(["rest"] if has_rest else []))
        order = np.argsort(table["cell"].to_numpy(), kind="stable")
        cell, id_, n, i, component, *rest = (table[c].to_numpy()[order] for c in names)
        lists = table["earlier"].combine_chunks()
        count = np.asarray(lists.value_lengths()).astype(np.int64)
        known = np.zeros((len(lists), EARLIER), bool)
        known[np.repeat(np.arange(len(lists)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)] = True
        earlier = np.zeros((len(lists), EARLIER), np.int64)
        earlier[known] = np.asarray(lists.flatten())
        earlier, known = earlier[order], known[order]

        def first_met(u: np.ndarray, v: np.ndarray) -> np.ndarray:
            before = np.zeros(len(u), bool)
            for x in range(EARLIER):
                of_u, has_u = earlier[u, x], known[u, x]
                for y in range(EARLIER):
                    before |= (of_u == earlier[v, y]) & has_u & known[v, y]
            return ~before

        _, first, size = np.unique(cell, return_index=True, return_counts=True)
        pairs = [np.zeros((0, 2), np.int64)]
        for m in np.unique(size[size > 1]):
            x, y = np.triu_indices(m, 1)
            starts = first[size == m]
            step = max(1, SLAB // len(x))
            for part in (starts[k : k + step, None] for k in range(0, len(starts), step)):
                u, v = (part + x).ravel(), (part + y).ravel()
                ok = component[u] != component[v]
                u, v = u[ok], v[ok]
                need = percent * (n[u] + n[v]) / (100 + percent) - 1e-9
                ok = (np.minimum(n[u] - i[u], n[v] - i[v]) >= need) & (100 * np.minimum(n[u], n[v]) >= percent * np.maximum(n[u], n[v]))
                if has_rest:  # the set whose prefix ends first bounds what they share
                    r = rest[0]
                    ok &= (np.minimum(r[u], n[v] - i[v]) >= need) | (np.minimum(r[v], n[u] - i[u]) >= need)
                u, v = u[ok], v[ok]
                ok = first_met(u, v)
                u, v = id_[u[ok]], id_[v[ok]]
                pairs.append(np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0))
        found = np.unique(np.concatenate(pairs), axis=0)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    rows = cells.count()
    few = tasks_for(rows, BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64("cell", F.lit(9)), F.lit(1 + rows // BUCKET_ROWS)).alias("bucket")
    own = Window.partitionBy("id", "n").orderBy("i", "cell").rowsBetween(-EARLIER, -1)  # one n: of several texts of an id, like with like
    dealt = cells.select(bucket, "cell", "id", "n", "i", "component", *(["rest"] if has_rest else []), F.collect_list("cell").over(own).alias("earlier")).coalesce(few)
    return dealt.groupBy("bucket").applyInArrow(run, "a long, b long").coalesce(few).distinct().coalesce(few)


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(len(a), len(b)) sizes of the intersections of sorted sets; a slab of their union at a time."""
    union, code = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out, slab = np.zeros((len(a), len(b))), 1 << 14
    for lo in range(0, len(union), slab):
        i, j = np.searchsorted(code, [lo, lo + slab])
        has = np.zeros((len(a) + len(b), slab), np.float32)
        has[owner[i:j], code[i:j] - lo] = 1
        out += has[: len(a)] @ has[len(a) :].T  # exact: at most 2^14 ones in a slab
    return out


def degrees(classes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(n, k1, k2, linked): documents in other classes that a class is linked with; classes without any are absent.

    ``classes``: n, k1, k2, rep, members (documents), component (null if alone).
    """
    linked = classes.filter("component IS NOT NULL")
    sizes = linked.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    chunks = F.ceil(F.greatest(F.col("sets") / NODE, F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    dealt = linked.join(sizes, "component").withColumn("chunks", chunks)
    mine = F.pmod(F.xxhash64("k1", "k2", F.lit(5)), F.col("chunks")).cast("int").alias("mine")
    dealt = written(dealt.select("rep", "n", "k1", "k2", "members", "component", "chunks", mine), "dealt")
    sought = broadcast_if_small(dealt.select(F.col("rep").alias("id")).distinct(), MOVED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in slices(b, 1)):
            h, owner = shingle_sets(_texts(batch, 1), width)
            n = np.bincount(owner, minlength=batch.num_rows)
            k1, k2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            full, first = np.flatnonzero(n), np.concatenate([[0], np.cumsum(n)[:-1]])
            if len(full):
                k1[full] = np.add.reduceat(h, first[full])
                k2[full] = np.add.reduceat(h * (h | np.uint64(1)), first[full])
            ends = np.cumsum(n)
            blobs = [_blob(h[e - k : e]) for e, k in zip(ends.tolist(), n.tolist())]
            columns = [batch.column(0), pa.array(n.astype(np.int64)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "n", "k1", "k2", "set"])

    sets = rows.join(sought, "id", "left_semi").select("id", "text").mapInArrow(run, "rep long, n long, k1 long, k2 long, set binary")
    sent = sets.join(dealt, ["rep", "n", "k1", "k2"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    sent = sent.select("component", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "n", "k1", "k2", "members", "set")

    def count(table: pa.Table) -> pa.Table:
        key = list(zip(table["k1"].to_pylist(), table["k2"].to_pylist(), table["n"].to_pylist()))
        once = np.array(sorted({k: i for i, k in enumerate(key)}.values()))  # a row may repeat
        mine, n, members, k1, k2 = (table[c].to_numpy()[once] for c in ("mine", "n", "members", "k1", "k2"))
        held = [np.frombuffer(zstandard.decompress(table["set"][int(i)].as_py()), np.uint64) for i in once]
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        left, right = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
        found = np.zeros(len(once), np.int64)
        if len(left) and len(right):
            both = _overlaps([held[i] for i in left], [held[i] for i in right])
            near = 100 * both >= percent * (n[left][:, None] + n[right][None] - both)
            if lo == hi:
                np.fill_diagonal(near, False)
            found[left] += near @ members[right]
            if lo != hi:
                found[right] += near.T @ members[left]
        return pa.table({"n": n, "k1": k1, "k2": k2, "linked": found})

    counted = sent.groupBy("component", "lo", "hi").applyInArrow(count, "n long, k1 long, k2 long, linked long")
    return counted.groupBy("n", "k1", "k2").agg(F.sum("linked").alias("linked"))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    order_sample: int = ORDER_SAMPLE,
    count_links: bool = False,
) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``; ids are integers.

    Two documents are linked if 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest id reachable by links.
    ``count_links`` adds ``links``, the number of other documents that the row's
    text is linked with, copies among them; it compares all chunks of a
    component with one another, which components do not need.  Null, empty and wordless texts have size 0 and are
    linked with nothing; a null id takes no part and has a null component.
    Rows that share an id are one component by definition of the id.
    """
    rows = id_and_text(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), "text")
    order = sample_counts(rows, width, order_sample)
    table = written(points(rows, width, percent, order), "points")
    real = table.filter("n > 0 AND id IS NOT NULL")
    few = tasks_for(table.count())
    once = real.select("n", "k1", "k2", "id").distinct().coalesce(few)
    classes = written(once.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("members")), "classes", few)
    several = broadcast_if_small(classes.filter("members > 1").drop("members"), MOVED)
    copies = real.select("id", "n", "k1", "k2").join(several, ["n", "k1", "k2"]).filter("id <> rep").select("id").distinct().coalesce(few)
    reps = real.join(broadcast_if_small(copies, MOVED), "id", "left_anti").select("id", "n", "prefix")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    found = written(shared_cells(reps, tasks_for(shingles, PACKED_SHINGLES)), "cells")
    few = tasks_for(found.count())
    members = written(found.join(found.groupBy("cell").agg(F.count(F.lit(1)).alias("size")), "cell"), "members", few)

    point_of = real.select("id", "n", "point", "fine")

    def starred(cells: DataFrame, turn: int) -> DataFrame:
        """(a, b) of every member and its cell's hub, where they can be linked and are not yet."""
        place = F.struct((F.lit(0) if turn == 0 else F.xxhash64("id", F.lit(turn))).alias("o"), "id", "n", "i", "component")
        hubs = cells.groupBy("cell").agg(F.min(place).alias("hub"))
        near = _alike(F.col("n"), F.col("hub.n"), F.col("i"), F.col("hub.i"), percent)
        met = cells.join(hubs, "cell").filter((F.col("hub.component") != F.col("component")) & near)
        return met.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).coalesce(few)

    labelled = members.withColumn("component", F.col("id"))  # a row that repeats an id only repeats its pairs
    stars = [starred(labelled, 0)] + [starred(labelled.filter(F.col("size") > NODE), k) for k in range(1, HUBS)]
    links = verified(reduce(DataFrame.unionByName, stars), point_of, rows, width, percent, few)
    labels = broadcast_if_small(components(links), MOVED)
    now = labelled.drop("component").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_cells = now.groupBy("cell").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("cell").coalesce(few)
    labelled = now.join(broadcast_if_small(open_cells, MOVED), "cell", "left_semi")
    # what a set shares with another component is in its open cells (places alike count together) or behind its prefix
    here = F.count(F.lit(1)).over(Window.partitionBy("id", "n").orderBy(F.desc("i")))
    behind = F.ceil(F.col("n") * percent / F.lit(100.0) - 1e-9) - 1
    labelled = written(labelled.withColumn("rest", here + behind), "labelled", few)
    if not labelled.isEmpty():
        small, large = labelled.filter(F.col("size") <= NODE), labelled.filter(F.col("size") > NODE).drop("rest")
        held = points_of(large.select("id"), point_of.select("id", "n", "point"), few)
        pairs = cell_pairs(small, percent).unionByName(node_pairs(large.join(_sized(held.frame, held), ["id", "n"]), percent))
        links = links.unionByName(verified(pairs, point_of, rows, width, percent, few))
        labels = broadcast_if_small(components(links), MOVED)

    known = written(classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left"), "known")
    key, out = ["n", "k1", "k2"], ["rep", "component"]
    named = known
    if count_links:
        degree = degrees(known, rows, width, percent)
        named = known.join(degree, key, "left").withColumn("links", F.coalesce("linked", F.lit(0)) + F.col("members") - 1)
        out.append("links")
    # documents of their own need no look-up; where the others are many, wordless ones and groups of copies are dealt out
    named = SizedSide.of(named.filter("members > 1 OR component IS NOT NULL").select(*key, *out), MOVED)
    ids = table.select("id", *key)
    result = ids.join(F.broadcast(named.frame), key, "left") if named.small else skew_join(ids, named.frame, key)
    links = F.when(F.col("id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("links") if count_links else None
    return result.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"),
        *([links] if count_links else []),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component, that with its smallest id; all columns unchanged.

    Rows with a null id or no words are linked with nothing and stay.  Rows that
    repeat a (non-null) id are one component by that: one of them stays, the
    same on every run.  Columns may have any names.
    """
    named = jaccard_components(docs, id_col, text_col)
    gone = named.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    kept = _with_ids(docs, id_col, gone, "left_anti")
    repeated = kept.groupBy(qcol(id_col).alias("id")).agg(F.count(F.lit(1)).alias("rows")).filter("id IS NOT NULL AND rows > 1")
    repeated = written(repeated.select("id"), "repeated")
    if repeated.isEmpty():
        return kept
    again = _with_ids(kept, id_col, repeated, "left_semi")
    row = F.struct(*[qcol(c) for c in docs.columns])
    place = F.xxhash64(*[qcol(c) for c in docs.columns])
    one = again.groupBy(qcol(id_col).alias("key")).agg(F.min_by(row, place).alias("row"))
    one = one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    return _with_ids(kept, id_col, repeated, "left_anti").unionByName(one)


def _with_ids(docs: DataFrame, id_col: str, ids: DataFrame, how: str) -> DataFrame:
    """A semi or anti join of ``docs`` by the one column of ``ids``, broadcast if small, whatever the columns' names."""
    free = "id"
    while free in docs.columns:
        free += "_"
    return docs.join(broadcast_if_small(ids.toDF(free), MOVED), qcol(id_col) == F.col(free), how)
