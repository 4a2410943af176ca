"""Approximate nearest neighbours by inner product: NN-descent graph and greedy search.

Equal vectors are one node.  The graph starts from small groups, dealt at
random and by a few random hyperplanes, and is a poor one; NN-descent makes it
good: in each round every node gathers its neighbours and reverse neighbours
with their vectors (joins on the graph), compares those that have not met and
proposes the better ones to both ends; each node keeps its best K.  Rounds go on
until few edges change.  A query starts at its own node and repeatedly expands
the best nodes of its pool that it has not expanded, over neighbours and
reverse neighbours, until all of the pool are expanded.  Vectors travel as signed
bytes with a scale; the final candidates are scored exactly on the originals in
double precision.  The index covers every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import written
from fundlens.operators.join import broadcast_if_small

NEIGHBOURS = 32
TREES, LEAF = 3, 128  # hyperplane trees beside the random groups, and the rows of a group
SETTLED = 0.05  # the descent ends with a round that changes at most this share of the edges
PROPOSALS = 3  # a node's best new partners within one neighbourhood
POOL, EXPAND = 160, 48


def _dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of rows with an id and a finite, non-zero vector of the table's usual length."""
    v = qcol(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(qcol(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND size(v) > 0")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull()) & finite & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    return rows.join(F.broadcast(usual.select("d")), F.size("v") == F.col("d"), "left_semi")  # one row


def _as_matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return values.reshape(len(column), -1)


def _unpack(blobs: pa.Array) -> np.ndarray:
    """Rows of (float32 scale, signed bytes) back to float32 vectors."""
    n = len(blobs)
    raw = np.frombuffer(b"".join(blobs.to_pylist()), np.uint8).reshape(n, -1)
    scale = np.ascontiguousarray(raw[:, :4]).view(np.float32)
    return raw[:, 4:].view(np.int8).astype(np.float32) * scale


def pack_nodes(nodes: DataFrame, trees: int, bits: int, seed: int) -> DataFrame:
    """(node, packed, leaves): the quantised vector and the sign pattern under each tree's hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _as_matrix(batch.column(1))
            if planes is None:
                planes = np.random.default_rng(seed).normal(size=(x.shape[1], trees * bits)).astype(np.float32)
            scale = (np.abs(x).max(1, keepdims=True) / 127).astype(np.float32)
            whole = np.concatenate([scale.view(np.uint8), np.rint(x / scale).astype(np.int8).view(np.uint8)], axis=1)
            signs = ((x @ planes) > 0).reshape(len(x), trees, bits).astype(np.int64)
            leaves = (signs << np.arange(bits)).sum(2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in whole], pa.binary()), pa.array(leaves.tolist(), pa.list_(pa.int64()))], names=["node", "packed", "leaves"]
            )

    return nodes.select("node", "v").mapInArrow(run, "node long, packed binary, leaves array<long>")


def _best(rows: DataFrame, by: str, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows per ``by`` (Spark limits each task's groups before the shuffle)."""
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).drop("place")


EDGES = "u long, v long, s float"


def _edges(u: list, v: list, s: list) -> pa.RecordBatch:
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return pa.RecordBatch.from_arrays([pa.array(cat(u, np.int64)), pa.array(cat(v, np.int64)), pa.array(cat(s, np.float32).astype(np.float32))], names=["u", "v", "s"])


def _top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best finite entries of every row."""
    k = min(k, scores.shape[1])
    cols = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(scores)), k)
    cols = cols.ravel()
    ok = np.isfinite(scores[rows, cols])
    return rows[ok], cols[ok]


def first_graph(packed: DataFrame, n: int, k: int, leaf: int) -> DataFrame:
    """(u, v, s, fresh): each node's best ``k`` within its groups of about ``leaf`` rows.

    One group is dealt at random out of all ``n`` nodes, so that the graph hangs
    together; the others are the leaves of the trees, large ones dealt into parts.
    A group names half of ``k`` per node, the random one all.
    """
    dealt = lambda of: F.pmod(F.xxhash64("node", "tree"), F.ceil(of / leaf))
    anywhere = packed.select("node", "packed", F.lit(-1).alias("tree"), F.lit(0).cast("long").alias("leaf")).withColumn("part", dealt(F.lit(max(1, n))))
    placed = packed.select("node", "packed", F.posexplode("leaves").alias("tree", "leaf"))
    large = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf)
    parts = placed.join(broadcast_if_small(large), ["tree", "leaf"], "left").withColumn("part", F.coalesce(dealt(F.col("n")), F.lit(0).cast("long")))

    def run(table: pa.Table) -> pa.Table:
        ids, x = table["node"].to_numpy(), _unpack(table["packed"].combine_chunks())
        us, vs, ss = [], [], []
        for lo in range(0, len(ids), 512):
            s = x[lo : lo + 512] @ x.T
            s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
            r, c = _top(s, k if table["tree"][0].as_py() < 0 else max(1, k // 2))
            us.append(ids[lo + r])
            vs.append(ids[c])
            ss.append(s[r, c])
        return pa.Table.from_batches([_edges(us, vs, ss)])

    found = anywhere.unionByName(parts.drop("n")).groupBy("tree", "leaf", "part").applyInArrow(run, EDGES)
    one = found.groupBy("u", "v").agg(F.max("s").alias("s"))
    return _best(one, "u", k, F.desc("s"), F.col("v")).withColumn("fresh", F.lit(True))


def neighbourhoods(graph: DataFrame, k: int) -> DataFrame:
    """(at, other, fresh): neighbours of each node and at most ``k`` reverse neighbours, new ones first."""
    back = _best(graph.select(F.col("v").alias("at"), F.col("u").alias("other"), "fresh", "s"), "at", k, F.desc("fresh"), F.desc("s"), F.col("other"))
    there = graph.select(F.col("u").alias("at"), F.col("v").alias("other"), "fresh")
    return there.unionByName(back.select("at", "other", "fresh")).groupBy("at", "other").agg(F.max("fresh").alias("fresh"))


def descend(graph: DataFrame, packed: DataFrame, k: int) -> DataFrame:
    """One round of NN-descent on (u, v, s, fresh)."""
    worst = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) >= k, F.min("s")).otherwise(F.lit(float("-inf")).cast("float")).alias("least"))
    nodes = broadcast_if_small(packed.select("node", "packed").join(worst.withColumnRenamed("u", "node"), "node", "left"))
    sent = neighbourhoods(graph, k).join(nodes.withColumnRenamed("node", "other"), "other")
    gathered = sent.groupBy("at").agg(F.collect_list(F.struct("other", "fresh", "packed", "least")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs, ss = [], [], []
            column = batch.column(0)
            for r in range(batch.num_rows):
                part = column.slice(r, 1).flatten()
                new = part.field("fresh").to_numpy(zero_copy_only=False)
                if len(part) < 2 or not new.any():
                    continue
                ids, least = part.field("other").to_numpy(), part.field("least").fill_null(-np.inf).to_numpy()
                x = _unpack(part.field("packed"))
                s = x @ x.T
                s[~(new[:, None] | new[None])] = -np.inf
                s[s <= least[:, None]] = -np.inf
                np.fill_diagonal(s, -np.inf)
                i, j = _top(s, PROPOSALS)
                us.append(ids[i])
                vs.append(ids[j])
                ss.append(s[i, j])
            yield _edges(us, vs, ss)

    proposed = gathered.select("rows").mapInArrow(run, EDGES)
    both = graph.select("u", "v", "s", F.lit(False).alias("fresh")).unionByName(proposed.withColumn("fresh", F.lit(True)))
    merged = both.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    return _best(merged, "u", k, F.desc("s"), F.col("v"))


def build_graph(packed: DataFrame, n: int, k: int, leaf: int, rounds: int | None) -> DataFrame:
    """The graph of ``n`` nodes after ``rounds`` rounds; without a number, after the round that settles it."""
    graph, done = written(first_graph(packed, n, k, leaf), "graph0"), 0
    while done != rounds:
        done += 1
        graph = written(descend(graph, packed, k), f"graph{done}")
        changed, edges = graph.agg(F.count_if("fresh"), F.count(F.lit(1))).first()
        if rounds is None and changed <= SETTLED * edges:
            break
    return graph


def _scored(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """(q, node, s): inner products of the quantised vectors of node pairs.

    ``packed`` may carry a broadcast hint (a checked size); else its joins shuffle.
    """
    asked = packed.select(F.col("node").alias("q"), F.col("packed").alias("pq"))
    found = packed.select("node", F.col("packed").alias("pn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.einsum("ij,ij->i", _unpack(batch.column(2)), _unpack(batch.column(3)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s.astype(np.float32))], names=["q", "node", "s"])

    return pairs.join(found, "node").join(asked, "q").select("q", "node", "pq", "pn").mapInArrow(run, "q long, node long, s float")


def greedy_search(graph: DataFrame, packed: DataFrame, starts: DataFrame, k: int, pool: int, expand: int) -> DataFrame:
    """(q, node): the pool of every start node ``q`` once all its nodes are expanded, the best ``expand`` at a time.

    An expanded node that the pool loses stays out: its place went to better ones,
    so the worst of the pool only rises and the search ends.
    """
    around = written(neighbourhoods(graph, k).select(F.col("at").alias("node"), F.col("other").alias("next")), "around")
    packed = broadcast_if_small(packed.select("node", "packed"))
    own = starts.select(F.col("node").alias("q"), "node")
    state = _scored(own, packed).withColumn("done", F.lit(False))
    hop, open_ = 0, True
    while open_:
        front = _best(state.filter("NOT done"), "q", expand, F.desc("s"), F.col("node")).select("q", "node")
        reached = front.join(around, "node").select("q", F.col("next").alias("node")).distinct()
        new = _scored(reached, packed).withColumn("done", F.lit(False))
        expanded = state.join(front.withColumn("hit", F.lit(True)), ["q", "node"], "left").select("q", "node", "s", (F.col("done") | F.col("hit").isNotNull()).alias("done"))
        merged = expanded.unionByName(new).groupBy("q", "node").agg(F.max("s").alias("s"), F.max("done").alias("done"))
        # the start itself stays in the pool for the copies of its vector
        state = written(_best(merged, "q", pool + 1, (F.col("q") == F.col("node")).desc(), F.desc("s"), F.col("node")), f"pool{hop}")
        hop, open_ = hop + 1, not state.filter("NOT done").isEmpty()
    return state.select("q", "node")


def nearest(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    neighbours: int = NEIGHBOURS,
    rounds: int | None = None,
    pool: int = POOL,
    expand: int = EXPAND,
    leaf: int = LEAF,
    trees: int = TREES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row that satisfies ``queries`` (over vec_id).

    Nearness is the largest inner product, exact in double precision for what
    is returned; ties go to the smaller id; a row is never its own neighbour,
    its copies are.  ``rounds`` sets the number of rounds of the descent; without it they go
    on until the graph settles.  Every table takes the same path, whatever its size.  Null ids and null, empty, zero or non-finite vectors, and
    vectors of another length than the usual one, take no part.  Rows that
    repeat an id with one vector are one row.
    """
    rows = usable(vectors, id_col, vector_col).select("vec_id", "v", F.xxhash64("v", F.lit(1)).alias("k1"), F.xxhash64("v", F.lit(2)).alias("k2"))
    classes = rows.groupBy("k1", "k2").agg(F.min("vec_id").alias("node"))
    member = written(rows.join(classes, ["k1", "k2"]).select("vec_id", "node", "v"), "members")
    nodes = member.filter("vec_id = node").dropDuplicates(["node"])
    n = nodes.count()
    bits = max(1, math.ceil(math.log2(max(1, n) / leaf)))
    packed = written(pack_nodes(nodes, trees, bits, 11), "packed")
    graph = build_graph(packed, n, neighbours, leaf, rounds)
    asked = member.filter(queries).select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")).distinct()
    found = greedy_search(graph, packed, asked.select(F.col("q").alias("node")).distinct(), neighbours, max(pool, k), expand)

    vector = nodes.select("node", "v")
    exact = found.join(vector.select(F.col("node").alias("q"), F.col("v").alias("a")), "q").join(vector.select("node", F.col("v").alias("b")), "node")
    scored = exact.select("q", "node", _dot(F.col("a"), F.col("b")).alias("score"))
    first_copies = _best(member.select("vec_id", "node").distinct(), "node", k + 1, F.col("vec_id"))
    per_query = asked.join(_best(scored, "q", k + 1, F.desc("score"), F.col("node")), "q").join(first_copies, "node").filter("query_id <> vec_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = per_query.withColumn("rank", F.row_number().over(rank).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
