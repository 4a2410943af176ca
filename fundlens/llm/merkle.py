"""A Merkle manifest of a table: leaf digests, a tree per group, a tree over the groups.

Leaves are numbered per group in key order by a range sort and per-partition
offsets, so that no group, however large, meets in one task.  Runs of nodes are
then hashed level by level with lag/lead windows over aligned blocks of
positions: every row of a block stays, the row of a node's first leaf holds its
digest, siblings are the rows a fixed offset before or after (masked by the
node's slot and the length of its run), and first-child rows hash the parent.
All levels of a block share one shuffle; block tops are the nodes of the next
round, so a table of n rows takes about log(n) / log(BLOCK) rounds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.llm.common import written
from fundlens.operators.join import broadcast_if_small

# The columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Nodes of a block at most: a power of the fan-out up to this.
BLOCK = 1024

PATH_TYPE = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value as text."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Mapping[str, Column] | Sequence[str] = LEAF_COLUMNS) -> Column:
    """The leaf digest of a row; a mapping puts other values in place of named columns."""
    values = columns.values() if isinstance(columns, Mapping) else [qcol(c) for c in columns]
    return digest(*[field(c) for c in values])


def fold(start: Column, path: Column) -> Column:
    """The root recomputed from a leaf and its path of siblings."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (0-based place by ``order`` within ``keys``, nulls first) and ``total`` (rows of the key).

    A range sort by (keys, order) is written with each row's place in its
    partition; the small table of runs (one row per key and partition) gives
    the offsets.  Rows equal in all of ``order`` take some order.
    """
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    stored = written(placed, "merkle-sorted").withColumn("part", F.shiftright("at", 33))
    runs = stored.groupBy(*keys, "part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    # the runs are as many as partitions and keys together, not as rows
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *keys,
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_at")).alias("shift"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )
    joined = stored.join(broadcast_if_small(runs), [*keys, "part"])
    return joined.select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "total")


def levels_of_block(fanout: int, block: int = BLOCK) -> int:
    """Levels hashed in one round: the most whose block has at most ``block`` rows."""
    return max(1, int(math.log(block, fanout) + 1e-9))


def climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (key, pos, total, node, ...) with ``block``, ``path`` through ``levels`` levels and the block's ``top``.

    ``top`` stands on the first row of each block only.  A key's levels end
    where one node is left, so its path has no entries beyond them.
    """
    pos, total = F.col("pos"), F.col("total")
    rows = nodes.withColumn("block", F.expr(f"pos div {fanout**levels}")).withColumn("d0", F.col("node"))
    w = Window.partitionBy("key", "block").orderBy("pos")
    for j in range(levels):
        step = fanout**j
        slot = F.expr(f"(pos div {step}) % {fanout}")
        here = pos % step == 0
        lags = {f"lag{i}": F.lag(f"d{j}", i * step).over(w) for i in range(1, fanout)}
        leads = {f"lead{i}": F.lead(f"d{j}", i * step).over(w) for i in range(1, fanout)}
        rows = rows.withColumns({**lags, **leads})
        left = [F.when(slot >= i, F.col(f"lag{i}")).otherwise("") for i in range(fanout - 1, 0, -1)]
        right = [F.when(slot + i < fanout, F.coalesce(f"lead{i}", F.lit(""))).otherwise("") for i in range(1, fanout)]
        rows = rows.withColumns({f"left{j}": F.when(here, F.concat(*left)), f"right{j}": F.when(here, F.concat(*right))})
        parent = F.when(total > step, digest(F.col(f"d{j}"), F.col(f"right{j}"))).otherwise(F.col(f"d{j}"))
        rows = rows.withColumn(f"d{j + 1}", F.when(pos % (step * fanout) == 0, parent)).drop(*lags, *leads)
        if j:
            rows = rows.drop(f"d{j}")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = {n: F.last(n, ignorenulls=True).over(so_far) for j in range(1, levels) for n in (f"left{j}", f"right{j}")}
    rows = rows.withColumns(spread)
    entry = [F.when(total > fanout**j, F.struct(F.col(f"left{j}").alias("left"), F.col(f"right{j}").alias("right"))) for j in range(levels)]
    return rows.select(*nodes.columns, "block", F.array_compact(F.array(*entry)).cast(PATH_TYPE).alias("path"), F.col(f"d{levels}").alias("top"))


def tree(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(key, pos, path, top) of every node (key, pos, total, node): its path to, and the digest of, its key's last node."""
    most = nodes.agg(F.max("total")).first()[0] or 1
    if most == 1:
        return nodes.select("key", "pos", F.array().cast(PATH_TYPE).alias("path"), F.col("node").alias("top"))
    climbed = climb(nodes.select("key", "pos", "total", "node"), fanout, levels)
    above = tree(tops(climbed, fanout, levels), fanout, levels)
    above = above.select("key", F.col("pos").alias("block"), F.col("path").alias("further"), F.col("top").alias("last"))
    joined = climbed.drop("top").join(broadcast_if_small(above), ["key", "block"])
    return joined.select("key", "pos", F.concat("path", "further").alias("path"), F.col("last").alias("top"))


def tops(climbed: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The block tops of :func:`climb`, written, as the nodes of the next round."""
    size = fanout**levels
    first = climbed.filter(f"pos % {size} = 0")
    return written(
        first.select("key", F.col("block").alias("pos"), F.ceil(F.col("total") / size).alias("total"), F.col("top").alias("node")),
        "merkle-tops",
    )


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: Sequence[str] = LEAF_COLUMNS,
    fanout: int = 2,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(id, leaf, ``carry``..., subroot, root, path) of every row of ``docs``.

    A leaf digests ``columns``.  Per ``group_col`` the leaves ascend by id;
    while several nodes remain every ``fanout`` consecutive ones become their
    digest (the last run may be shorter, even one); what remains is the group's
    subroot (of a lone leaf, the leaf).  The subroots in order of the groups
    (null first, UTF-8 bytewise) give the root in the same way.  ``path`` holds
    per level the digests left and right of the node in its run, up to the root.
    ``carry`` names further expressions over ``docs`` to keep beside the leaf.

    Null ids come first, rows with equal ids follow their leaf digests (wholly
    equal rows take equal places either way), null values hash as ``-`` and
    differ from empty text.  An empty table gives an empty result.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    carry = dict(carry or {})
    levels = levels_of_block(fanout)
    group = qcol(group_col).cast("string")
    # a key that is never null: null sorts first, other groups by their UTF-8 bytes
    key = F.coalesce(F.concat(F.lit("="), group), F.lit(""))
    rows = docs.select(
        qcol(id_col).alias("id"), key.alias("key"), leaf(columns).alias("node"), *[c.alias(f"c_{n}") for n, c in carry.items()]
    )
    climbed = climb(numbered(rows, ["key"], ["id", "node"]), fanout, levels)
    # tops per block, then per group, then over the groups; each is far smaller than the one before
    blocks = written(tree(tops(climbed, fanout, levels), fanout, levels), "merkle-blocks")
    groups = blocks.filter("pos = 0").select("key", F.col("top").alias("node"))
    ranked = numbered(groups.withColumn("all", F.lit("")), ["all"], ["key"])
    above = tree(ranked.select(F.col("all").alias("key"), "pos", "total", "node"), fanout, levels)
    above = above.select("pos", F.col("path").alias("over"), F.col("top").alias("root"))
    above = ranked.select("pos", "key").join(broadcast_if_small(above), "pos").drop("pos")
    over = blocks.join(broadcast_if_small(above), "key").select(
        "key", F.col("pos").alias("block"), F.concat("path", "over").alias("further"), F.col("top").alias("subroot"), "root"
    )
    # the leaves already lie by (key, block): where `over` is too large to broadcast, only it is shuffled
    joined = climbed.drop("top").join(broadcast_if_small(over), ["key", "block"])
    return joined.select(
        F.col("id").alias(id_col),
        F.col("node").alias("leaf"),
        *[F.col(f"c_{n}").alias(n) for n in carry],
        "subroot",
        "root",
        F.concat("path", "further").alias("path"),
    )
