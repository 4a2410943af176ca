"""Mixing sources to target weights by Poisson replication.

Each document is repeated k times, k drawn from a Poisson distribution whose
mean is the repetition rate its source needs to reach its target share.  The
draw is the inverse distribution function at a uniform number hashed from the
seed and the document's id, so a rerun or a lost executor gives the same copies.
The copies are dealt over the cluster by a hash of (seed, id, copy) and sorted
by it within partitions: a global shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol
from fundlens.operators.join import broadcast_if_small

# A larger mean is drawn as the sum of independent draws of equal means up to this, which is Poisson again.
MAX_MEAN = 16.0
# Inverse steps of one draw: P(k >= 96) for mean 16 is below the 2^-52 grid of the uniform number.
MAX_DRAW = 96


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) on a grid of 2^-52 from the md5 of the seed and the parts."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def poisson_inverse(u: Column, mean: Column) -> Column:
    """Smallest k with P(X <= k) > u for X ~ Poisson(mean), means up to MAX_MEAN."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        more = u >= s["cdf"]
        return F.when(more, F.struct(p.alias("p"), (s["cdf"] + p).alias("cdf"), i.alias("k"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(MAX_DRAW)), start, step)["k"]


def poisson_copies(seed: int, id_: Column, mean: Column) -> Column:
    """A Poisson number with this mean, fixed by the seed and the id: one draw, or the sum of equal ones of a large mean.

    The first draw is hashed from (seed, id), further ones from (seed, id, their number).
    """
    draws = F.greatest(F.ceil(mean / MAX_MEAN), F.lit(1))
    one = poisson_inverse(uniform(seed, id_), mean / draws).cast("long")
    more = F.transform(F.sequence(F.lit(1).cast("long"), draws - 1), lambda j: poisson_inverse(uniform(seed, id_, j), mean / draws))
    total = F.aggregate(more, one, lambda s, k: s + k.cast("long"))
    return F.when(draws > 1, total).otherwise(one)


def repetition_rates(
    docs: DataFrame,
    source_col: str = "source",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 1.0,
    epochs: float = 1.0,
) -> DataFrame:
    """(source, n, rate): copies of each document that bring its source to its target share.

    Target shares are ``weights`` (per source, normalised; absent sources get 0) or,
    by default, proportional to n^temperature (1: as they are, 0: all alike).
    rate = share * epochs * all documents / n.  A null source is a source of its own.
    """
    counts = docs.groupBy(qcol(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        target = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        if any(not math.isfinite(w) or w < 0 for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        target = F.lit(0.0)
        for name, w in weights.items():
            same = F.col("source").isNull() if name is None else F.col("source") == F.lit(name)
            target = F.when(same, F.lit(float(w))).otherwise(target)
    counts = counts.withColumn("target", target)
    totals = counts.agg(F.sum("n").alias("all_n"), F.sum("target").alias("all_target"))
    share = F.when(F.col("all_target") > 0, F.col("target") / F.col("all_target")).otherwise(F.lit(0.0))
    # totals has exactly one row
    return counts.join(F.broadcast(totals)).select("source", "n", (share * epochs * F.col("all_n") / F.col("n")).alias("rate"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 1.0,
    epochs: float = 1.0,
    seed: int = 17,
    copy_col: str | None = None,
) -> DataFrame:
    """The documents, each repeated by its Poisson draw, globally shuffled.

    The columns are those of ``docs`` (plus ``copy_col``, 0-based, if named).
    Rows with equal ids draw alike, null ids draw as the text "null"; an empty
    table stays empty.  A document may draw 0 copies: that is the sampling.
    """
    rates = broadcast_if_small(repetition_rates(docs, source_col, weights, temperature, epochs).drop("n"))
    rows = docs.select(F.struct(*[qcol(c) for c in docs.columns]).alias("row"), qcol(id_col).alias("id"), qcol(source_col).alias("s"))
    drawn = rows.join(rates, rows["s"].eqNullSafe(rates["source"]), "inner").select(
        "row", "id", poisson_copies(seed, F.col("id"), F.col("rate")).alias("k")
    )
    copies = drawn.filter("k > 0").select("row", "id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("copy"))
    keyed = copies.select("row", "copy", F.xxhash64(F.lit(seed), F.col("id"), F.col("copy")).alias("place"))
    shuffled = keyed.repartition(F.col("place")).sortWithinPartitions("place", "copy")
    extra = [F.col("copy").alias(copy_col)] if copy_col else []
    return shuffled.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], *extra)
