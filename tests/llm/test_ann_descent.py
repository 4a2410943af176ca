"""The descent, not the starting groups, makes the neighbour graph of op6 good."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fundlens.llm import nn_descent


def test_the_descent_finds_what_the_starting_groups_miss(spark):
    n = 1500
    x = np.random.default_rng(3).normal(size=(n, 24)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    y, recall = x.astype(float), {}
    for rounds in (0, None):
        hits = 0
        found = nn_descent.nearest(df, F.col("vec_id") % 50 == 0, rounds=rounds, leaf=32, trees=1, pool=20, expand=20).collect()
        for q in range(0, n, 50):
            s = y @ y[q]
            s[q] = -np.inf
            hits += len(set(np.lexsort((np.arange(n), -s))[:20].tolist()) & {r.vec_id for r in found if r.query_id == q})
        assert len(found) == n // 50 * 20
        recall[rounds] = hits / len(found)
    assert recall[None] >= 0.9 and recall[None] - recall[0] >= 0.1


def test_a_graph_of_fewer_nodes_than_neighbours_is_whole(spark):
    rows = [(i, [float(i + 1), float(i % 3), 1.0]) for i in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = nn_descent.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    best = sorted(rows[1:], key=lambda r: (-sum(a * b for a, b in zip(r[1], rows[0][1])), r[0]))
    assert [r.vec_id for r in found] == [i for i, _ in best]
