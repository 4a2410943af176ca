"""Fine points, stars of pairs, and the one row that stays of a group."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import jaccard_join
from fundlens.llm.shingles import mix


def sets_of(rng, n, shared):
    common = mix(np.array([rng.getrandbits(63) for _ in range(shared)], np.uint64))
    return [np.unique(np.concatenate([common, mix(np.array([rng.getrandbits(63) for _ in range(n - shared)], np.uint64))])) for _ in range(2)]


@pytest.mark.parametrize("n", [1, 30, 400, 5000])
def test_fine_points_bound_the_overlap_and_prune_strangers(n):
    rng = random.Random(n)
    for shared in (0, n // 2, n):
        for other in (n, max(1, int(n * 0.8))):
            a, b = sets_of(rng, n, min(shared, other))
            b = b[:other]
            bound = jaccard_join.overlap_bound(jaccard_join.fine_point(a), jaccard_join.fine_point(b))
            assert bound >= len(np.intersect1d(a, b)) and bound <= min(len(a), len(b))
            assert bound == jaccard_join.overlap_bound(jaccard_join.fine_point(b), jaccard_join.fine_point(a))
            if not shared and n >= 400:
                assert bound < 2 * 75 * n / 175  # unrelated sets cannot be linked by it
    heavy = np.arange(300, dtype=np.uint64)  # all in one group: counts beyond a byte
    assert jaccard_join.overlap_bound(jaccard_join.fine_point(heavy), jaccard_join.fine_point(heavy[:290])) == 290


@pytest.mark.parametrize("node,chunk", [(64, 1 << 20), (3, 100)])
def test_verified_equals_all_pairs(documents, monkeypatch, node, chunk):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(40):
        t = list(base) if i % 4 else [f"w{rng.randrange(10**6)}" for _ in range(80)]
        for _ in range(rng.randrange(8)):
            t[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(t), None, None))
    docs = documents(rows).select(F.col("doc_id").alias("id"), "text")
    order = jaccard_join.sample_counts(docs, 5, 100)
    table = jaccard_join.points(docs, 5, 75, order)
    pairs = docs.select(F.col("id").alias("a")).join(docs.select(F.col("id").alias("b")), F.col("a") < F.col("b"))
    monkeypatch.setattr(jaccard_join, "NODE", node)
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES", chunk)
    got = Counter(map(tuple, jaccard_join.verified(pairs, table.select("id", "n", "point", "fine"), docs, 5, 75).collect()))
    shingles = {i: {tuple(t.split()[j : j + 5]) for j in range(76)} for i, t, _, _ in rows}
    want = {(i, j) for i in shingles for j in shingles if i < j and 100 * len(shingles[i] & shingles[j]) >= 75 * len(shingles[i] | shingles[j])}
    assert got == Counter(want) and len(want) > 20


def test_keep_one_of_every_group(documents):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [
        (5, text, "en", "a"),
        (3, text + " more", "en", "b"),
        (3, text + " more", "en", "b"),
        (9, "alone with these few words here", "de", "a"),
        (9, "alone with these few words here", "de", "a"),
        (9, "alone with these few words here", "fr", "a"),
        (7, None, "en", "a"),
        (7, None, "en", "a"),
        (8, "", "en", "a"),
        (None, text, "en", "a"),
        (None, text, "en", "a"),
    ]
    docs = documents(rows).withColumn("__gone", F.lit(1)).withColumn("id_", F.lit(2)).withColumn("key", F.lit(3)).withColumn("row", F.lit(4))
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    found = Counter(r.doc_id for r in kept.collect())
    assert found == {3: 1, 9: 1, 7: 1, 8: 1, None: 2}
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0
    assert {r.doc_id for r in jaccard_join.keep_one(docs.filter("doc_id IN (5, 8)")).collect()} == {5, 8}
