"""Repeated 3-word windows: counts against brute force, cut hashes that collide, hashing and sorting once."""

import random
from collections import Counter

from pyspark.sql import functions as F

from fundlens.llm import quality


def covered(windows):
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)})


def test_repeat_words_equal_brute_force(documents):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij"[:v]) for _ in range(n)) for n in (1, 2, 3, 4, 5, 31, 64, 257, 2000) for v in (1, 2, 4, 10)]
    texts += [" ".join(f"w{i}" for i in range(500)), "p q r s p q r " + " ".join(f"w{i}" for i in range(300)) + " p q r s"]
    model = quality.QualityModel((0.0,) * 16, 0.0)
    got = {r.doc_id: r for r in quality.assess(documents([(i, t, "en", "a") for i, t in enumerate(texts)]), model).collect()}
    for i, text in enumerate(texts):
        w = text.split()
        assert got[i].n_repeat_words == covered(list(zip(w, w[1:], w[2:], strict=False))), text[:80]
        assert got[i].n_words == len(w)


def test_repeat_words_where_cut_hashes_collide(spark):
    """Hashes that differ in the high bits only: the positions take the place of those bits."""
    high = [k << 58 for k in range(-32, 32)]
    rng = random.Random(9)
    rows = [[rng.choice(high[:v]) + rng.choice((0, 1)) for _ in range(n)] for n in (2, 3, 7, 40, 300) for v in (2, 5, 64)]
    rows += [[], [7], [7, 7 + (1 << 62)], [7, 7 + (1 << 62), 7], list(high), [high[0], *range(1, 40), high[1], high[0]]]
    frame = spark.createDataFrame(list(enumerate(rows)), "k int, windows array<long>")
    got = {r.k: r.n_repeat_words for r in quality.with_repeat_words(frame).collect()}
    assert got == {k: covered(w) for k, w in enumerate(rows)}


def test_assess_hashes_words_pairs_and_windows_once(documents):
    model = quality.QualityModel((0.0,) * 16, 0.0)
    frame = quality.assess(documents([(1, "a b c a b c", "en", "a")]), model)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 3, plan
    # the longs are sorted in a projection, not inside a lambda or as its argument, where they would be boxed
    assert "sort_array(transform(CASE WHEN" in plan and "filter(sort_array(" not in plan
    assert frame.select(F.max("n_repeat_words")).first()[0] == 6
