"""The quality model is fitted from every labelled document."""

import random
from math import log

from pyspark.sql import functions as F

from fundlens.llm import quality


def test_weights_count_every_trusted_document(spark):
    good = 20_500
    docs = spark.range(good + 300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < good, "fine").otherwise("poor").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") < good).cast("int").alias("quality"))
    model = quality.fit(docs, labels, buckets=64)
    slot = spark.range(1).select(F.pmod(F.xxhash64(F.lit("fine")), F.lit(64))).first()[0]
    assert model.weights[slot] == round(log((good + 1) / (good + 64)) - log((good + 1) / (good + 300 + 64)), 9)


def brute_cut(rows):
    rows = [r for r in rows if r[1] is not None]
    good, bad = sum(g for g, _ in rows), sum(1 - g for g, _ in rows)
    scores = sorted({s for _, s in rows})
    best = max(
        (sum(g for g, s in rows if s >= cut) / good - sum(1 - g for g, s in rows if s >= cut) / bad, -i) for i, cut in enumerate(scores)
    )
    i = -best[1]
    return scores[i] if i == 0 else (scores[i] + scores[i - 1]) / 2


def test_best_cut_equals_brute_force_over_many_ranges(spark):
    rng = random.Random(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n, shift in ((40, 0.2), (300, 0.5), (300, 0.0), (3, 9.0)):
            rows = [(g, round(rng.gauss(shift * g, 1.0), 1)) for g in (rng.randrange(2) for _ in range(n))] + [(0, -9.5), (1, 9.5), (1, None)]
            scored = spark.createDataFrame(rows, "good int, score double").repartition(3)
            assert quality.best_cut(scored) == brute_cut(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    one_class = spark.createDataFrame([(1, 0.5), (1, 0.7)], "good int, score double")
    assert quality.best_cut(one_class) == quality.best_cut(one_class.limit(0)) == float("-inf")


def test_threshold_sees_every_labelled_document(spark):
    """The last 200 of 4,200 good documents in hash order score lower than the others: the cut lies below them."""
    n, odd, bad = 4_200, 200, 200
    ids = [r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]
    texts = [(i, "plain words", 1) for i in ids[:-odd]] + [(i, "rare bad", 1) for i in ids[-odd:]] + [(n + i, f"bad {i % 7}", 0) for i in range(bad)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, quality int").coalesce(2)
    docs, labels = rows.select("doc_id", "text"), rows.select("doc_id", "quality")
    model = quality.fit(docs, labels, buckets=512)
    score = {r.text: r.score for r in quality.assess(docs, model).join(docs, "doc_id").select("text", "score").distinct().collect()}
    worst = max(s for t, s in score.items() if t.startswith("bad"))
    assert worst < score["rare bad"] < score["plain words"]
    assert model.threshold == (score["rare bad"] + worst) / 2
