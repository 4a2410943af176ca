"""Large Poisson means, letters, and the order of the quality columns."""

import hashlib
import math
from collections import Counter


from fundlens.llm import langid, mixing


def draw(seed, parts, mean):
    key = ":".join([str(seed), *map(str, parts)])
    u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
    p = cdf = math.exp(-mean)
    k = 0
    while u >= cdf and k < 96:
        k += 1
        p = p * mean / k
        cdf += p
    return k


def test_rates_above_one_draw_are_poisson(documents):
    rows = [(i, f"t{i}", "en", "rare" if i < 400 else "big") for i in range(600)]
    docs = documents(rows)
    rates = {r.source: r.rate for r in mixing.repetition_rates(docs, weights={"rare": 1.0, "big": 0.0}, epochs=66.7).collect()}
    assert rates["rare"] > 100 and rates["big"] == 0
    got = Counter(r.doc_id for r in mixing.mix_sources(docs, weights={"rare": 1.0, "big": 0.0}, epochs=66.7).collect())
    draws = math.ceil(rates["rare"] / 16)
    for i in range(400):
        mean = rates["rare"] / draws
        assert got[i] == draw(17, [i], mean) + sum(draw(17, [i, j], mean) for j in range(1, draws))
    mean = sum(got.values()) / 400
    variance = sum((got[i] - mean) ** 2 for i in range(400)) / 399
    assert abs(mean - rates["rare"]) < 3 and 0.75 < variance / rates["rare"] < 1.3


def test_only_letters_are_letters():
    assert all(langid.LETTER.search(t) for t in ("é", "x1", "你", "ß", "ª"))
    assert not any(langid.LETTER.search(t) for t in ("½", "²", "①", "Ⅷ", "1 2", "_", "\U0001f600", ""))


def test_extra_columns_follow(spark, documents):
    from fundlens.llm import quality

    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    docs = documents([(1, "good words " * 40, "en", "a"), (2, "bad", "en", "a")])
    columns = quality.assess(docs, quality.fit(docs, labels)).columns
    assert columns[-3:] == ["base_failed", "kept", "score"] and columns[0] == "doc_id"
