"""Pairs of small cells: each once, exactly those that sizes and places let through."""

import random

import pytest

from fundlens.llm import jaccard_join


@pytest.mark.parametrize("rows, slab", [(50_000, 1 << 20), (40, 3)])
def test_cell_pairs_equal_all_pairs(spark, monkeypatch, rows, slab):
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", rows)
    monkeypatch.setattr(jaccard_join, "SLAB", slab)
    rng = random.Random(4)
    size = {i: rng.randrange(4, 60) for i in range(120)}
    component = {i: rng.choice([i, i // 3]) for i in size}
    cells = {c: {i: rng.randrange(size[i] // 4 + 1) for i in rng.sample(sorted(size), rng.choice([1, 2, 2, 5, 30]))} for c in range(90)}
    found = [(c, i, size[i], place, component[i]) for c, ids in cells.items() for i, place in ids.items()]
    found += found[:20]  # rows that repeat an id repeat its places
    frame = spark.createDataFrame(found, "cell long, id long, n long, i long, component long")
    want = set()
    for ids in cells.values():
        for a, ia in ids.items():
            for b, ib in ids.items():
                na, nb = size[a], size[b]
                fits = 100 * min(na, nb) >= 75 * max(na, nb) and 175 * min(na - ia, nb - ib) >= 75 * (na + nb)
                if a < b and component[a] != component[b] and fits:
                    want.add((a, b))
    got = [tuple(r) for r in jaccard_join.cell_pairs(frame, 75).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    assert jaccard_join.cell_pairs(frame.limit(0), 75).count() == 0
