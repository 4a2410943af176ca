"""Sets that meet in many cells: few rows for a pair, and no link lost by the bounds."""

import random

import pytest

from fundlens.llm import jaccard_join


def test_alike_sets_are_named_in_few_cells(spark, monkeypatch):
    rng = random.Random(7)
    lists = {i: sorted(rng.sample(range(150), 120)) for i in range(30)}  # any two share about 96 of 120 cells
    found = [(cell, i, 500, place, i) for i, cells in lists.items() for place, cell in enumerate(cells)]
    frame = spark.createDataFrame(found, "cell long, id long, n long, i long, component long")
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", 50)  # nearly a bucket for every cell
    want = {(a, b) for a in lists for b in lists if a < b}
    assert {tuple(r) for r in jaccard_join.cell_pairs(frame, 75).collect()} == want
    monkeypatch.setattr(type(frame), "distinct", lambda self: self)  # the rows that the tasks make
    made = jaccard_join.cell_pairs(frame, 75).count()
    assert len(want) <= made < 2 * len(want)  # 35 times as many without the earlier cells


def test_rest_bounds_pairs_that_share_too_little(spark):
    # two sets of 100: the prefix of 26 ends first for id 1, which has 3 open cells left: 3 + 74 < 86
    rows = [(5, 1, 100, 0, 1, 77), (5, 2, 100, 0, 2, 80), (6, 3, 100, 0, 3, 95), (6, 4, 100, 0, 4, 80)]
    frame = spark.createDataFrame(rows, "cell long, id long, n long, i long, component long, rest long")
    assert [tuple(r) for r in jaccard_join.cell_pairs(frame, 75).collect()] == [(3, 4)]
    assert {tuple(r) for r in jaccard_join.cell_pairs(frame.drop("rest"), 75).collect()} == {(1, 2), (3, 4)}


@pytest.mark.parametrize("node, earlier", [(64, 8), (4, 1)])
def test_components_of_alike_texts_equal_all_pairs(documents, monkeypatch, node, earlier):
    monkeypatch.setattr(jaccard_join, "NODE", node)
    monkeypatch.setattr(jaccard_join, "EARLIER", earlier)
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", 200)
    rng = random.Random(11)
    bases = [[f"w{rng.randrange(10**6)}" for _ in range(90)] for _ in range(4)]
    rows = []
    for i in range(120):
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):  # around the limit of 75
            t[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        t = t[rng.randrange(12) :] if rng.random() < 0.3 else t
        rows.append((i, " ".join(t), "en", "a"))
    rows += [(3, rows[50][1] + " and some more words", "en", "a"), (3, rows[3][1], "en", "a"), (200, None, "en", "a"), (201, "", "en", "a")]
    sets = [(i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))) for i, t, _, _ in rows if t for w in [t.split()]]
    root = {i: i for i, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (a, sa) in enumerate(sets):
        for b, sb in sets[:x]:
            if 100 * len(sa & sb) >= 75 * len(sa | sb):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    got = jaccard_join.jaccard_components(documents(rows)).collect()
    assert len(got) == len(rows) and len({find(i) for i in root}) > 20
    for r in got:
        assert r.component_id == find(r.doc_id), r
