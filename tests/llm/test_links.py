"""The number of links of every document, against all pairs."""

import random

from fundlens.llm import jaccard_join


def shingles(text):
    w = text.split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def test_links_count_every_linked_document(documents, monkeypatch):
    rng = random.Random(4)
    base = [f"word{rng.randrange(10**6)}" for _ in range(60)]
    texts = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(60)] = f"other{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    texts += texts[:12] + [" ".join(f"alone{i}" for i in range(20))] * 9 + ["one of its own that nothing is near to"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    sets = [shingles(t) for t in texts]
    want = {}
    for i, a in enumerate(sets):
        want[i] = sum(j != i and 100 * len(a & b) >= 75 * len(a | b) for j, b in enumerate(sets))
    rows += [(0, texts[0], "en", "a"), (None, texts[0], "en", "a"), (900, None, "en", "a"), (901, "", "en", "a")]
    monkeypatch.setattr(jaccard_join, "NODE", 8)
    got = jaccard_join.jaccard_components(documents(rows), count_links=True).collect()
    assert len(got) == len(rows) and max(want.values()) > 20
    for r in got:
        assert r.links == want.get(r.doc_id, 0), (r, want.get(r.doc_id))
