"""Words over 1,024 bytes: the hash of a word depends on the word alone, not on the texts hashed with it."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import jaccard_join, lm_ppm
from fundlens.llm.shingles import word_hashes

WORDS = ("the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions " * 3).split()
PROSE = " ".join(WORDS)
LONG = "".join(f"{i * 7919 % 1000003:x}" for i in range(500))[:2000]
FILLER = " ".join(f"f{i}" for i in range(180_000))  # more than a slice of a megabyte


def test_word_hash_does_not_depend_on_its_neighbours():
    texts = [PROSE.encode(), LONG.encode(), (LONG + "x").encode(), LONG[:1024].encode(), (LONG[:1024] + "x").encode(), LONG[:1025].encode()]
    together, owner = word_hashes(texts)
    for i, text in enumerate(texts):
        alone, _ = word_hashes([text])
        assert np.array_equal(together[owner == i], alone)
    assert len(set(together.tolist())) == len(set(WORDS)) + 5
    late = [("a" * n + "b" + "a" * (3000 - n)).encode() for n in (5, 1029, 2053)]  # alike but for the block of the b
    assert len(set(word_hashes(late)[0].tolist())) == 3


def test_jaccard_links_copies_in_slices_with_and_without_a_long_word(documents):
    near = PROSE.replace("potions", "brews", 1)
    rows = [(1, PROSE, "en", "a"), (2, FILLER, "en", "a"), (3, PROSE, "en", "a"), (4, LONG, "en", "a"), (5, near, "en", "a"), (6, FILLER, "en", "a"), (7, f"{PROSE} {LONG}", "en", "a")]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(documents(rows).coalesce(1)).collect()}
    assert len(got) == 7 and got[1] == got[3] == got[5] == got[7] == 1 and got[2] == got[6] == 2 and got[4] == 4


def test_ppm_counts_words_beside_a_long_word_with_the_others(documents):
    rows = [(1, PROSE, "en", "a"), (2, FILLER, "en", "a"), (3, f"{PROSE} {LONG}", "en", "a"), (4, f"{LONG} fox zebra", "en", "a")]
    train = F.col("doc_id") < 4
    tokens = {i: [*t.split(), None] for i, t, _, _ in rows}
    counts = Counter(w for i in (1, 2, 3) for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    got = lm_ppm.score_documents(documents(rows).coalesce(1), train, buckets=5).collect()
    assert len(got) == 4
    for r in got:
        mine = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(counts[w] > 0 for w in mine), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in mine), rel=1e-9)
