"""Token counts, the Merkle manifest and ranked search against the library or plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fundlens.llm import lexical, merkle, queries, token_counts

WORDS = "tea ship river stone light garden Tea cloud seven iron paper wind glass road field snow".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + ("" if rng.random() < 0.8 else str(rng.randrange(500))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(documents):
    rng = random.Random(5)
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n ...", "en", "b"),
        (4, "a<|endoftext|>b <|endoftext|><|endoftext|> <|endoftext|", "en", "a"),
        (5, "it's WE'LL don't    x 　y\x1c\x85z 12²٣ ՘֋ 你好吗 \U0001f600\U0003fc3d Ⅷ½ é", "de", "b"),
        (6, "x" * 5000 + " " * 300 + "é" * 400, None, "b"),
        (7, prose(rng, 60_000), "fr", "b"),
        (8, "tea ship tea", "en", "a"),
        (8, "tea ship tea", "en", "a"),
        (9, "Tea, ship! TEA", "", "a"),
        (None, "tea river", "en", None),
        (None, "tea river", "en", None),
    ]
    rows += [(100 + i, prose(rng, rng.randrange(1, 80)), rng.choice(["en", "de", "fr", None]), "c") for i in range(150)]
    return documents(rows)


# ------------------------------------------------------------ token counts


@pytest.fixture(scope="module")
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(odd, tokenizer_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path)
    rows = odd.collect()
    expect = Counter()
    for r in rows:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        expect[(r.doc_id, len((r.text or "").encode()), n, n > 1024)] += 1
    for table in (None, token_counts.FrequentTable.pack({}), token_counts.frequent_table(odd, tokenizer_path, 3)):
        got = token_counts.count_tokens(odd, tokenizer_path, table=table)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert Counter(map(tuple, got.collect())) == expect
    assert token_counts.count_tokens(odd.limit(0), tokenizer_path).count() == 0


def test_alike_ranges_are_cut_alike(tokenizer_path):
    with open(tokenizer_path, encoding="utf-8") as f:
        cut = token_counts.PreTokens(f.read())
    pre = cut.tokenizer.pre_tokenizer
    for low, high in token_counts.ALIKE:
        for at in range(low, high + 1, 500):
            text = "".join(f"a{c}1{c} {c}{c}! {c}" for c in map(chr, range(at, min(at + 500, high + 1))))
            assert cut.find(text) == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)]


def test_summary_keeps_what_is_frequent(spark, tokenizer_path):
    texts = [" tea" * 50 + "".join(f" w{i * 100 + j}" for j in range(100)) for i in range(40)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    with open(tokenizer_path, encoding="utf-8") as f:
        row = token_counts.frequent_pretokens(docs, f.read(), size=8).first()
    assert " tea" in row.pretokens and len(row.pretokens) <= 8
    # at most all / (size + 1) occurrences are lost
    every = sum(len(token_counts.PATTERN and t.split()) for t in texts)
    assert dict(zip(row.pretokens, row.counts))[" tea"] >= 40 * 50 - every * 2 / 9


# ---------------------------------------------------------------- manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def text_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout):
    """(last node, per node its list of (left, right) siblings)."""
    paths, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for i, leaves in enumerate(spans[at : at + fanout]):
                for leaf in leaves:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            above.append(H(*run))
            merged.append([x for s in spans[at : at + fanout] for x in s])
        nodes, spans = above, merged
    return nodes[0], paths


def plain_manifest(rows, fanout):
    groups = {}
    for r in rows:
        leaf = H(*[text_field(r[c]) for c in merkle.LEAF_COLUMNS])
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf, r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = climb([x[2] for x in groups[g]], fanout)
    root, over = climb([trees[g][0] for g in order], fanout)
    for i, g in enumerate(order):
        subroot, paths = trees[g]
        for (_, _, leaf, r), path in zip(groups[g], paths):
            yield r, leaf, subroot, root, path + over[i]


@pytest.mark.parametrize("fanout,block", [(2, 1024), (2, 4), (3, 9), (5, 5)])
def test_manifest_equals_plain_trees(odd, monkeypatch, fanout, block):
    monkeypatch.setattr(merkle, "levels_of_block", lambda f, b=block: max(1, round(math.log(block, f))))
    got = merkle.manifest(odd, fanout=fanout, carry={"twice": F.col("n_chars") * 2})
    assert got.columns == ["doc_id", "leaf", "twice", "subroot", "root", "path"]
    found = Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got.collect())
    expect = list(plain_manifest(odd.collect(), fanout))
    assert found == Counter((r.doc_id, leaf, sub, root, tuple(path)) for r, leaf, sub, root, path in expect)
    proven = got.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).distinct().collect()
    assert [r.ok for r in proven] == [True]


def test_manifest_query_finds_tampering(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_merkle(spark, str(tmp_path))
    expect = Counter()
    for r, leaf, subroot, root, path in plain_manifest(odd.collect(), 2):
        marked = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
        node = H(*[text_field(r[c] + marked if c == "n_chars" and r[c] is not None else r[c]) for c in merkle.LEAF_COLUMNS])
        for left, right in path:
            node = H(left, node, right)
        assert (node == root) != marked
        expect[(r.doc_id, leaf, subroot, root, H(*[a + b for a, b in path]), node, node == root)] += 1
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.select(*columns).collect())) == expect


def test_manifest_of_few_rows(odd):
    assert merkle.manifest(odd.limit(0)).count() == 0
    one = merkle.manifest(odd.filter("doc_id = 7")).collect()
    assert [(r.root, r.subroot, r.path) for r in one] == [(one[0].leaf, one[0].leaf, [])]
    text_ids = odd.filter("doc_id > 99").withColumn("doc_id", F.concat(F.lit("id"), "doc_id"))
    assert merkle.manifest(text_ids).select("root").distinct().count() == 1


# ------------------------------------------------------------------ search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k):
    """(item, rank) -> (doc id, score) by scoring every document."""
    split = [(r.doc_id, Counter(TERM.findall((r.text or "").translate(LOWER)))) for r in docs]
    split = [(i, c, sum(c.values())) for i, c in split if c]
    N, L = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = {}
    for item, text in items:
        ranked = []
        for doc_id, tf, n in split:
            m = 100 - 75 + (75 * n * N) // L
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                ranked.append((-score, doc_id is not None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(ranked)[:k], 1):
            out[(item, rank)] = (doc_id, -score)
    return out


def test_search_equals_scoring_every_document(spark, odd, monkeypatch):
    rng = random.Random(9)
    items = [(1, "Tea ship 你好吗 tea"), (2, None), (3, "nothingofthekind"), (4, ""), (None, "river stone"), (6, "\x1c é Ⅷ½")]
    items += [(10 + i, prose(rng, rng.randrange(1, 60))) for i in range(25)]
    benchmark = spark.createDataFrame([*items, items[0]], "item_id long, text string")  # a repeated row counts once
    expect = {k: plain_search(odd.collect(), items, k) for k in (1, 10)}
    for block, segment, parts in ((128, 8 << 20, 3), (4, 2000, 2), (1, 1, 1)):
        monkeypatch.setattr(lexical, "BLOCK", block)
        index = lexical.store_index(lexical.build_index(odd.repartition(parts), segment_bytes=segment))
        for k in (1, 10):
            got = lexical.search(index, benchmark, k, query_bytes=300 if block == 4 else 1 << 20)
            rows = got.collect()
            assert {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows} == expect[k] and len(rows) == len(expect[k])


def test_blocks_are_rejected_before_they_are_unpacked(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    texts = [prose(rng, 30) for _ in range(4000)]
    for i in range(10):
        texts[i] += " beacon beacon"
    row = lexical.pack_segment(pa.array(range(4000)), [lexical.terms(t) for t in texts])
    seg = lexical.Segment(row, 4000, row["n_terms"])
    unpacked = []
    plain = lexical.Segment.unpack
    monkeypatch.setattr(lexical.Segment, "unpack", lambda self, blocks: unpacked.extend(blocks.tolist()) or plain(self, blocks))
    words = ["beacon", "tea", "ship", "river"]
    code = [seg.vocabulary.to_pylist().index(w.encode()) for w in words]
    import numpy as np

    weight = np.array([lexical.term_weight(4000, int(seg.term_df[c])) for c in code], np.int64)
    doc, _ = lexical.search_segment(seg, np.array(code), weight, 0, 10)
    assert sorted(doc.tolist()) == list(range(10))
    assert len(unpacked) < 0.1 * sum(int(seg.term_end[c] - seg.term_block[c]) for c in code)


def test_search_of_empty_tables_and_text_ids(spark, odd):
    items = spark.createDataFrame([("a", "tea")], "item_id string, text string")
    assert lexical.top_documents(odd.limit(0), items).collect() == []
    assert lexical.top_documents(odd.filter("doc_id = 2"), items).collect() == []
    assert lexical.top_documents(odd, items.limit(0)).collect() == []
    named = odd.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    rows = lexical.top_documents(named, items, 3).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3]
    assert all(r.item_id == "a" and (r.doc_id or "d").startswith("d") for r in rows)
