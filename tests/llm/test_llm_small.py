"""Each operator on small tables against brute force, with nulls, empty and long texts, ties and clashing names."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fundlens.llm import jaccard_join, langid, line_dedup, lm_ppm, mixing, nn_descent, pii, quality, tokenize_bpe, toxicity
from fundlens.llm.queries import vocabulary

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix bright potions under a pale winter moon near old stone towers "


def words(text):
    return WORDS.findall((text or "").encode().translate(LOW))


@pytest.fixture(scope="module")
def odd(documents):
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(6000))
    rows = [
        (1, PROSE * 2, "en", "a"),
        (2, PROSE * 2, "en", "a"),
        (3, (PROSE * 2).replace("fox", "cat", 1), "en", "a"),
        (4, None, None, None),
        (5, "", "en", "a"),
        (6, " \t\n ", "en", "b"),
        (7, "one two", "en", "b"),
        (8, "One  TWO", "en", "b"),
        (9, long_text, "en", "b"),
        (10, "12 34 !?", "en", "b"),
        (11, "é ü ß 你好 it's 3.14\x00 \U0001f600", "de", None),
        (None, PROSE, "en", "a"),
        (1, PROSE * 2, "en", "a"),
    ]
    return documents(rows)


def test_bpe_equals_the_rank_encoder(odd):
    import tiktoken

    path, pattern = vocabulary()
    ranks = {t: i for i, t in enumerate(tokenize_bpe.read_ranks(path))}
    encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    encoded = tokenize_bpe.encode_documents(odd, path, pattern)
    for r in encoded.collect():
        assert r.ids == encoder.encode_ordinary(texts[r.doc_id])
    for r in tokenize_bpe.decode_documents(encoded, path, pattern).collect():
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    for r in tokenize_bpe.encode_digest(odd, path, pattern).collect():
        ids = encoder.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert tokenize_bpe.encode_digest(odd.limit(0), path, pattern).count() == 0


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_components_equal_brute_force(odd):
    want = brute_components([(r.doc_id, r.text) for r in odd.collect()])
    got = jaccard_join.jaccard_components(odd).collect()
    assert len(got) == 13
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    assert jaccard_join.jaccard_components(odd.limit(0)).count() == 0


def test_jaccard_finds_links_in_a_group_larger_than_a_node(documents, monkeypatch):
    """Near copies of one text, so many that cells exceed a node: hubs, then nodes, find every link."""
    import random

    rng = random.Random(4)
    base = [f"word{rng.randrange(10**6)}" for _ in range(60)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(60)] = f"other{rng.randrange(10**6)}"
        rows.append((i, " ".join(t), "en", "a"))
    monkeypatch.setattr(jaccard_join, "NODE", 8)
    want = brute_components([(r[0], r[1]) for r in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents(rows)).collect()}
    assert got == want


def test_line_dedup_deletes_later_copies_of_long_runs_only(documents):
    passage = " ".join(f"p{i}" for i in range(30))
    parts = ["alpha " * 10 + "x", "beta " * 9 + "y", "gamma " * 9 + "z"]
    rows = [
        (1, f"intro one\n{passage}\nend one", "en", "a"),
        (2, f"intro two\n{passage}\nend two", "en", "a"),
        (3, "\n".join(["first", *parts, "tail"]), "en", "a"),
        (4, "\n".join(["second", *parts, "other tail"]), "en", "a"),
        (5, "short line\nend one", "en", "a"),
        (6, f"{passage}\n{passage}\n{passage}", "en", "a"),
        (7, None, "en", "a"),
        (8, "", "en", "a"),
        (None, f"{passage}\nof no id", "en", "a"),
    ]
    out = line_dedup.dedup_lines(documents(rows), count_col="deleted")
    got = {r.doc_id: (r.text, r.deleted) for r in out.collect()}
    assert out.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "id"]
    assert got[None] == (f"{passage}\nof no id", 0)  # a null id comes first
    assert got[1] == ("intro one\nend one", 1) and got[2] == ("intro two\nend two", 1)
    assert got[3][1] == 0 and got[4] == ("second\nother tail", 3)
    assert got[5][1] == 0 and got[6] == ("", 3) and got[7] == (None, 0) and got[8] == ("", 0)
    assert 6 not in {r.doc_id for r in line_dedup.dedup_lines(documents(rows), drop_emptied=True).collect()}
    assert line_dedup.dedup_lines(documents(rows).limit(0)).count() == 0


def test_quality_base_columns_equal_brute_force(documents, odd):
    extra = documents([(20, "a b c a b c d\na b c a b c d\n\n x# $y", "en", "a"), (21, "go " * 70, "en", "a"), (22, "### | <b> & 100%\n### | <b> & 100%", "en", "a")])
    rows = odd.unionByName(extra)
    model = quality.QualityModel((0.0,) * 16, 0.0)
    got = quality.assess(rows, model)
    texts = defaultdict(list)
    for r in rows.collect():
        texts[r.doc_id].append(r.text or "")
    for r in got.collect():
        t = texts[r.doc_id][0]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        twice = {x for x, n in Counter(windows).items() if n > 1}
        covered = {i + k for i, x in enumerate(windows) if x in twice for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, (r, want)
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and r.kept == (not r.base_failed)


def test_quality_model_separates_and_keeps_columns(documents, spark):
    good = [(i, PROSE + " ".join(f"u{i}x{k}" for k in range(40)), "en", "a") for i in range(40)]
    bad = [(100 + i, " ".join(f"{c}###" for c in (PROSE * 2).split()) + " " + " ".join(f"{c}$$ b{i}" for c in PROSE.split()), "en", "a") for i in range(20)]
    docs = documents(good + bad)
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(10)] + [(None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, buckets=512)
    kept = quality.keep_good(docs, model)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40)) and kept.columns == docs.columns
    assert quality.fit(docs, labels.limit(0), buckets=64).threshold == float("-inf")


def test_pii_pseudonyms_keep_format_and_links(documents):
    a = "pay 4111 1111 1111 1111 not 4111111111111112 call +1 (017) 555-7713 mail Bob.20@mail9.example.com"
    b = 'again 4111111111111111 from 144.137.247.239 on 29/02/1984, 30.02.2001, 123-45-6789, GB82 WEST 1234 5698 7654 32, token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"'
    got = {r.doc_id: r for r in pii.pseudonymise(documents([(1, a, "en", "s"), (2, b, "en", "s"), (3, None, "en", "s"), (4, "", "en", "s"), (5, a, "en", "s")]), "key").collect()}
    assert got[1].text == got[5].text and got[3].text is None and got[4].text == "" and got[4].n_replaced == 0
    assert got[1].kinds == ["card", "phone", "email"] and "4111111111111112" in got[1].text
    card = re.search(r"pay (\d{4} \d{4} \d{4} \d{4}) ", got[1].text).group(1).replace(" ", "")
    assert card != "4111111111111111" and f"again {card} " in got[2].text  # linked across formats
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} mail [A-Z][a-z]{2}\.\d\d@mail9.example.com", got[1].text)
    assert "555-7713" not in got[1].text and "Bob.20" not in got[1].text
    assert got[2].kinds == ["card", "ipv4", "date", "ssn", "iban", "secret"] and "30.02.2001" in got[2].text
    iban = re.search(r"GB\d\d(?: [A-Z0-9]{1,4})+", got[2].text).group().replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_feistel_is_a_permutation(spark):
    grid = spark.range(7 * 11).select(pii.feistel("k", "t", F.floor(F.col("id") / 11), F.lit(7), F.col("id") % 11, F.lit(11)).alias("p"))
    assert grid.distinct().count() == 77 and grid.filter("p.l < 0 OR p.l >= 7 OR p.r < 0 OR p.r >= 11").count() == 0
    shapes = spark.range(100).select(pii.permute_shape("k", "t", F.format_string("%02d", "id")).alias("p"))
    assert shapes.distinct().count() == 100 and shapes.filter(r"NOT p RLIKE '^[0-9]{2}$'").count() == 0


def test_poisson_copies(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "big").otherwise("small").alias("source"), F.lit("t").alias("text"))
    mixed = mixing.mix_sources(docs, weights={"big": 0.5, "small": 0.5}, copy_col="copy")
    n = {r.source: r.n for r in mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(n["big"] - 2000) < 180 and abs(n["small"] - 2000) < 180
    assert mixed.groupBy("doc_id", "copy").count().filter("count > 1").isEmpty()
    rates = {r.source: r.rate for r in mixing.repetition_rates(docs, weights={"big": 0.5, "small": 0.5}).collect()}
    drawn = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i in range(0, 4000, 97):
        u = int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:13], 16) / 2**52
        rate = rates["big" if i < 3000 else "small"]
        k, p = 0, math.exp(-rate)
        cdf = p
        while u >= cdf:
            k += 1
            p *= rate / k
            cdf += p
        assert drawn.get(i, 0) == k
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, "a"), (1, None, "b")], "doc_id long, source string, text string")
    assert mixing.mix_sources(odd, epochs=40.0).count() > 20  # a null source is a source


def test_langid_learns_and_answers(documents):
    french = "le petit chat noir dort sous la vieille table près de la fenêtre ouverte pendant que les enfants jouent dehors "
    rows = [(i, PROSE[i % 30 :] * 2, "en", "a") for i in range(60)] + [(100 + i, french[i % 30 :] * 2, "fr", "a") for i in range(60)]
    rows += [(200, None, "en", "a"), (201, "12 34 !?", "en", "a"), (202, "", "fr", "a"), (203, french * 3, None, "a"), (204, PROSE * 200, None, "a")]
    docs = documents(rows)
    net = langid.fit(docs, F.coalesce(F.col("doc_id"), F.lit(0)) >= 0)
    got = {r.doc_id: r for r in langid.predict(docs, net).collect()}
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and got[203].lang_pred == "fr" and got[204].lang_pred == "en"
    assert sum(got[r[0]].lang_pred == r[2] for r in rows[:120]) >= 118 and all(0 <= r.score <= 1 for r in got.values())
    assert langid.fit(docs.limit(0), F.lit(True)) is None
    assert {r.lang_pred for r in langid.predict(docs.limit(3), None).collect()} == {"und"}


def test_toxicity_learns_words_by_compression(documents, spark):
    import random

    rng = random.Random(3)
    vocab = [f"{a}{b}{c}" for a in "bdfklm" for b in "aeiou" for c in ("ran", "tel", "mis", "pon", "gur")]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(vocab) for _ in range(120)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(6):
                text[rng.randrange(120)] = rng.choice(["horridword", "nastyterm", "vileinsult"])
        rows.append((i, " ".join(text), "en", "a"))
        labels.append((i, int(toxic)))
    docs = documents(rows + [(900, None, "en", "a"), (901, "", "en", "a")])
    table = spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, table, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = [(i, y) for i, y in labels if i % 5 == 0]
    assert sum(got[i].predicted == y for i, y in held) >= 0.95 * len(held)
    assert got[900].score == got[901].score and 0 <= got[900].score <= 1 and got[900].predicted == 0
    assert toxicity.fit(docs, table.limit(0), F.lit(True)).weights[0] < 0


def naive_ppm(texts, train, text):
    trie = defaultdict(Counter)
    for t in train:
        b = b"\xfe" * 4 + t + b"\xff"
        for p in range(4, len(b)):
            for k in range(5):
                trie[b[p - k : p]][b[p]] += 1
    b, total = b"\xfe" * 4 + text + b"\xff", 0.0
    for p in range(4, len(b)):
        out = set()
        for k in (4, 3, 2, 1, 0):
            left = {s: n for s, n in trie.get(b[p - k : p], {}).items() if s not in out}
            if not left:
                continue
            n, d = sum(left.values()), len(left)
            if b[p] in left:
                total += math.log10(left[b[p]] / (n + d))
                break
            total += math.log10(d / (n + d))
            out |= set(left)
        else:
            total -= math.log10(255 - len(out))
    return total


def test_ppm_equals_a_naive_trie(odd):
    train = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 0
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    learned = [t for i, t in rows if (i or 0) % 3 != 0]
    counts = Counter(w for t in learned for w in [*WORDS.findall(t.translate(LOW)), None])
    n, v = sum(counts.values()), len(counts)
    texts = dict(rows)
    got = lm_ppm.score_documents(odd, train, block_bytes=2000, buckets=5).collect()
    assert len(got) == 13
    for r in got:
        tokens = [*WORDS.findall(texts[r.doc_id].translate(LOW)), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
        if len(texts[r.doc_id]) < 3000:
            assert r.score == pytest.approx(naive_ppm(texts, learned, texts[r.doc_id]), rel=1e-5)
    assert lm_ppm.score_documents(odd.limit(0), train).count() == 0


def test_nn_descent_small_tables_and_recall(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).astype("float32")
    x[300:420] = x[7]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in nn_descent.nearest(df, F.col("vec_id") % 20 == 0, leaf=128, trees=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    y, hits, total = x.astype(float), 0, 0
    for q in range(0, 600, 20):
        s = y @ y[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(600), -s))[:20]
        assert len(got[q]) == 20 and all(abs(sc - s[v]) < 1e-9 for v, sc in got[q])
        hits, total = hits + len(set(best.tolist()) & {v for v, _ in got[q]}), total + 20
    assert hits / total >= 0.95 and set(got) == set(range(0, 600, 20))
    few = spark.createDataFrame(rows[:5], df.schema)
    assert nn_descent.nearest(few, F.col("vec_id") == 0).count() == 4
    assert nn_descent.nearest(df.limit(0), F.lit(True)).count() == 0
