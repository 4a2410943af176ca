"""Every stage of the corpus pipeline, and the whole, against plain versions of them."""

import random
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from fundlens.llm import line_dedup, quality
from fundlens.llm.queries import OP10_SQL, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCAB = [f"{a}{b}{c}" for a in "bdfklm" for b in "aeiou" for c in ("ran", "tel", "mis", "pon")]


def later_copies(docs, min_words=25):
    """{doc_id: deleted places} of distinct (doc_id, text), by all windows of lines with enough words."""
    seen = defaultdict(list)
    for i, text in sorted(docs):
        lines = text.split("\n")
        for lo in range(len(lines)):
            for hi in range(lo + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[lo:hi]) >= min_words:
                    seen["\n".join(lines[lo:hi]), hi - lo].append((i, lo, hi))
    gone = defaultdict(set)
    for places in seen.values():
        first_id, _, first_hi = min(places)
        for i, lo, hi in places:
            if (i, lo, hi) != min(places):
                gone[i] |= set(range(max(lo, first_hi) if i == first_id else lo, hi))
    return gone


def components(docs):
    """{doc_id: smallest linked doc_id} of distinct (doc_id, text)."""
    sets = {}
    for i, text in docs:
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """documents and labels with copies, shared passages, repeated rows, nulls and a long text."""
    rng = random.Random(8)
    line = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
    passage, short = [line(14), line(13), line(12)], line(6)
    texts = []
    for i in range(70):
        lines = [line(rng.randrange(5, 16)) for _ in range(12)]
        if i % 5 == 0:
            lines[4:4] = passage
        if i % 7 == 0:
            lines[2:2] = [short]
        texts.append("\n".join(lines))
    for i in range(12):  # near copies, in one line so that line dedup leaves them
        words = texts[0].split()
        words[5 + i] = f"other{i}"
        texts.append(" ".join(words))
    texts += ["\n".join(passage), "", " \n ", " ".join(line(10) for _ in range(4000))]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[60], (500, None, None, None, None), (None, texts[9] + " x", "de", "s1", 1), (501, texts[20], "en", None, 2)]
    rows += [(600 + i, "### $$ " + " ".join(f"|{w}|" for w in line(80).split()), "en", "s0", 1) for i in range(20)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(len(texts))] + [(600 + i, 0, 0) for i in range(12)] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, corpus):
    """[documents, rows after each stage], as lists of rows."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.written(stage(spark, out[-1], corpus), name))
    assert all(x.columns == COLUMNS for x in out[:-1])
    return out


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality_stage_keeps_whole_rows(spark, corpus, stages):
    docs, kept = stages[:2]
    model = quality.fit(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    verdict = {(r.doc_id, r.n_words): r.kept for r in quality.assess(docs, model).collect()}
    want = Counter({r: n for r, n in rows_of(docs).items() if verdict[r[0], len((r[1] or "").split())]})
    assert rows_of(kept) == want
    ids = {r[0] for r in want}
    assert set(range(82)) <= ids and not ids & set(range(600, 620))


def test_line_dedup_stage_equals_all_windows(stages):
    before, after = rows_of(stages[1]), rows_of(stages[2])
    low = lambda i: -(2**63) if i is None else i
    gone = later_copies({(low(r[0]), r[1]) for r in before if r[1]})
    want = Counter()
    for (i, text, lang, source, _), n in before.items():
        left = [x for k, x in enumerate((text or "").split("\n")) if k not in gone[low(i)]]
        new = "\n".join(left)
        if new or not gone[low(i)]:
            want[i, new, lang, source, len(new)] += n
    assert after == want and sum(map(len, gone.values())) > 30


def test_one_of_every_group_stays(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    of = components({(r[0], r[1] or "") for r in before if r[0] is not None})
    assert after == Counter({r: n if r[0] is None else 1 for r, n in before.items() if r[0] is None or of[r[0]] == r[0]})
    assert len(set(of.values())) < len(of)


def test_mixing_stage_equals_sql(stages):
    documents = stages[3].toArrow()
    with duckdb.connect() as con:
        con.register("documents", documents)
        want = Counter((i, s, t) for i, s, _, t in con.execute(OP10_SQL).fetchall())
    same = Counter()
    for (i, text, _, source, _), n in rows_of(stages[4]).items():
        same[i, source, text] += n
    assert same == want and rows_of(stages[4]).keys() <= rows_of(stages[3]).keys()


def test_encoded_ids_are_those_of_the_ranks(stages):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    path, pattern = vocabulary()
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    want = Counter((r[0], tuple(encoding.encode_ordinary(r[1] or ""))) for r in rows_of(stages[4]).elements())
    got = stages[5].collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want and all(r.n_tokens == len(r.ids) for r in got)


def test_run_is_its_stages(spark, corpus, stages):
    final = lambda df: Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in df.collect())
    assert final(corpus_pipeline.run(spark, corpus)) == final(stages[-1])


def test_line_dedup_equals_all_windows_on_random_lines(documents):
    rng = random.Random(5)
    pool = [" ".join(rng.choice(VOCAB) for _ in range(n)) for n in (3, 6, 9, 12, 14, 26)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(rows + rows[:3])).collect()}
    gone = later_copies({(i, t) for i, t, _, _ in rows})
    for i, t, _, _ in rows:
        assert got[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), i
