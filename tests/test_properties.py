"""Random-fixture checks of the multi-value split and the CSV round trip."""

import random
import tempfile

from fundlens.functions import explode_multi
from fundlens.sources.csv import read_csv_dataset, write_csv

ALPHABET = ["a", "B", "c", " ", ",", "  ", "x y", "é", "\t"]


def _py_split(text):
    if text is None:
        return [None]
    parts = [p.strip(" ").lower() for p in text.split(",")]
    parts = [p for p in parts if p != ""]
    return parts or [None]


def test_explode_multi_matches_python_split(spark):
    rng = random.Random(7)
    rows = [
        (i, None if rng.random() < 0.1 else "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))))
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "id int, v string")
    got = sorted(
        ((r.id, r.v) for r in explode_multi(df, "v", lower=True).collect()), key=repr
    )
    want = sorted(((i, p) for i, text in rows for p in _py_split(text)), key=repr)
    assert got == want


TEXT_PIECES = ["word", ",", '"', '""', "\n", "\t", " ", "#", "é", "1.5", ";"]


def test_csv_roundtrip_random_text(spark):
    rng = random.Random(11)

    def text():
        r = rng.random()
        if r < 0.05:
            return None
        if r < 0.1:
            return ""
        return "".join(rng.choice(TEXT_PIECES) for _ in range(rng.randint(1, 15)))

    rows = [(str(i), text(), text()) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, a string, b string")
    tags = spark.createDataFrame([("#id", "#a", "#b")], df.schema)
    path = tempfile.mkdtemp(prefix="fundlens-prop-") + "/out"
    write_csv(tags.unionByName(df), path)
    # default (as Spark's CSV defaults): an empty string comes back as null
    back = {r.id: (r.a, r.b) for r in read_csv_dataset(spark, path).collect()}
    assert len(back) == 400
    for i, a, b in rows:
        assert back[i] == (a or None, b or None), (i, a, b, back[i])
    # empty_as_null=False keeps "" apart from null: an exact round trip
    exact = {r.id: (r.a, r.b) for r in read_csv_dataset(spark, path, empty_as_null=False).collect()}
    for i, a, b in rows:
        assert exact[i] == (a, b), (i, a, b, exact[i])


def test_profiles_match_python(spark):
    import math
    import statistics

    from fundlens.operators import profile as P

    rng = random.Random(5)

    def maybe(v):
        return None if rng.random() < 0.15 else v

    rows = [
        (
            maybe(rng.randint(-5, 40)),
            maybe(rng.choice([0.5, -1.25, 3.0, 1e6, float("nan")])),
            maybe(rng.choice(["a", "b", "c", "", "é"])),
        )
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "i int, d double, s string")
    cols = list(zip(*rows))

    nulls = {r.column_name: r.null_count for r in P.null_counts(df, "t").collect()}
    assert nulls == {c: sum(v is None for v in vals) for c, vals in zip("ids", cols)}

    def n_distinct(vals):
        seen = set()
        for v in vals:
            if v is None:
                continue
            seen.add("nan" if isinstance(v, float) and math.isnan(v) else v)
        return len(seen)

    want = {c: n_distinct(vals) for c, vals in zip("ids", cols)}
    for kw in ({}, {"single_pass": True}, {"batch_size": 2}):
        got = {r.column_name: r.distinct_count for r in P.distinct_counts(df, "t", **kw).collect()}
        assert got == want, kw

    ints = [v for v in cols[0] if v is not None]
    st = {r.column_name: r for r in P.numeric_stats(df, "t", ["i"]).collect()}["i"]
    assert (st.min, st.max) == (min(ints), max(ints))
    assert math.isclose(st.avg, statistics.fmean(ints), rel_tol=1e-12)
    assert math.isclose(st.stddev, statistics.stdev(ints), rel_tol=1e-9)

    samples = [r.sample_value for r in P.key_samples(df, "t", "i", 5).collect()]
    assert samples == [str(v) for v in sorted(set(ints))[:5]]
