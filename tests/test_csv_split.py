"""Multi-line CSV cut by quote parity: equal to the one-task reader, over many ranges of one file."""

import random
from collections import Counter

import pytest

from fundlens.sources.csv import CSV_OPTIONS, read_csv_dataset
from fundlens.sources.csv_split import range_states, scan_ranges, _lines


@pytest.fixture
def small_ranges(spark):
    """Ranges of the given size, whatever the file."""
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    before = {k: spark.conf.get(k) for k in keys}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n", last=True):
    def cell(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"' if v == "" or any(c in v for c in '",\n\r') else v

    text = end.join(",".join(map(cell, r)) for r in rows) + (end if last else "")
    path.write_bytes(text.encode())
    return len(text.encode())


def random_rows(rng, n):
    bits = ["tea", " ", "\n", "\n\n", '"', '""', ",", "é", "#1", "ship", "", " x ", '",\n"']
    rows = [["id", "long text", "c"]]
    for i in range(n):
        rows.append([str(i), *[rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))]) for _ in range(2)]])
    return rows


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("size", [40, 700])
def test_equals_the_one_task_reader(spark, tmp_path, small_ranges, seed, size):
    rng = random.Random(seed)
    files = tmp_path / "csv"
    files.mkdir()
    for name in ("a", "b"):
        write(files / f"{name}.csv", random_rows(rng, rng.randrange(60, 150)), last=rng.random() < 0.5)
    one = rows_of(read_csv_dataset(spark, str(files), drop_tags=False))
    small_ranges(size)
    for empty_as_null in (True, False):
        one = rows_of(read_csv_dataset(spark, str(files), drop_tags=False, empty_as_null=empty_as_null))
        split = read_csv_dataset(spark, str(files), drop_tags=False, empty_as_null=empty_as_null, split_records=True)
        assert split.columns == ["id", "long text", "c"]
        assert rows_of(split) == one


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    rng = random.Random(11)
    rows = [["id", "text"]] + [[str(i), "line one\nline two, " + "x" * rng.randrange(50)] for i in range(2000)]
    rows[1000][1] = "a record longer than a range\n" + "words and\n" * 3000
    size = write(tmp_path / "one.csv", rows)
    small_ranges(size // 16)
    lines = _lines(spark, str(tmp_path / "one.csv"))
    ranges = scan_ranges(lines).collect()
    assert len(ranges) >= 12
    inside = [k for k, v in range_states([tuple(r) for r in ranges])[0].items() if v is not None]
    assert inside  # some ranges start within a record
    split = read_csv_dataset(spark, str(tmp_path / "one.csv"), split_records=True)
    assert rows_of(split) == Counter(map(tuple, rows[1:]))


CRLF = '\r\n\r\na,b\r\n1,"x\r\ny"\r\n\r\n2\r\n3,4,5\r\n"",\r\n6,"z"'
ALL_LF = '\n\na,b\n1,"x\r\ny"\n\n2\n3,"4\r",5\n"",\n7,r\r\n \n6,"z"'


@pytest.mark.parametrize("text", [CRLF, ALL_LF])
def test_line_ends_blank_lines_and_short_records(spark, tmp_path, small_ranges, text):
    (tmp_path / "c.csv").write_bytes(text.encode())
    one = rows_of(read_csv_dataset(spark, str(tmp_path)))
    assert len(one) >= 5
    for size in (3, 12, 1 << 20):
        small_ranges(size)
        assert rows_of(read_csv_dataset(spark, str(tmp_path), split_records=True)) == one


def test_a_stray_quote_raises(spark, tmp_path, small_ranges):
    (tmp_path / "bad.csv").write_text('a,b\n1,5" pipe\n2,x\n3,6" pipe\n4,y\n')
    for size in (4, 1 << 20):
        small_ranges(size)
        with pytest.raises(Exception, match="not certain"):
            read_csv_dataset(spark, str(tmp_path), split_records=True).collect()


def test_header_only_and_other_dialects(spark, tmp_path, small_ranges):
    (tmp_path / "h.csv").write_text('"a\nb",c\n')
    small_ranges(3)
    out = read_csv_dataset(spark, str(tmp_path / "h.csv"), split_records=True)
    assert out.columns == ["a\nb", "c"] and out.collect() == []
    (tmp_path / "s.csv").write_text('a;b\n1;"x;\n2"\n')
    assert read_csv_dataset(spark, str(tmp_path / "s.csv"), options={"sep": ";"}, split_records=True).collect() == [("1", "x;\n2")]
    with pytest.raises(ValueError, match="doubling"):
        read_csv_dataset(spark, str(tmp_path / "s.csv"), options={"escape": "\\"}, split_records=True)
    assert CSV_OPTIONS["escape"] == CSV_OPTIONS["quote"]


def test_states_are_a_prefix_sum():
    ranges = [(7, 0, "f", "f", 1, 1, 5, 5, 0), (7, 10, "f", "f", 0, 0, 5, 4, 1), (7, 20, "f", "f", 1, 1, 5, 4, 1), (7, 30, "f", "f", 0, 1, 5, 5, 1)]
    states, crlf, headers = range_states([*ranges, (9, 0, "g", "g", 0, 0, 5, 2, 1)])
    assert states == {(7, 0): None, (7, 10): 0, (7, 20): 0, (7, 30): None, (9, 0): None}
    assert crlf == {7} and headers == {(7, 10), (9, 0)}
    with pytest.raises(RuntimeError, match="share a hash"):
        range_states([(7, 0, "f", "f", 0, 0, 1, 0, 1), (7, 1, "g", "g", 0, 0, 1, 0, 1)])
