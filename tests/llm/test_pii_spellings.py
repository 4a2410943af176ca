"""Dates of all written forms stay distinct, spellings of one value stay linked."""

import re

import pytest
from pyspark.sql import functions as F

from fundlens.llm import pii

KEY = "key"


def digits(text):
    return re.sub(r"\D", "", text)


@pytest.fixture(scope="module")
def century(spark):
    """(day, form, written, new) of every day of 2000-2099 in all forms, and of a leap year of 1900-1999."""
    days = spark.range(0, 36525).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    days = days.unionByName(spark.range(0, 366).select(F.date_add(F.lit("1996-01-01").cast("date"), F.col("id").cast("int")).alias("day")))
    forms = ["yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy"]
    each = F.array(*[F.struct(F.lit(f).alias("form"), F.date_format("day", f).alias("written")) for f in forms])
    rows = days.select("day", F.explode(each).alias("e")).select("day", "e.*")
    rows = rows.filter("form <> 'MM/dd/yyyy' OR day(day) > 12")  # the others read as day first
    return rows.select("day", "form", "written", pii._date(KEY, F.col("written")).alias("new")).toPandas()


def test_dates_are_permuted_within_their_forms(century):
    assert not century.new.isna().any()
    assert century.written.nunique() == len(century)
    assert century.new.nunique() == len(century)
    assert (century.new.str.replace(r"\d", "0", regex=True) == century.written.str.replace(r"\d", "0", regex=True)).all()
    # exactly the valid strings of each form of the whole century
    whole = century[century.day.astype(str) >= "2000"]
    for _, part in whole[whole.form.isin(["yyyy-MM-dd", "dd.MM.yyyy"])].groupby("form"):
        assert set(part.new) == set(part.written)
    slashed = whole[whole.form.str.contains("/")]
    assert set(slashed.new) == set(slashed.written)


def test_one_day_is_one_pseudonym_in_every_form(century):
    parts = {"yyyy-MM-dd": (0, 1, 2), "dd.MM.yyyy": (2, 1, 0), "dd/MM/yyyy": (2, 1, 0), "MM/dd/yyyy": (2, 0, 1)}
    split = century.new.str.split(r"[-./]", regex=True)
    day = [tuple(p[i] for i in parts[f]) for f, p in zip(century.form, split)]
    assert century.assign(to=day).groupby("day").to.nunique().eq(1).all()
    assert len(set(day)) == century.day.nunique()


@pytest.fixture(scope="module")
def replace(documents):
    def run(texts):
        rows = pii.pseudonymise(documents([(i, t, "en", "a") for i, t in enumerate(texts)]), KEY).collect()
        return [r.text for r in sorted(rows, key=lambda r: r.doc_id)], [r.n_replaced for r in sorted(rows, key=lambda r: r.doc_id)]

    return run


def test_spellings_of_a_phone_number_share_a_pseudonym(replace):
    spellings = ["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "555 123 4567", "555.123.4567", "555-123-4567", "(555) 123-4567"]
    new, n = replace(spellings)
    assert n == [1] * len(spellings)
    national = {digits(t)[-10:] for t in new}
    assert len(national) == 1 and national != {"5551234567"}
    assert national.pop()[0] in "23456789"
    assert [re.sub(r"\d", "0", t) for t in new] == [re.sub(r"\d", "0", t) for t in spellings]
    assert all(t.startswith("+1") for t in new[:3])


def test_country_codes_are_cut_by_their_table(replace):
    pairs = [("+49 30 1234567", "+49301234567", "49"), ("+353 1 234 5678", "+35312345678", "353"), ("+7 495 123 45 67", "+74951234567", "7")]
    for a, b, code in pairs:
        (x, y), n = replace([a, b])
        assert n == [1, 1]
        assert digits(x) == digits(y) != digits(a) and digits(x).startswith(code)
    (x, y), _ = replace(["+49 (0)30 1234567", "+49 30 1234567"])
    assert x.startswith("+49 (0)") and digits(x)[3:] == digits(y)[2:]


def test_rows_of_numbers_are_no_phones(replace):
    texts = ["555 123 4567 8901", "12 555 123 4567", "1.555.123.4567", "3.555 123 4567", "555 123.4567", "155 123 4567"]
    assert replace(texts) == (texts, [0] * len(texts))


def test_cards_start_above_zero(replace):
    zeros = "0000000000000000"
    (a, b), n = replace([zeros, "4111111111111111"])
    assert a == zeros and n == [0, 1]
    assert b[0] != "0" and b != "4111111111111111"


def test_account_numbers_in_lower_case(replace):
    (a, b, c), n = replace(["DE89 3704 0044 0532 0130 00", "iban de89370400440532013000 x", "de89370400440532013001"])
    assert n == [1, 1, 0]
    assert b[5:27] == a.replace(" ", "").lower() != "de89370400440532013000"
    assert c == "de89370400440532013001"


def test_an_empty_table_gives_an_empty_result(documents):
    assert pii.pseudonymise(documents([]), KEY).collect() == []
