"""Valid values beside other numbers and words: each is replaced, what stands around it stays."""

import re

import pytest

from fundlens.llm import pii

CARD = "4111 1111 1111 1111"


def luhn(text):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", text))]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


@pytest.fixture(scope="module")
def replaced(documents):
    texts = [
        f"card {CARD} 12/26",
        "4111111111111111 123",
        f"3 {CARD}",
        "AT61 1904 3002 3457 3201 BIC X",
        f"12 34 56 78 90 {CARD} 77 8",
        f"1234 {CARD} {CARD} 5",
        "7 3782 822463 10005 9",
        "ID12 4111 1111 1111 1111",
        "DE89 3704 0044 0532 0130 00 COBADEFFXXX",
        "AT61 1904 3002 3457 3201 DE89 3704 0044 0532 0130 00",
        "4111 1111 1111 1112 13",
        "12 " * 3000 + CARD,
    ]
    rows = pii.pseudonymise(documents([(i, t, "en", "a") for i, t in enumerate(texts)]), "key").collect()
    return {texts[r.doc_id]: r for r in rows}


@pytest.mark.parametrize(
    "text, n",
    [(f"card {CARD} 12/26", 1), ("4111111111111111 123", 1), (f"3 {CARD}", 1), (f"12 34 56 78 90 {CARD} 77 8", 1), (f"1234 {CARD} {CARD} 5", 2), ("7 3782 822463 10005 9", 1), ("ID12 4111 1111 1111 1111", 1)],
)
def test_cards_beside_other_numbers(replaced, text, n):
    r = replaced[text]
    assert r.n_replaced == n and r.kinds == ["card"] * n
    assert re.sub(r"\d", "0", r.text) == re.sub(r"\d", "0", text)
    known = [CARD, CARD.replace(" ", ""), "3782 822463 10005"]
    value = next(v for v in known if v in text)
    at = text.index(value)
    assert value not in r.text and luhn(r.text[at : at + len(value)])
    before, after = text[:at], text[at + len(value) * n + n - 1 :]
    assert r.text.startswith(before) and r.text.endswith(after)


def test_equal_cards_stay_equal(replaced):
    alone = re.search(r"3 ([\d ]+)", replaced[f"3 {CARD}"].text).group(1)
    assert replaced[f"1234 {CARD} {CARD} 5"].text == f"1234 {alone} {alone} 5"
    assert replaced["4111111111111111 123"].text == alone.replace(" ", "") + " 123"
    assert replaced["12 " * 3000 + CARD].text.endswith(" " + alone)


def test_ibans_beside_words_and_each_other(replaced):
    def valid(t):
        t = t.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1

    one = replaced["AT61 1904 3002 3457 3201 BIC X"]
    assert one.n_replaced == 1 and one.kinds == ["iban"] and one.text.endswith(" BIC X") and "1904 3002" not in one.text and valid(one.text[:24])
    bic = replaced["DE89 3704 0044 0532 0130 00 COBADEFFXXX"]
    assert bic.n_replaced == 1 and bic.text.endswith(" COBADEFFXXX") and valid(bic.text[:27]) and "3704 0044" not in bic.text
    two = replaced["AT61 1904 3002 3457 3201 DE89 3704 0044 0532 0130 00"]
    assert two.n_replaced == 2 and two.text[:24] == one.text[:24] and two.text[25:] == bic.text[:27]


def test_invalid_numbers_stay(replaced):
    r = replaced["4111 1111 1111 1112 13"]
    assert (r.text, r.n_replaced, r.kinds) == ("4111 1111 1111 1112 13", 0, [])
