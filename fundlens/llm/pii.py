"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets (native).

Candidates are found by one pattern, validated per kind (check digit, octets,
number ranges, calendar) and replaced by a keyed Feistel permutation over
exactly the valid values of their format.  A permutation has no collisions and
no table: equal values get equal pseudonyms in every document, so they stay
linked, and separators, lengths and check digits stay right.  Everything is
DataFrame functions on one row at a time; nothing is shuffled.

kind    valid value                                permuted
card    13-19 digits from 1 on, Luhn, anywhere in a row   all but the check digit, which is computed anew
phone   +cc and 7-15 digits, or 10 NANP-style      the national digits, by country code, however they are spelled
ipv4    four octets                                the 32-bit number
ssn     ddd-dd-dddd with valid ranges              the rank among the valid numbers
iban    country, check digits, 11-30 characters    the account part; check digits computed anew
date    yyyy-mm-dd, dd/mm/yyyy, mm/dd/yyyy or dd.mm.yyyy in 1900-2099   the day within its century and half of the month
email   local part @ domain                        letters and digits of the local part
secret  token, secret, password or key assignment  letters and digits of the value

Spellings of one value stay linked: a date in any of its formats, a phone
number with and without its country code, an account number in either case.
A date with slashes whose second part is above 12 can only be month first, any
other is read day first.  Days up to the 12th and later ones are permuted
apart, so both readings keep to their own written forms and never collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.columns import qcol

ROUNDS = 8

# Characters of an account number with its country and check digits; other countries are tried at any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|CR|HR|LI|LV",
    22: "BG|BH|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
    27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    return rf"(?:{countries})\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{{groups}}}" + (rf"[ ]?[A-Z0-9]{{{rest}}}" if rest else "")


_BY_COUNTRY = "|".join(_iban_of(n, c) for n, c in IBAN_LENGTHS.items())
_LOWER_CASE = "|".join(_iban_of(n, c.lower()).replace("A-Z", "a-z") for n, c in IBAN_LENGTHS.items())
IBAN = "|".join([_BY_COUNTRY, _LOWER_CASE, r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?"])

# One alternative per kind, tried in this order at each position.
PATTERNS = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+",
    "secret": r"(?<![A-Za-z])(?i:token|secret|password|api[_-]?key)[ ]?[:=][ ]?\"?[A-Za-z0-9_-]{16,}",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d|[a-z]{{2}}\d)(?:{IBAN})(?![A-Za-z0-9])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]|\.\d)",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{3}\)[ ]?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
    r"|(?<![\d.,+-])(?<!\d[ ])(?:[2-9]\d{2} \d{3} \d{4}|[2-9]\d{2}\.\d{3}\.\d{4})(?![\d-]|[ .,]\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,}+",  # a whole row of numbers; _cards looks for the cards in it
}
CANDIDATE = "|".join(f"(?:{p})" for p in PATTERNS.values())

# A century has 1,200 months of 12 early days, 120 x 120, and of 19 later ones, 150 x 152, some of which do not exist.
EARLY, LATE = (1, 12, 120, 120), (13, 19, 150, 152)  # first day, days, grid
WALK = 24  # turns until an existing day is met; one in 34 does not exist, so no value needs them all
# Country calling codes of one and two digits (fixed values); all others have three.
CALLING_CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
SSN_GROUPS, SSN_SERIALS, SSN_AREAS = 99, 9999, 898


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _keyed(key: str, kind: str | Column, turn: Column, value: Column) -> Column:
    """64 hex digits from the key, the kind, the round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)


def _number(hexes: Column) -> Column:
    return F.conv(F.substring(hexes, 1, 13), 16, 10).cast("long")


def feistel(key: str, kind: str | Column, left: Column, size_left: Column, right: Column, size_right: Column) -> Column:
    """A keyed permutation of the grid [0, size_left) x [0, size_right), as struct(l, r).

    Rounds add a hash of one half to the other, modulo its size, in turns.
    """
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(s["l"] + _number(_keyed(key, kind, i, s["r"])), size_left.cast("long"))).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + _number(_keyed(key, kind, i, s["l"])), size_right.cast("long"))).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def permute_digits(key: str, kind: str | Column, digits: Column, lead: Column | None = None) -> Column:
    """A permutation of the digit strings of this length (up to 30 digits).

    With ``lead``, of 2 digits or more that start with at least that digit:
    those among themselves, the others among themselves.
    """
    n = F.char_length(digits)
    h = F.floor(n / 2).cast("int")
    size = lambda k: F.pow(F.lit(10.0), k).cast("long")
    left = F.coalesce(F.substring(digits, F.lit(1), h).try_cast("long"), F.lit(0))
    right = F.coalesce(F.substring(digits, h + 1, n - h).try_cast("long"), F.lit(0))
    least, span = F.lit(0).cast("long"), size(h)
    if lead is not None:
        first = F.when(h > 0, lead * size(h - 1)).otherwise(F.lit(0)).cast("long")
        least = F.when(left >= first, first).otherwise(F.lit(0)).cast("long")
        span = F.when(left >= first, size(h) - first).otherwise(first)
    out = feistel(key, kind, left - least, span, right, size(n - h))
    pad = lambda v, k: F.when(k > 0, F.lpad(v.cast("string"), k, F.lit("0"))).otherwise(F.lit(""))
    return _let(out, lambda s: F.concat(pad(s["l"] + least, h), pad(s["r"], n - h)))


def _shifted(text: Column, hexes: Column, letters: int) -> Column:
    """Each ASCII digit or letter moved within its class by its byte of ``hexes`` (cycled)."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(hexes, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        within = lambda base, size: F.char(F.lit(base) + F.pmod(code - base + by, F.lit(size)))
        return (
            F.when(code.between(48, 57), within(48, 10))
            .when(code.between(97, 96 + letters), within(97, letters))
            .when(code.between(65, 64 + letters), within(65, letters))
            .otherwise(c)
        )

    return F.array_join(F.transform(chars, move), "")


def permute_shape(key: str, kind: str, text: Column, letters: int = 26) -> Column:
    """A permutation of the strings with the same pattern of digits, letters and other characters."""
    n = F.char_length(text)
    h = F.floor(n / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), h).alias("l"), F.substring(text, h + 1, n - h).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, _shifted(s["l"], _keyed(key, kind, i, s["r"]), letters)).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(_shifted(s["r"], _keyed(key, kind, i, s["l"]), letters)).alias("r"),
        )

    return _let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn), lambda s: F.concat(s["l"], s["r"]))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(shape: Column, filling: Column, refilled: str = "[0-9]") -> Column:
    """``shape`` with its ``refilled`` characters replaced in order by those of ``filling``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(s: Column, c: Column) -> Column:
        return F.when(
            c.rlike(refilled), F.struct(F.concat(s["out"], F.substring(filling, s["k"], F.lit(1))).alias("out"), (s["k"] + 1).alias("k"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k")))

    return F.aggregate(F.split(shape, ""), start, put)["out"]


def luhn_digit(payload: Column) -> Column:
    """The check digit of a digit string."""
    digits = F.reverse(F.transform(F.filter(F.split(payload, ""), lambda c: c != ""), lambda c: c.cast("int")))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.pmod(10 - F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10, F.lit(10)).cast("string")


def iban_check(country: Column, account: Column) -> Column:
    """The two check digits: 98 minus the number (account, country, 00) modulo 97."""
    chars = F.filter(F.split(F.concat(account, country, F.lit("00")), ""), lambda c: c != "")

    def add(s: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        return F.when(letter, (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97)

    return F.lpad((98 - F.aggregate(chars, F.lit(0), add)).cast("string"), 2, "0")


# Groups of a card as they are usually written, tried in this order at each number of a row: (groups, pattern).
CARD_SHAPES = (
    (1, r"^\d{13,19}[ -]?$"),
    (4, r"^\d{4}([ -])\d{4}\1\d{4}\1\d{4}[ -]?$"),
    (3, r"^\d{4}([ -])\d{6}\1\d{4,5}[ -]?$"),
    (5, r"^\d{4}([ -])\d{4}\1\d{4}\1\d{4}\1\d{1,3}[ -]?$"),
)
CARD_DIGITS = 13, 19


def _body(digits: Column) -> Column:
    return F.substring(digits, F.lit(1), F.char_length(digits) - 1)


def _is_card(text: Column) -> Column:
    return _let(digits_of(text), lambda d: F.char_length(d).between(*CARD_DIGITS) & ~d.startswith("0") & (luhn_digit(_body(d)) == F.substring(d, -1, 1)))


def _card(key: str, h: Column) -> Column:
    return _refill(h, _let(permute_digits(key, "card", _body(digits_of(h)), F.lit(1)), lambda p: F.concat(p, luhn_digit(p))))


def _cards(key: str, h: Column) -> Column:
    """struct(kind, value, n): ``h`` with the n cards in it replaced; null if there are none.

    From left to right, each number of a row may start a card: in one of the
    usual shapes, or, at the row's start and behind what was tried that way,
    in as many numbers as 19 digits hold, however grouped.
    """
    low, high = CARD_DIGITS

    def scan(tokens: Column) -> Column:
        run = lambda i, k: F.array_join(F.slice(tokens, i + 1, k), "")
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("free"), F.lit(0).alias("any"), F.lit(0).alias("n"))

        def longest(i: Column) -> Column:
            """How many tokens from the i-th are numbers of 19 digits in all."""
            begin = F.struct(F.lit(0).alias("k"), F.lit(0).alias("d"), F.lit(True).alias("open"))

            def more(s: Column, j: Column) -> Column:
                t = F.get(tokens, i + j)
                d = s["d"] + F.coalesce(F.char_length(digits_of(t)), F.lit(high + 1))
                ok = s["open"] & (d <= high) & t.rlike("^[0-9]")
                return F.struct(F.when(ok, s["k"] + 1).otherwise(s["k"]).alias("k"), F.when(ok, d).otherwise(s["d"]).alias("d"), ok.alias("open"))

            return F.aggregate(F.sequence(F.lit(0), F.lit(high - 1)), begin, more, lambda s: F.when(s["d"] >= low, s["k"]).otherwise(F.lit(0)))

        def found(i: Column, widest: Column) -> Column:
            """The first number of tokens that make a card from the i-th on, 0 for none."""
            fits = lambda p: lambda c: c.rlike(p) & _is_card(c)
            shaped = [F.when(_let(run(i, F.lit(k)), fits(p)), F.lit(k)) for k, p in CARD_SHAPES]
            return F.coalesce(*shaped, F.when((widest > 0) & _is_card(run(i, widest)), widest), F.lit(0))

        def step(s: Column, i: Column) -> Column:
            def put(w: Column) -> Column:
                def with_found(k: Column) -> Column:
                    tried = F.when(i >= s["any"], i + F.greatest(w, F.lit(1))).otherwise(s["any"])
                    card = F.struct(
                        F.concat(s["out"], _card(key, run(i, k))).alias("out"), (i + k).alias("free"), (i + k).alias("any"), (s["n"] + 1).alias("n")
                    )
                    other = F.struct(F.concat(s["out"], F.get(tokens, i)).alias("out"), (i + 1).alias("free"), tried.alias("any"), s["n"].alias("n"))
                    return F.when(k > 0, card).otherwise(other)

                return _let(found(i, w), with_found)

            return F.when(i < s["free"], s).otherwise(_let(F.when(i >= s["any"], longest(i)).otherwise(F.lit(0)), put))

        return F.aggregate(F.sequence(F.lit(0), F.size(tokens) - 1), start, step)

    scanned = _let(F.regexp_extract_all(h, F.lit("[0-9]+[ -]?|[^0-9]+"), F.lit(0)), scan)
    some = _let(scanned, lambda s: F.when(s["n"] > 0, F.struct(F.lit("card").alias("kind"), s["out"].alias("value"), s["n"].alias("n"))))
    return F.when(F.char_length(digits_of(h)) >= low, some)


def _phone(key: str, h: Column) -> Column:
    """The national digits permuted by country code, that of numbers without one being 1; a trunk (0) stays."""
    lead = F.regexp_extract(h, rf"^\+{CALLING_CODE}(?:[ .-]?\(0\))?", 0)
    code = F.when(h.startswith("+"), F.regexp_extract(h, rf"^\+({CALLING_CODE})", 1)).otherwise(F.lit("1"))
    rest = F.substring(h, F.char_length(lead) + 1, F.char_length(h))
    area = F.when((code == "1") & (F.char_length(digits_of(rest)) == 10), F.lit(2)).otherwise(F.lit(0))  # areas start with 2 to 9
    new = permute_digits(key, F.concat(F.lit("phone"), code), digits_of(rest), area)
    return F.when(F.char_length(digits_of(rest)).between(7, 15), F.concat(lead, _refill(rest, new)))


def _ipv4(key: str, h: Column) -> Column:
    octet = lambda p, i: F.get(p, F.lit(i)).cast("long")
    out = _let(F.split(h, r"\."), lambda p: feistel(key, "ipv4", octet(p, 0) * 256 + octet(p, 1), F.lit(65536), octet(p, 2) * 256 + octet(p, 3), F.lit(65536)))
    two = lambda v: (F.floor(v / 256).cast("string"), (v % 256).cast("string"))
    return _let(out, lambda s: F.concat_ws(".", *two(s["l"]), *two(s["r"])))


def _ssn(key: str, h: Column) -> Column:
    area, group, serial = (F.substring(h, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = area - F.when(area > 666, 2).otherwise(1)
    out = feistel(key, "ssn", rank * SSN_GROUPS + group - 1, F.lit(SSN_AREAS * SSN_GROUPS), serial - 1, F.lit(SSN_SERIALS))

    def spell(s: Column) -> Column:
        r = F.floor(s["l"] / SSN_GROUPS).cast("int")
        return F.format_string("%03d-%02d-%04d", r + F.when(r >= 665, 2).otherwise(1), (s["l"] % SSN_GROUPS + 1).cast("int"), (s["r"] + 1).cast("int"))

    return F.when(valid, _let(out, spell))


def _upper_iban(key: str, h: Column) -> Column:
    bare = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    country, account = (lambda b: F.substring(b, 1, 2)), (lambda b: F.substring(b, F.lit(5), F.char_length(b)))
    ok = lambda b: F.char_length(b).between(15, 34) & (iban_check(country(b), account(b)) == F.substring(b, 3, 2))
    new = lambda b: _let(permute_shape(key, "iban", account(b)), lambda a: F.concat(country(b), iban_check(country(b), a), a))
    # the longest of its beginnings that end before a space and hold, the whole first
    words = F.split(h, " ")
    begins = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))
    valid = F.filter(begins, lambda x: ok(bare(x)))
    rest = lambda x: F.substring(h, F.char_length(x) + 1, F.char_length(h))
    return _let(F.get(valid, F.lit(0)), lambda x: F.concat(_refill(x, new(bare(x)), "[A-Z0-9]"), rest(x)))


def _iban(key: str, written: Column) -> Column:
    """Upper and lower case are one number; the pattern lets no mixture through."""
    return _let(F.upper(written), lambda h: _let(_upper_iban(key, h), lambda new: F.when(written == h, new).otherwise(F.lower(new))))


def _day(key: str, day: Column) -> Column:
    """The pseudonym of a date among the existing days of its century, early or later in the month like itself.

    Later days are numbered with those that do not exist; a turn that ends on one of these is followed by another.
    """
    century = F.floor(F.year(day) / 100).cast("int")
    early = F.dayofmonth(day) <= EARLY[1]
    first, days, a, b = (F.when(early, F.lit(x)).otherwise(F.lit(y)) for x, y in zip(EARLY, LATE))
    months = (F.year(day) - century * 100) * 12 + F.month(day) - 1
    own = F.struct(
        F.concat(F.lit("date"), century.cast("string"), early.cast("string")).alias("kind"),
        (century * 100).alias("year"), first.alias("first"), days.alias("days"), a.alias("a"), b.alias("b"),
        (months * days + F.dayofmonth(day) - first).cast("long").alias("at"),
    )

    def walked(o: Column) -> Column:
        def of(at: Column) -> Column:
            month = F.floor(at / o["days"]).cast("int")
            start = F.make_date(o["year"] + F.floor(month / 12).cast("int"), month % 12 + 1, F.lit(1))
            return F.date_add(start, (at % o["days"] + o["first"] - 1).cast("int"))

        def turn(s: Column, _: Column) -> Column:
            moved = _let(feistel(key, o["kind"], F.floor(s["at"] / o["b"]), o["a"], s["at"] % o["b"], o["b"]), lambda g: g["l"] * o["b"] + g["r"])
            exists = lambda at: F.dayofmonth(of(at)) == at % o["days"] + o["first"]
            return F.when(s["done"], s).otherwise(_let(moved, lambda at: F.struct(at.alias("at"), exists(at).alias("done"))))

        begin = F.struct(o["at"].alias("at"), F.lit(False).alias("done"))
        return _let(F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), begin, turn), lambda s: F.when(s["done"], of(s["at"])))

    return F.when(F.year(day).between(1900, 2099), _let(own, walked))


def _date(key: str, h: Column) -> Column:
    read = lambda fmt: F.try_to_timestamp(h, F.lit(fmt)).cast("date")
    iso, dotted, day_first = h.rlike(r"^\d{4}-"), h.contains("."), read("dd/MM/yyyy")
    day = F.when(iso, read("yyyy-MM-dd")).when(dotted, read("dd.MM.yyyy")).otherwise(F.coalesce(day_first, read("MM/dd/yyyy")))
    spelled = lambda d: (
        F.when(iso, F.date_format(d, "yyyy-MM-dd"))
        .when(dotted, F.date_format(d, "dd.MM.yyyy"))
        .when(day_first.isNotNull(), F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "MM/dd/yyyy"))
    )
    return _let(_let(day, lambda d: _day(key, d)), spelled)


def _email(key: str, h: Column) -> Column:
    local = F.substring_index(h, "@", 1)
    return F.concat(permute_shape(key, "email", local), F.substring(h, F.char_length(local) + 1, F.char_length(h)))


def _secret(key: str, h: Column) -> Column:
    name = F.regexp_extract(h, r"^([^:=]*[:=][ ]?\"?)", 1)
    value = F.substring(h, F.char_length(name) + 1, F.char_length(h))
    hexed = value.rlike("^[0-9A-Fa-f]+$")
    return F.concat(name, F.when(hexed, permute_shape(key, "hex", value, 6)).otherwise(permute_shape(key, "secret", value)))


KINDS = {
    "email": _email,
    "secret": _secret,
    "iban": _iban,
    "date": _date,
    "ipv4": _ipv4,
    "ssn": _ssn,
    "phone": _phone,
}


def _replacement(key: str, h: Column) -> Column:
    """struct(kind, value, n): of the first kind whose pattern covers the candidate and whose check holds, else of the cards in it."""
    tries = [F.when(h.rlike(f"^(?:{PATTERNS[kind]})$"), _let(make(key, h), _named(kind))) for kind, make in KINDS.items()]
    return F.coalesce(*tries, _cards(key, h))


def _named(kind: str):
    return lambda v: F.when(v.isNotNull(), F.struct(F.lit(kind).alias("kind"), v.alias("value"), F.lit(1).alias("n")))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_replaced, kinds): the whole text with every valid value replaced.

    ``kinds`` lists the kind of each replaced value in text order.  Invalid
    candidates (a failed check digit, an impossible date) stay as they are.  A
    null text stays null with no values; rows are independent.
    """
    if not key:
        raise ValueError("a key is needed")
    text = F.col("text")
    rows = docs.select(qcol(id_col).alias("id"), qcol(text_col).cast("string").alias("text"))
    # only texts with a digit, an @ or an assigned word can hold a candidate
    possible = text.rlike(r"[0-9@]|(?i:token|secret|password|key)[ ]?[:=]")
    found = rows.select("id", "text", F.when(possible, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).otherwise(F.array().cast("array<string>")).alias("hits"))
    mapped = found.select("id", "text", "hits", F.transform("hits", lambda h: _replacement(key, h)).alias("new"))
    gaps = F.split(text, CANDIDATE, -1)
    pieces = F.zip_with(gaps, F.zip_with("hits", "new", lambda h, n: F.coalesce(n["value"], h)), lambda g, v: F.concat(g, F.coalesce(v, F.lit(""))))
    kept = F.filter("new", lambda n: n.isNotNull())
    return mapped.select(
        F.col("id").alias(id_col),
        F.when(F.size("hits") > 0, F.array_join(pieces, "")).otherwise(text).alias("text"),
        F.coalesce(F.aggregate(kept, F.lit(0), lambda s, n: s + n["n"]), F.lit(0)).cast("long").alias("n_replaced"),
        F.flatten(F.transform(kept, lambda n: F.array_repeat(n["kind"], n["n"]))).alias("kinds"),
    )
