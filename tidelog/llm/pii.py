"""PII pseudonyms by format-preserving Feistel permutations, in DataFrame operations only.

Matches of one pattern are taken out of a text, each is validated (Luhn digit, calendar date,
octets, area codes), and its digits are permuted with a key inside their own format: a card
stays a number with a right check digit, a date a date, punctuation stays in place. A value has
one pseudonym everywhere, so documents stay linked through it, and ``reveal`` undoes it. Every
permutation runs over valid values only (ranked, or walked until one is met), so a pseudonym is
found again as a value of its kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_of

ROUNDS = 8
REPEATED = r"^(.)\1*$"
KEY = "tidelog-demonstration-key"
# Formats, tried in this order at each place.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z])",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "date": r"(?<![\d-])\d{4}-\d{2}-\d{2}(?!-?\d)|(?<![\d./])\d{2}(?:\.\d{2}\.|/\d{2}/)\d{4}(?![./]?\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "national_id": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
}
#: All but the first begin with a digit, a plus or a bracket: elsewhere nothing is tried.
NUMBERS = r"(?=[\d+(])(?:" + "|".join(list(FORMATS.values())[1:]) + ")"
PATTERN = FORMATS["email"] + "|" + NUMBERS
#: 400 Gregorian years from 1800-01-01 are 146097 days, which is 189 times 773.
FIRST_DAY, DAY_SIDES = "1800-01-01", (189, 773)
#: Valid areas are 001 to 899 without 666; groups 01 to 99 and serials 0001 to 9999.
AREAS, NO_AREA, GROUPS, SERIALS = 898, 666, 99, 9999
#: At most ten numbers of a length repeat one digit, so a walk meets another one by then.
WALK = 11


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _noise(key: str, kind: str, r: Column, *other: Column) -> Column:
    """60 bits from key, format, round and the other half."""
    parts = F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), *[o.cast("string") for o in other])
    return F.conv(F.substring(F.sha2(parts.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, a_size: Column, b_size: Column, key: str, kind: str, reveal: bool = False) -> Column:
    """struct(a, b): a keyed permutation of the pairs a < a_size, b < b_size; ``reveal`` inverts it."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if reveal else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(s, r):
        def moved(x, other, size):
            shift = F.pmod(_noise(key, kind, r, size, other), size)
            return F.pmod(x - shift if reveal else x + shift, size)

        even = r % 2 == 0
        left = F.when(even, moved(s["a"], s["b"], a_size)).otherwise(s["a"])
        right = F.when(even, s["b"]).otherwise(moved(s["b"], s["a"], b_size))
        return F.struct(left.alias("a"), right.alias("b"))

    return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _digits(d: Column, key: str, kind: str, reveal: bool) -> Column:
    """Permutes a string of 2 to 19 digits among the strings of that length."""
    n = F.length(d)
    half = F.floor(n / 2).cast("int")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    pair = feistel(F.substring(d, F.lit(1), half), F.substring(d, half + 1, n), ten(half), ten(n - half), key, kind, reveal)
    return _let(pair, lambda p: F.concat(F.lpad(p["a"].cast("string"), half, F.lit("0")), F.lpad(p["b"].cast("string"), n - half, F.lit("0"))))


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order."""
    begin = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def filled(d):
        def step(acc, c):
            is_digit = c.between("0", "9")
            return F.struct(F.concat(acc["out"], F.when(is_digit, F.substring(d, acc["k"], F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"))

        return F.aggregate(F.split(m, ""), begin, step, lambda acc: acc["out"])

    return _let(digits, filled)


def _luhn(d: Column) -> Column:
    """Sum of the digits, every second one from the right doubled, modulo 10."""
    n = F.length(d)

    def step(acc, i):
        v = F.substring(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return acc + v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10


def _card(m: Column, key: str, reveal: bool) -> Column:
    """The body permuted, the check digit made anew; walks on from numbers of one repeated digit, which are no cards."""
    checked = lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0")))) % 10).cast("string"))
    moved = lambda d: _let(_let(F.substring(d, F.lit(1), F.length(d) - 1), lambda b: _digits(b, key, "card", reveal)), checked)
    begin = lambda d: F.struct(d.alias("d"), F.lit(False).alias("done"))

    def step(acc, _):
        on = lambda new: F.struct(new.alias("d"), (~new.rlike(REPEATED)).alias("done"))
        return F.when(acc["done"], acc).otherwise(_let(moved(acc["d"]), on))

    return _refill(m, F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), begin(_only_digits(m)), step, lambda acc: acc["d"]))


def _national_id(m: Column, key: str, reveal: bool) -> Column:
    """Area, and group with serial, as ranks among the valid ones."""
    number = lambda at, n: F.substring(m, at, n).cast("long")
    area, rest = number(1, 3), (number(5, 2) - 1) * SERIALS + number(8, 4) - 1
    rank = F.when(area > NO_AREA, area - 2).otherwise(area - 1)
    pair = feistel(rank, rest, F.lit(AREAS).cast("long"), F.lit(GROUPS * SERIALS).cast("long"), key, "national_id", reveal)
    shown = lambda p: F.format_string("%03d-%02d-%04d", F.when(p["a"] + 1 >= NO_AREA, p["a"] + 2).otherwise(p["a"] + 1), F.floor(p["b"] / SERIALS) + 1, p["b"] % SERIALS + 1)
    return _let(pair, shown)


def _phone(m: Column, key: str, reveal: bool) -> Column:
    prefix = F.regexp_extract(m, r"^(\+\d{1,3}(?=[ .(-]))?", 1)  # a country code set apart stays
    rest = F.substring(m, F.length(prefix) + 1, F.length(m))
    return F.concat(prefix, _refill(rest, _let(_only_digits(rest), lambda d: _digits(d, key, "phone", reveal))))


def _ip(m: Column, key: str, reveal: bool) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    side = F.lit(65536).cast("long")
    at = lambda k: F.element_at(o, k)
    pair = feistel(at(1) * 256 + at(2), at(3) * 256 + at(4), side, side, key, "ip", reveal)
    low = lambda x: (x % 256).cast("string")
    high = lambda x: F.floor(x / 256).cast("string")
    return _let(pair, lambda p: F.concat_ws(".", high(p["a"]), low(p["a"]), high(p["b"]), low(p["b"])))


def _day(m: Column) -> Column:
    """A match's date, or null where there is no such day."""
    iso = F.when(m.rlike(r"^\d{4}"), m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")


def _date(m: Column, key: str, reveal: bool) -> Column:
    sides = [F.lit(s).cast("long") for s in DAY_SIDES]
    n = F.datediff(_day(m), F.lit(FIRST_DAY).cast("date")).cast("long")
    mark = F.substring(m, 3, 1)

    def shown(day):
        return F.when(m.rlike(r"^\d{4}"), F.date_format(day, "yyyy-MM-dd")).otherwise(F.concat(F.date_format(day, "dd"), mark, F.date_format(day, "MM"), mark, F.date_format(day, "yyyy")))

    day = lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["a"] * sides[1] + p["b"]).cast("int"))
    return _let(_let(feistel(F.floor(n / sides[1]), n % sides[1], *sides, key, "date", reveal), day), shown)


def _email(m: Column, key: str, reveal: bool) -> Column:
    """Letters and digits of the local part, each within its class; the rest stays."""
    name = F.substring_index(m, "@", 1)
    half = F.floor(F.length(name) / 2).cast("int")
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if reveal else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def moved(x, other, r):
        def turn(c, i):
            shift = _noise(key, "email", r, i, other)
            spin = lambda first, size: F.char(F.lit(first) + F.pmod(F.ascii(c) - first + (-1 if reveal else 1) * F.pmod(shift, F.lit(size)), F.lit(size)))
            return F.when(c.rlike("^[a-z]$"), spin(97, 26)).when(c.rlike("^[A-Z]$"), spin(65, 26)).when(c.rlike("^[0-9]$"), spin(48, 10)).otherwise(c)

        return F.array_join(F.transform(F.split(x, ""), turn), "")

    def step(s, r):
        even = r % 2 == 0
        return F.struct(F.when(even, moved(s["a"], s["b"], r)).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(moved(s["b"], s["a"], r)).alias("b"))

    start = F.struct(F.substring(name, F.lit(1), half).alias("a"), F.substring(name, half + 1, F.length(name)).alias("b"))
    return F.concat(F.aggregate(rounds, start, step, lambda s: F.concat(s["a"], s["b"])), F.substring(m, F.length(name) + 1, F.length(m)))


def _valid(m: Column, kind: str) -> Column:
    fits = m.rlike("^(?:" + FORMATS[kind] + ")$")
    if kind == "ip":  # an octet with a leading zero has no one reading
        return fits & (F.size(F.filter(F.split(m, r"\."), lambda x: (x.cast("int") > 255) | x.rlike("^0."))) == 0)
    if kind == "date":
        days = F.datediff(_day(m), F.lit(FIRST_DAY).cast("date"))
        return fits & F.coalesce(days.between(0, DAY_SIDES[0] * DAY_SIDES[1] - 1), F.lit(False))
    if kind == "phone":
        return fits & F.length(_only_digits(m)).between(8, 15)
    if kind == "national_id":
        return fits & ~m.rlike(r"^(?:000|666|9)") & ~m.rlike(r"-00-|-0000$")
    if kind == "card":
        d = _only_digits(m)
        return fits & (F.length(d) <= 19) & (_luhn(d) == 0) & ~d.rlike(REPEATED)
    return fits


def pseudonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", reveal: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, and pii: array of the kinds that were replaced.

    Matches that fail validation stay as they are. Null stays null, empty stays empty; texts of any
    length are searched whole; rows are independent, so repeated rows and ids do not matter; an
    empty table stays empty. A column named pii is replaced, any other name may occur. ``reveal``
    with the same key restores the text.
    """
    make = {"email": _email, "ip": _ip, "date": _date, "phone": _phone, "card": _card, "national_id": _national_id}

    def one(m):
        kind = F.lit(None).cast("string")
        for name in reversed(FORMATS):
            kind = F.when(_valid(m, name), F.lit(name)).otherwise(kind)

        def replaced(k):
            new = m
            for name, f in make.items():
                new = F.when(k == name, f(m, key, reveal)).otherwise(new)
            return F.struct(k.alias("kind"), new.alias("new"))

        return _let(kind, replaced)

    text = F.col(text_col)
    by_kind = lambda use: F.when(text.contains("@"), use(PATTERN)).otherwise(use(NUMBERS))  # noqa: E731  no addresses to look for without an @
    hits = F.transform(by_kind(lambda p: F.when(text.rlike(p), F.regexp_extract_all(text, F.lit(p), F.lit(0)))), one)
    kept = [c for c in docs.columns if c != "pii"]
    hit = free_name(docs, "hits")
    found = docs.select(kept).withColumn(hit, F.coalesce(hits, F.array().cast("array<struct<kind:string,new:string>>")))
    both = F.arrays_zip(by_kind(lambda p: F.split(text, p, -1)).alias("gap"), F.transform(hit, lambda h: h["new"]).alias("new"))
    joined = F.array_join(F.transform(both, lambda x: F.concat(x["gap"], F.coalesce(x["new"], F.lit("")))), "")
    new_text = F.when(F.size(hit) > 0, joined).otherwise(text)
    kinds = F.filter(F.transform(hit, lambda h: h["kind"]), lambda k: k.isNotNull())
    made = {text_col: new_text.alias(text_col)}
    return found.select(*[made.get(c, F.col(c)) for c in kept], kinds.alias("pii"))
