"""Format-preserving pseudonyms: keyed Feistel permutations of numbers and dates.

Found in every whole text, left to right and without overlap: e-mail local parts, IPv4
addresses, North American phone numbers, calendar dates, social security numbers, account
numbers (IBAN) and payment card numbers.  A value is replaced only if it is valid (octets up
to 255, a real date, an assignable area, right check digits); its pseudonym has the same
layout and is valid in the same way.  A run of digits and blanks that could be a card is
looked through for the usual card groupings and for the other kinds first, so that a
number beside a card hides neither; only then it is taken as a card as a whole.  In dates with
slashes the day comes first where that is a date, else the month.  Equal values get equal pseudonyms under one key, in whatever
document, and no two values of a kind and layout get the same one.

Each kind is a range of integers a * b; a value splits into (value div b, value mod b) and
the halves are shifted in turn, modulo a and b, by keyed SHA-256 of the other half.  Every
round can be undone, so the whole is a permutation, and ``reveal`` runs it backwards.

Null text stays null, empty text stays empty; nothing is shuffled.  Columns other than
``text`` are left as they are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.llm.columns import let

ROUNDS = 8

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
PHONE = r"(?<![\w+])(?:\+?1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}(?!\w)"
#: A time may follow a date, as in 2024-03-25T10:00.
DATE = (r"(?<![\w/-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})"
        r"(?=T\d|[^\w/-]|$)")
SSN = r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
#: The usual groupings of a card, and any other run of so many digits.
GROUPED = r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
CARD = r"(?<![\w])\d(?:[ -]?\d){12,18}(?![\w])"
FOUND = "|".join((EMAIL, IPV4, PHONE, DATE, SSN, IBAN, GROUPED))
#: Runs of digits in which these are laid out are no cards as a whole.
LAID_OUT = "|".join((PHONE, DATE, SSN))

#: A Gregorian cycle of 400 years has 146,097 = 189 * 773 days.
FIRST_DAY, CYCLE = "1700-01-01", (189, 773)
#: Dates that only read month first have a day of 13 to 31 in one of the cycle's months; a
#: permutation of all these pairs is repeated until it meets a real date.
LATE_DAYS, CYCLE_MONTHS, WALK = 19, 4800, 16


@dataclass(frozen=True)
class Kind:
    """A whole match of ``pattern`` that is ``valid`` becomes ``swapped``."""
    name: str
    pattern: str
    valid: Column
    swapped: Column


def _long(x: Column) -> Column:
    return x.cast("long")


def _div(x: Column, n: int | Column) -> Column:
    """Whole quotient of non-negative longs, without doubles."""
    n = n if isinstance(n, Column) else F.lit(n)
    return _long((x - F.pmod(x, n)).cast("decimal(20,0)") / n.cast("decimal(20,0)"))


def _hmac(key: str, message: Column) -> Column:
    """HMAC-SHA256 as hex."""
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(x ^ pad for x in raw)) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(inner, message.cast("binary")), 256)
    return F.sha2(F.concat(outer, F.unhex(digest)), 256)


def _shift(key: str, kind: str, n: int, half: Column, modulus: Column) -> Column:
    digest = _hmac(key, F.concat(F.lit(f"{kind}:{n}:"), half.cast("string")))
    return F.pmod(_long(F.conv(F.substring(digest, 1, 15), 16, 10)), modulus)


def permuted(value: Column, a: int | Column, b: int | Column, key: str, kind: str,
             reverse: bool = False) -> Column:
    """The Feistel permutation of 0 .. a*b-1 under ``key``, or its inverse."""
    a, b = (_long(x if isinstance(x, Column) else F.lit(x)) for x in (a, b))
    sign = -1 if reverse else 1

    def halves(s: Column) -> Column:
        return F.struct(s["a"].alias("a"), s["b"].alias("b"), _div(s["v"], s["b"]).alias("x"),
                        F.pmod(s["v"], s["b"]).alias("y"))

    def shift_x(n: int):
        return lambda s: s.withField("x", F.pmod(
            s["x"] + sign * _shift(key, kind, n, s["y"], s["a"]), s["a"]))

    def shift_y(n: int):
        return lambda s: s.withField("y", F.pmod(
            s["y"] + sign * _shift(key, kind, n, s["x"], s["b"]), s["b"]))

    state = let(F.struct(a.alias("a"), b.alias("b"), value.alias("v")), halves)
    for n in reversed(range(ROUNDS)) if reverse else range(ROUNDS):
        state = let(state, shift_y(n) if n % 2 else shift_x(n))
    return let(state, lambda s: s["x"] * s["b"] + s["y"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _lay(layout: Column, digits: Column) -> Column:
    """Put ``digits`` one by one where ``layout`` has digits."""
    def put(s: Column) -> Column:
        chars = F.split(s["layout"], "")
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(chars, start, lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(c.rlike(r"^\d$"), F.substr(
                s["digits"], acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + c.rlike(r"^\d$").cast("int")).alias("at")), lambda acc: acc["out"])
    return let(F.struct(layout.alias("layout"), digits.alias("digits")), put)


def _pad(x: Column, n: int | Column) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right; those at positions ``doubled`` mod 2 count double."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
            i % 2 == doubled, F.get(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), c.cast("int")))
            .otherwise(c.cast("int"))),
        F.lit(0), lambda s, x: s + x)


def _kinds(m: Column, key: str, reverse: bool) -> list[Kind]:
    run = lambda v, a, b, kind: permuted(v, a, b, key, kind, reverse)
    digits = _digits(m)

    def octets(v: Column) -> Column:
        return F.concat_ws(".", *[_pad_none(F.pmod(F.shiftrightunsigned(v, s), F.lit(256)))
                                  for s in (24, 16, 8, 0)])

    parts = F.split(m, r"\.")
    address = _long(F.get(parts, 0)) * (1 << 24) + _long(F.get(parts, 1)) * (1 << 16) \
        + _long(F.get(parts, 2)) * (1 << 8) + _long(F.get(parts, 3))

    # Area and exchange start at 200, so that each has 800 values.
    ten = F.right(digits, F.lit(10))
    phone = (_long(F.substring(ten, 1, 3)) - 200) * 8_000_000 \
        + (_long(F.substring(ten, 4, 3)) - 200) * 10_000 + _long(F.substring(ten, 7, 4))

    def phone_text(v: Column) -> Column:
        body = F.concat(_pad(_div(v, 8_000_000) + 200, 3),
                        _pad(F.pmod(_div(v, 10_000), F.lit(800)) + 200, 3),
                        _pad(F.pmod(v, F.lit(10_000)), 4))
        return _lay(m, F.concat(F.when(F.length(digits) > 10, F.lit("1")).otherwise(""), body))

    formats = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"),
               (r"^\d\d/", "dd/MM/yyyy"), (r"^\d\d\.", "dd.MM.yyyy"))
    day = F.coalesce(*[F.when(m.rlike(p), F.to_date(F.try_to_timestamp(m, F.lit(f))))
                       for p, f in formats])
    offset = _long(F.datediff(day, F.lit(FIRST_DAY).cast("date")))

    def date_text(v: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), v.cast("int"))
        return F.coalesce(*[F.when(m.rlike(p), F.date_format(new, f)) for p, f in formats])

    # Month first: permuted among the dates that cannot be read the other way.
    month_first = F.to_date(F.try_to_timestamp(m, F.lit("MM/dd/yyyy")))
    start = int(FIRST_DAY[:4])
    months = (_long(F.year(month_first)) - start) * 12 + _long(F.month(month_first)) - 1
    late = months * LATE_DAYS + _long(F.day(month_first)) - 13

    def late_text(v: Column) -> Column:
        month = _div(v, LATE_DAYS)
        return F.concat_ws("/", _pad(F.pmod(month, F.lit(12)) + 1, 2),
                           _pad(F.pmod(v, F.lit(LATE_DAYS)) + 13, 2),
                           _pad(_div(month, 12) + start, 4))

    def is_date(v: Column) -> Column:
        return F.try_to_timestamp(late_text(v), F.lit("MM/dd/yyyy")).isNotNull()

    step = lambda v: run(v, CYCLE_MONTHS, LATE_DAYS, "late")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(late), lambda v, _: F.when(
        is_date(v), v).otherwise(step(v)))

    area = _long(F.substring(digits, 1, 3))
    place = area - 1 - (area > 666).cast("long")  # 001 to 899 without 666
    ssn = place * (99 * 9999) + (_long(F.substring(digits, 4, 2)) - 1) * 9999 \
        + _long(F.substring(digits, 6, 4)) - 1

    def ssn_text(v: Column) -> Column:
        p = _div(v, 99 * 9999)
        return F.concat_ws("-", _pad(p + 1 + (p >= 665).cast("long"), 3),
                           _pad(F.pmod(_div(v, 9999), F.lit(99)) + 1, 2),
                           _pad(F.pmod(v, F.lit(9999)) + 1, 4))

    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    n = F.length(digits) - 1
    ten_to = lambda k: F.get(F.lit([10 ** i for i in range(10)]), k)
    halves = (ten_to(_div(_long(n), 2).cast("int")), ten_to((n - _div(_long(n), 2)).cast("int")))

    def card_text(v: Column) -> Column:
        return let(_pad(v, n), lambda body: _lay(m, F.concat(body, F.pmod(
            10 - _luhn_sum(body, 0), F.lit(10)).cast("string"))))

    # A run that holds a card's grouping is permuted until no card is inside, as in the run
    # itself: what stands for it must not be taken for a card beside a number.
    card_step = lambda v: run(v, *halves, "card")
    inside = lambda text: F.exists(F.regexp_extract_all(text, F.lit(GROUPED), F.lit(0)),
                                   lambda x: F.pmod(_luhn_sum(_digits(x), 1), F.lit(10)) == 0)
    card = F.when(m.rlike(GROUPED) & ~m.rlike(f"^(?:{GROUPED})$"), F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), card_step(_long(payload)),
        lambda v, _: F.when(inside(card_text(v)), card_step(v)).otherwise(v))).otherwise(
        card_step(_long(payload)))

    return [
        Kind("email", EMAIL, F.lit(True), _local_part(m, key, reverse)),
        Kind("ipv4", r"\d{1,3}(?:\.\d{1,3}){3}",
             F.forall(parts, lambda p: p.cast("int") <= 255)
             & ~m.rlike(r"(^|\.)0\d"),
             let(run(address, 1 << 16, 1 << 16, "ipv4"), octets)),
        Kind("date", r"\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4}",
             (offset >= 0) & (offset < CYCLE[0] * CYCLE[1]),
             let(run(offset, *CYCLE, "date"), date_text)),
        Kind("date", r"\d\d/\d\d/\d{4}",
             day.isNull() & (months >= 0) & (months < CYCLE_MONTHS), let(walked, late_text)),
        Kind("iban", IBAN, _account_check(m) == F.substring(m, 3, 2),
             let(_account_digits(m, key, reverse), lambda x: F.concat(
                 F.substring(m, 1, 2), _account_check(x), F.substr(x, F.lit(5))))),
        Kind("ssn", r"\d{3}-\d\d-\d{4}",
             (area > 0) & (area < 900) & (area != 666)
             & (F.substring(digits, 4, 2) != "00") & (F.substring(digits, 6, 4) != "0000"),
             let(run(ssn, 898 * 99, 9999, "ssn"), ssn_text)),
        Kind("phone", PHONE, F.lit(True),
             let(run(phone, 80_000, 80_000, "phone"), phone_text)),
        Kind("card", r"\d(?:[ -]?\d){12,18}",
             (F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0) & ~m.rlike(LAID_OUT),
             let(card, card_text)),
    ]


def _account_check(account: Column) -> Column:
    """The check digits that an account number should have: 98 less the remainder by 97 of
    what follows them, the country and 00, letters counting 10 to 35."""
    body = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 2), F.lit("00"))
    chars = F.split(F.replace(body, F.lit(" "), F.lit("")), "")
    rest = F.aggregate(chars, F.lit(0), lambda acc, c: F.when(
        c.rlike("^[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise(
        (acc * 100 + F.ascii(c) - 55) % 97))
    return _pad(98 - rest, 2)


def _account_digits(account: Column, key: str, reverse: bool) -> Column:
    """The account with every run of up to 18 digits behind its check digits permuted."""
    body = F.substr(account, F.lit(5))
    blocks = F.regexp_extract_all(body, F.lit(r"\d(?: ?\d){0,17}|[^\d]+"), F.lit(0))
    power = lambda n: F.get(F.lit([10 ** i for i in range(10)]), n)

    def block(x: Column) -> Column:
        digits = _digits(x)
        n = F.length(digits)
        low = F.floor(n / 2).cast("int")
        swapped = let(permuted(_long(digits), power(n - low), power(low), key, "iban", reverse),
                      lambda v: _lay(x, _pad(v, n)))
        return F.when(n > 0, swapped).otherwise(x)

    return F.concat(F.substring(account, 1, 4), F.array_join(F.transform(blocks, block), ""))


def _pad_none(x: Column) -> Column:
    return x.cast("string")


def _local_part(m: Column, key: str, reverse: bool) -> Column:
    """Letters and digits before the @ in blocks of nine of a kind, permuted in place."""
    local, rest = F.substring_index(m, "@", 1), F.concat(F.lit("@"), F.substring_index(m, "@", -1))
    blocks = F.regexp_extract_all(local, F.lit(r"[a-z]{1,9}|[A-Z]{1,9}|[0-9]{1,9}|[^A-Za-z0-9]"),
                                  F.lit(0))

    def block(x: Column) -> Column:
        n = F.length(x)
        base = F.when(x.rlike("^[0-9]"), F.lit(10)).otherwise(F.lit(26)).cast("long")
        first = F.when(x.rlike("^[0-9]"), F.lit(48)).when(x.rlike("^[a-z]"), F.lit(97)) \
            .otherwise(F.lit(65))
        number = F.aggregate(F.split(x, ""), F.lit(0).cast("long"),
                             lambda s, c: s * base + (F.ascii(c) - first))
        power = lambda k: F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(1).cast("long"),
                                      lambda s, i: F.when(i <= k, s * base).otherwise(s))
        low = F.shiftright(n, 1)

        def spell(v: Column) -> Column:
            return F.reverse(F.aggregate(
                F.sequence(F.lit(1), n), F.struct(F.lit("").alias("t"), v.alias("v")),
                lambda s, i: F.struct(F.concat(s["t"], F.char(
                    F.pmod(s["v"], base) + first)).alias("t"), _div(s["v"], base).alias("v")),
                lambda s: s["t"]))

        swapped = let(permuted(number, power(n - low), power(low), key, "email", reverse), spell)
        return F.when(x.rlike("^[A-Za-z0-9]"), swapped).otherwise(x)

    return F.concat(F.array_join(F.transform(blocks, block), ""), rest)


def replaced(m: Column, key: str, reverse: bool = False) -> Column:
    """One match: (kind or null, what stands for it)."""
    kind = swapped = None
    for k in reversed(_kinds(m, key, reverse)):
        fits = m.rlike(f"^(?:{k.pattern})$") & F.coalesce(k.valid, F.lit(False))
        name = F.lit(k.name)
        kind = F.when(fits, name) if kind is None else F.when(fits, name).otherwise(kind)
        swapped = F.when(fits, k.swapped).otherwise(m if swapped is None else swapped)
    return F.struct(kind.alias("kind"), swapped.alias("value"))


def _answered(m: Column, key: str, reverse: bool) -> Column:
    return let(replaced(m, key, reverse), lambda r: F.struct(
        r["value"].alias("text"), r["kind"].alias("kind")))


def _parts(text: Column, pattern: str, answers: Column) -> Column:
    """``text`` as (text, kind) parts: what is between the matches, and their ``answers``."""
    plain = F.lit(None).cast("string").alias("kind")
    return F.flatten(F.transform(F.split(text, pattern), lambda piece, i: F.filter(F.array(
        F.struct(piece.alias("text"), plain), F.get(answers, i)), lambda x: x.isNotNull())))


def _joined(parts: Column) -> Column:
    """Neighbours without a kind as one part, so that a run of digits is whole again."""
    def add(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        open_ = (F.size(done) > 0) & F.get(done, F.size(done) - 1)["kind"].isNull()
        return F.when(open_ & part["kind"].isNull(), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(F.concat(last["text"], part["text"]).alias("text"),
                             part["kind"].alias("kind"))))).otherwise(
            F.concat(done, F.array(part)))
    return F.aggregate(parts, F.array().cast("array<struct<text:string,kind:string>>"), add)


def pseudonymise(docs: DataFrame, key: str, reverse: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``pii_kinds``: the kinds replaced, in order.

    Cards in other groupings are looked for in what the first search has left.  An input
    column of the name ``pii_kinds`` is replaced.
    """
    # Another name than any of the table's, then the table's own columns around it.
    name = "_pii"
    while name in docs.columns:
        name += "_"
    text, found = F.col("text"), F.col(name)
    rows = docs.withColumn(name, F.transform(
        F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)),
        lambda m: _answered(m, key, reverse)))
    rows = rows.withColumn(name, F.when(text.rlike(CARD), _joined(
        _parts(text, FOUND, found))).otherwise(_parts(text, FOUND, found)))
    cards = F.transform(found, lambda part: F.when(
        part["kind"].isNull(), F.transform(
            F.regexp_extract_all(part["text"], F.lit(CARD), F.lit(0)),
            lambda m: _answered(m, key, reverse))))
    rows = rows.withColumn(name, F.when(text.rlike(CARD), F.flatten(F.transform(
        F.arrays_zip(found.alias("part"), cards.alias("cards")), lambda x: F.when(
            F.size(x["cards"]) > 0, _parts(x["part"]["text"], CARD, x["cards"]))
        .otherwise(F.array(x["part"]))))).otherwise(found))
    kinds = F.filter(found["kind"], lambda x: x.isNotNull())
    return rows.select(
        *[(F.when(F.size(kinds) > 0, F.array_join(found["text"], "")).otherwise(text).alias(c)
           if c == "text" else F.col(f"`{c}`")) for c in docs.columns if c != "pii_kinds"],
        F.coalesce(kinds, F.array().cast("array<string>")).alias("pii_kinds"))


def reveal(docs: DataFrame, key: str) -> DataFrame:
    """The texts before ``pseudonymise`` under the same key."""
    return pseudonymise(docs, key, reverse=True)
