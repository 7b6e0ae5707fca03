"""Pseudonyms that keep the format of what they replace, by Feistel permutations in Spark expressions.

A value is read as a number below a * b, split into a digit modulo a and one modulo b; in each round
one of the two is shifted by a keyed hash of the other. That is a permutation whatever the hash, so
different values stay different, equal values stay linked across documents, and the key gives them back.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.columns import free_name

ROUNDS = 8

#: Latin letters and digits, also beyond ASCII, inside a character class.
_LATIN = r"A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
#: What is looked for. Java regular expressions; capturing groups are not used.
KINDS = {
    "email": rf"(?<![{_LATIN}._%+\-])[{_LATIN}._%+\-]{{1,64}}+@[{_LATIN}\-]{{1,63}}(?:\.[{_LATIN}\-]{{1,63}}){{1,8}}",
    "secret": r"(?i:password|passwd|secret|token|api_key) ?[=:] ?[\"']?(?=[A-Za-z+/_\-]{0,127}\d)[A-Za-z0-9+/_\-]{8,128}",
    "date": r"(?<![\d\-])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d\-])",
    "phone": r"(?<![\d.])(?:\+1[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[ .\-]\d{4}(?!\d)",
    "phone_abroad": r"(?<![\d+])\+(?=[2-9](?:[ .\-/()]{0,2}\d){7,14}(?![ .\-/()]{0,2}\d))\d{1,3}(?:[ .\-/]?\(?\d{1,4}\)?){2,5}(?!\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d\d-\d{4}(?![\d\-])",
    "card": r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)",
}
_NUMBERS = "|".join(KINDS[name] for name in ("date", "phone", "phone_abroad", "ip", "ssn", "card"))
#: Without an @ in the text; a look at the next character spares most places the full attempt.
_REST = f"(?=[pstaPSTA])(?:{KINDS['secret']})|(?=[\\d(+])(?:{_NUMBERS})"
#: All kinds.
ANY = f"{KINDS['email']}|{_REST}"
#: What every match has at least one of.
SOME = "[0-9@]"
#: Letters and digits that may stand for one another: the classes of _LATIN.
ALPHABETS = (
    "".join(chr(c) for first, last in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F)) for c in range(first, last + 1)),
    *(string.digits, string.ascii_uppercase, string.ascii_lowercase),
)
_FIRST_DAY = "DATE '1900-01-01'"
#: Days from 1900-01-01 to 2099-12-31, as 17 * 4297.
_DAYS = (17, 4297)


def _digest(key: str, name: str, rnd: int, value: Column, size: Column) -> Column:
    """A keyed number from 0 to 2**60 - 1."""
    text = F.concat_ws("/", F.lit(f"{key}/{name}/{rnd}"), size.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(value: Column, a: Column, b: Column, key: str, name: str, back: bool = False) -> Column:
    """Permute ``value`` among the numbers below a * b (at most 2**62)."""
    state = F.struct(((value - F.pmod(value, b)).cast("decimal(38,0)") / b).cast("long").alias("x"), F.pmod(value, b).alias("y"))
    sign = -1 if back else 1
    start = F.array(state)
    for rnd in reversed(range(ROUNDS)) if back else range(ROUNDS):
        start = F.transform(start, _round(a, b, key, name, rnd, sign))
    return F.element_at(F.transform(start, lambda s: s["x"] * b + s["y"]), 1)


def _round(a: Column, b: Column, key: str, name: str, rnd: int, sign: int) -> Callable[[Column], Column]:
    def shift(value: Column, other: Column, below: Column) -> Column:
        return F.pmod(value + sign * F.pmod(_digest(key, name, rnd, other, a * b), below), below)

    if rnd % 2:
        return lambda s: F.struct(s["x"].alias("x"), shift(s["y"], s["x"], b).alias("y"))
    return lambda s: F.struct(shift(s["x"], s["y"], a).alias("x"), s["y"].alias("y"))


def permute_digits(digits: Column, key: str, name: str, back: bool = False) -> Column:
    """Permute a string of 1 to 18 digits among those of its length."""
    n = F.length(digits)
    b = F.pow(F.lit(10.0), F.floor(n / 2)).cast("long")
    a = F.pow(F.lit(10.0), n - F.floor(n / 2)).cast("long")
    return F.lpad(feistel(digits.cast("long"), a, b, key, name, back).cast("string"), n, "0")


def luhn_digit(body: Column) -> Column:
    """The check digit that makes ``body`` a valid card number."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(body), ""), lambda d, i: F.when(i % 2 == 1, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int"))),
        F.lit(0), lambda s, d: s + d,
    )
    return F.pmod(-total, F.lit(10)).cast("string")


def refill(pattern: Column, digits: Column) -> Column:
    """Put ``digits`` in the places of the digits of ``pattern``, in order; at most one a place."""
    marks = F.split(pattern, "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        marks, start,
        lambda s, c: F.when(c.between("0", "9"), F.struct(F.concat(s["out"], F.substring(digits, s["at"], 1)).alias("out"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )


def kind_of(found: Column) -> Column:
    """The kind of a match of ANY, or null if it is no valid value of its kind."""
    digits = F.regexp_replace(found, r"\D", "")
    octets = F.transform(F.split(found, r"\."), lambda o: o.cast("int"))
    is_ = {name: found.rlike(f"^(?:{pattern})$") for name, pattern in KINDS.items()}
    days = F.datediff(F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).cast("date"), F.expr(_FIRST_DAY))
    valid = {
        "email": F.lit(True),
        "secret": F.lit(True),
        "date": days.isNotNull() & (days >= 0) & (days < _DAYS[0] * _DAYS[1]),
        "phone": F.lit(True),
        "phone_abroad": F.lit(True),
        "ip": F.forall(octets, lambda o: o <= 255),
        "ssn": ~digits.rlike("^(000|666|9)|^...00|0000$"),
        "card": (F.length(digits) >= 13) & (F.length(digits) <= 19) & (luhn_digit(digits.substr(F.lit(1), F.length(digits) - 1)) == F.substring(digits, -1, 1)),
    }
    out = F.lit(None).cast("string")
    for name in reversed(KINDS):
        out = F.when(is_[name] & valid[name], F.lit(name)).otherwise(out)
    return out


def permute_letters(text: Column, key: str, name: str, back: bool = False) -> Column:
    """Permute a string of at most 128 characters among those with the same alphabet at each place.

    A Feistel network over its two halves: in each round the places of one half move on in their
    alphabets by a keyed hash of the other half. Characters of no alphabet stay.
    """
    half = F.floor(F.length(text) / 2).cast("int")
    parts = F.struct(text.substr(F.lit(1), half).alias("x"), text.substr(half + 1, F.length(text)).alias("y"))
    start = F.array(parts)
    for rnd in reversed(range(ROUNDS)) if back else range(ROUNDS):
        start = F.transform(start, _letter_round(key, name, rnd, -1 if back else 1))
    return F.element_at(F.transform(start, lambda s: F.concat(s["x"], s["y"])), 1)


def _letter_round(key: str, name: str, rnd: int, sign: int) -> Callable[[Column], Column]:
    def moved(half: Column, other: Column) -> Column:
        stream = F.sha2(F.concat_ws("/", F.lit(f"{key}/{name}/{rnd}"), F.length(half).cast("string"), other), 512)
        pairs = F.zip_with(F.split(half, ""), F.split(F.regexp_replace(stream, "(..)", "$1 "), " "), lambda c, h: F.struct(c.alias("c"), h.alias("h")))
        return F.array_join(F.transform(F.slice(pairs, 1, F.length(half)), lambda p: _moved_letter(p["c"], sign * F.conv(p["h"], 16, 10).cast("int"))), "")

    if rnd % 2:
        return lambda s: F.struct(s["x"].alias("x"), moved(s["y"], s["x"]).alias("y"))
    return lambda s: F.struct(moved(s["x"], s["y"]).alias("x"), s["y"].alias("y"))


def _moved_letter(letter: Column, by: Column) -> Column:
    out = letter
    for alphabet in ALPHABETS:
        at = F.instr(F.lit(alphabet), letter)
        out = F.when(at > 0, F.substring(F.lit(alphabet), F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
    return out


def pseudonym(found: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid value; anything else is given back as it is."""
    digits = F.regexp_replace(found, r"\D", "")
    octets = F.transform(F.split(found, r"\."), lambda o: o.cast("long"))
    address = F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o)
    moved = feistel(address, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    dotted = F.concat_ws(".", *(F.pmod(F.shiftright(moved, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)))
    days = F.datediff(F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).cast("date"), F.expr(_FIRST_DAY)).cast("long")
    day = feistel(days, F.lit(_DAYS[0]).cast("long"), F.lit(_DAYS[1]).cast("long"), key, "date")
    # Area and exchange of a phone number keep their first digits, so the result is one again.
    national = F.substring(digits, -10, 10)
    free = F.concat(F.substring(national, 2, 2), F.substring(national, 5, 6))
    mixed = permute_digits(free, key, "phone")
    phone = F.concat(F.substring(national, 1, 1), F.substring(mixed, 1, 2), F.substring(national, 4, 1), F.substring(mixed, 3, 6))
    whole_phone = F.concat(F.when(F.length(digits) > 10, F.lit("1")).otherwise(F.lit("")), phone)
    # Numbers of other countries keep two digits, which begin with the country.
    abroad = F.concat(F.substring(digits, 1, 2), permute_digits(digits.substr(F.lit(3), F.length(digits)), key, "phone_abroad"))
    body = digits.substr(F.lit(1), F.length(digits) - 1)
    card_body = permute_digits(body, key, "card")
    card = F.concat(card_body, luhn_digit(card_body))
    at = F.instr(found, "@")
    email = F.concat(permute_letters(found.substr(F.lit(1), at - 1), key, "email"), found.substr(at, F.length(found)))
    secret_head = F.regexp_extract(found, r"^(?i:password|passwd|secret|token|api_key) ?[=:] ?[\"']?", 0)
    secret_body = found.substr(F.length(secret_head) + 1, F.length(found))
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", F.concat(secret_head, permute_letters(secret_body, key, "secret")))
        .when(kind == "date", F.date_format(F.date_add(F.expr(_FIRST_DAY), day.cast("int")), "yyyy-MM-dd"))
        .when(kind == "phone", refill(found, whole_phone))
        .when(kind == "phone_abroad", refill(found, abroad))
        .when(kind == "ip", dotted)
        .when(kind == "ssn", refill(found, _ssn(digits, key)))
        .when(kind == "card", refill(found, card))
        .otherwise(found)
    )


def _ssn(digits: Column, key: str) -> Column:
    """Area, group and serial number each within what is valid: 1-665 or 667-899, 1-99, 1-9999."""
    area = digits.substr(1, 3).cast("long")
    area = F.when(area > 666, area - 2).otherwise(area - 1)
    rest = (digits.substr(4, 2).cast("long") - 1) * 9999 + digits.substr(6, 4).cast("long") - 1
    moved = feistel(area * (99 * 9999) + rest, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), key, "ssn")
    new_rest = F.pmod(moved, F.lit(99 * 9999))
    new_area = ((moved - new_rest) / (99 * 9999)).cast("long")
    new_area = F.when(new_area >= 665, new_area + 2).otherwise(new_area + 1)
    group = F.floor(new_rest / 9999).cast("long") + 1
    return F.concat(F.lpad(new_area.cast("string"), 3, "0"), F.lpad(group.cast("string"), 2, "0"), F.lpad((F.pmod(new_rest, F.lit(9999)) + 1).cast("string"), 4, "0"))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` rewritten and one more column, ``pii``: (kind, pseudonym) of each
    replaced value, in the order of the text.

    Valid values are e-mail addresses, secrets behind a name (in any case), dates of 1900 to 2099, North American
    phone numbers, those of other countries with + and 8 to 15 digits, IPv4 addresses, social security numbers and card numbers with a right check digit.
    Whoever has ``key`` can undo the permutations; it has no default. Numbers and dates are permuted within their format, the names before the @ and secrets
    letter by letter within their alphabets, so different values get different pseudonyms (a value may be its own). All else stays as it is, so does a null text (``pii`` is then
    empty). Rows are handled one by one: ties, repeated rows and other columns do not matter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    with_at = text.contains("@")
    found = (
        F.when(with_at, F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)))
        .when(text.rlike(SOME), F.regexp_extract_all(text, F.lit(f"({_REST})"), F.lit(1)))
        .otherwise(F.array().cast("array<string>"))
    )
    # Only the few texts with a match are cut up; the array of pieces is one longer than that of matches.
    at_found, at_new, at_gaps = (free_name(docs, x) for x in ("_found", "_new", "_gaps"))
    matched = docs.withColumn(at_found, found)
    gaps = F.when(with_at, F.split(text, ANY, -1)).otherwise(F.split(text, _REST, -1))
    kinds = F.transform(at_found, lambda m: F.struct(m.alias("old"), kind_of(m).alias("kind")))
    swapped = F.transform(kinds, lambda m: F.struct(m["kind"].alias("kind"), pseudonym(m["old"], m["kind"], key).alias("new")))
    cut = matched.withColumn(at_new, F.when(F.size(at_found) > 0, swapped)).withColumn(at_gaps, F.when(F.size(at_found) > 0, gaps))
    pieces = F.concat(
        F.array(F.element_at(at_gaps, 1)),
        F.flatten(F.transform(F.sequence(F.lit(1), F.size(at_found)), lambda i: F.array(F.element_at(at_new, i)["new"], F.element_at(at_gaps, i + 1)))),
    )
    spans = F.transform(F.filter(at_new, lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["kind"].alias("kind"), m["new"].alias("pseudonym")))
    empty = F.array().cast("array<struct<kind: string, pseudonym: string>>")
    return cut.withColumns(
        {"text": F.when(F.size(at_found) > 0, F.array_join(pieces, "")).otherwise(F.col("text")), "pii": F.when(F.size(at_found) > 0, spans).otherwise(empty)}
    ).drop(at_found, at_new, at_gaps)
