"""Format-preserving pseudonyms for personal numbers and dates, with SQL functions only.

Values are found by one pattern and validated: payment cards (Luhn), IBANs (mod 97), social security numbers,
phone numbers, IPv4 addresses, e-mail addresses and calendar dates. Each is permuted by a keyed Feistel network
over its own domain: a row of digits of mixed radix, one half of which is shifted by a keyed hash of the other, round by
round. So equal values get equal pseudonyms in every document, in whichever of the formats below they are written, different
values of one kind different ones, and who has the key can undo it (`undo=True`).

- Cards keep length, grouping and first digit and get a new check digit. IBANs keep country and shape and get new check digits.
- Social security numbers stay in the valid areas, groups and serials; IPv4 octets stay octets.
- IBANs are written whole or in groups of four; phone numbers with + and 8 to 15 digits in groups of up to four, or as (nnn) nnn-nnnn.
- Phone numbers keep the country code and the marks; e-mail addresses keep shape and domain.
- Dates of 1900 to 2099 become other dates of 1900 to 2099 in the same format: 2024-02-29, 2024/02/29, 29.02.2024, 02/29/2024.

What stays in clear text: dates with a slash whose first number is the day and above 12 (31/12/2020; a pseudonym could not be told from
month first when undone), dates with names of months, phone numbers without + or brackets, IPv6 addresses, names.
Numbers that fail their check stay as they are. A text is one row's work; nothing is shuffled.

Defined cases: NULL stays NULL with no findings, empty texts stay empty. Repeated rows give repeated results. Other columns
pass through unread. The key is a parameter; the default is for tests and trial runs only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let

# Patterns in the order they are tried; each is whole, not inside a longer number or word.
KINDS = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}"),
    ("iban", r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"),
    ("date", r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}"),
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}"),
    ("ssn", r"\d{3}-\d{2}-\d{4}"),
    ("phone", r"\+\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,5}|\(\d{3}\) ?\d{3}-\d{4}"),
    ("card", r"\d(?:[ -]?\d){12,18}"),
)
_EDGE = r"(?<![\w.+@-])"
_NOT_IN_PATH = r"(?<!/)"
_END = r"(?![\w@])(?![.-]\d)"
# An address may follow a slash, as in http://10.0.0.1/; other numbers there are parts of paths.
PATTERN = _EDGE + "(?:" + "|".join(f"(?:{'' if k == 'ip' else _NOT_IN_PATH}(?:{p}))" for k, p in KINDS) + ")" + _END
MAYBE = r"[0-9]{2}|@"

DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "MM/dd/yyyy")
FIRST_DAY, DAYS = "1900-01-01", (319, 229)  # 319 * 229 days are the years 1900 to 2099


@dataclass(frozen=True)
class PseudonymOptions:
    key: str = "trial key"
    rounds: int = 8


def _ints(*values: int) -> Column:
    return F.array(*[F.lit(v) for v in values])


def feistel(values: Column, radices: Column, tweak: str, options: PseudonymOptions, undo: bool = False) -> Column:
    """A keyed permutation of all rows of digits `values` below `radices` (arrays of int of one size)."""

    def permute(bound: Column) -> Column:
        half = F.floor(F.size(bound["values"]) / 2).cast("int")
        rounds = range(options.rounds)

        def turn(state: Column, number: Column) -> Column:
            lower = number % 2 == 1

            def shifted(side: Column) -> Column:
                def digit(value: Column, place: Column) -> Column:
                    seed = F.concat_ws(
                        "|", F.lit(options.key), F.lit(tweak), F.size(state).cast("string"),
                        number.cast("string"), place.cast("string"), side,
                    )
                    amount = F.conv(F.substring(F.sha2(seed, 256), 1, 12), 16, 10).cast("bigint")
                    moved = value - amount if undo else value + amount
                    new = F.pmod(moved, F.get(bound["radices"], place).cast("bigint")).cast("int")
                    return F.when((place < half) == lower, new).otherwise(value)

                return F.transform(state, digit)

            other = F.array_join(
                F.transform(
                    F.when(lower, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, F.lit(1), half)),
                    lambda v: v.cast("string"),
                ),
                ",",
            )
            return let(other, shifted)

        order = reversed(rounds) if undo else rounds
        return F.aggregate(_ints(*order), bound["values"], turn)

    return let(F.struct(values.alias("values"), radices.alias("radices")), permute)


def _code(char: Column) -> Column:
    """Value, radix and base of a character: digits and letters of one case keep their kind, others stay."""
    code = F.ascii(char)
    digit, upper, lower = F.rlike(char, F.lit("[0-9]")), F.rlike(char, F.lit("[A-Z]")), F.rlike(char, F.lit("[a-z]"))
    base = F.when(digit, 48).when(upper, 65).when(lower, 97)
    return F.struct(
        F.coalesce(code - base, F.lit(0)).alias("value"),
        F.when(digit, 10).when(upper | lower, 26).otherwise(1).alias("radix"),
        base.alias("base"),
        char.alias("char"),
    )


def permuted(text: Column, tweak: str, options: PseudonymOptions, undo: bool) -> Column:
    """Letters and digits of an ASCII string permuted within their kind, all else in place."""

    def rebuilt(codes: Column) -> Column:
        new = feistel(F.transform(codes, lambda c: c["value"]), F.transform(codes, lambda c: c["radix"]), tweak, options, undo)
        return F.array_join(
            F.transform(
                F.arrays_zip(codes.alias("old"), new.alias("new")),
                lambda z: F.when(z["old"]["base"].isNull(), z["old"]["char"]).otherwise(
                    F.char(z["old"]["base"] + z["new"])
                ),
            ),
            "",
        )

    return let(F.transform(F.split(text, ""), _code), rebuilt)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced, one by one, by `digits`."""

    def fill(state: Column, char: Column) -> Column:
        is_digit = F.rlike(char, F.lit("[0-9]"))
        new = F.when(is_digit, F.substring(digits, state["used"] + 1, F.lit(1))).otherwise(char)
        return F.struct(
            (state["used"] + is_digit.cast("int")).alias("used"), F.concat(state["text"], new).alias("text")
        )

    zero = F.struct(F.lit(0).alias("used"), F.lit("").alias("text"))
    return F.aggregate(F.split(shape, ""), zero, fill)["text"]


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Luhn sum of a digit string; `doubled_from_right` is 1 with a check digit at the end, 0 without."""

    def add(total: Column, pair: Column) -> Column:
        value = pair["digit"].cast("int")
        twice = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
        return total + F.when(pair["place"] % 2 == doubled_from_right, twice).otherwise(value)

    chars = F.split(F.reverse(digits), "")
    placed = F.transform(chars, lambda c, i: F.struct(c.alias("digit"), i.alias("place")))
    return F.aggregate(placed, F.lit(0), add)


def _card(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    def changed(digits: Column) -> Column:
        body = F.concat(
            F.substring(digits, 1, 1),
            permuted(F.substring(digits, F.lit(2), F.length(digits) - 2), "card", options, undo),
        )
        full = let(body, lambda b: F.concat(b, F.pmod(-_luhn_sum(b, 0), F.lit(10)).cast("string")))
        return F.when(F.length(digits).between(13, 19) & (_luhn_sum(digits, 1) % 10 == 0), _refilled(value, full))

    return let(_digits(value), changed)


def _mod97(text: Column) -> Column:
    """The remainder of an IBAN part read as a number, letters as 10 to 35."""

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + (code - 48)) % 97).otherwise((rest * 100 + (code - 55)) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    def changed(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
        valid = F.length(plain).between(15, 34) & (_mod97(F.concat(account, country, F.substring(plain, 3, 2))) == 1)

        def whole(new: Column) -> Column:
            check = F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))
            return F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)

        written = let(permuted(account, "iban", options, undo), whole)
        in_fours = F.rtrim(F.regexp_replace(written, "(.{4})", "$1 "))
        return F.when(valid, F.when(F.contains(value, F.lit(" ")), in_fours).otherwise(written))

    return let(F.replace(value, F.lit(" "), F.lit("")), changed)


def _date(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    def moved(form: str) -> Callable[[Column], Column]:
        def change(day: Column) -> Column:
            number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
            halves = F.array(F.floor(number / DAYS[1]).cast("int"), F.pmod(number, F.lit(DAYS[1])))
            new = feistel(halves, _ints(*DAYS), "date", options, undo)
            shifted = let(new, lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(n, F.lit(0)) * DAYS[1] + F.get(n, F.lit(1))))
            inside = number.between(0, DAYS[0] * DAYS[1] - 1)
            return F.when(inside, F.date_format(shifted, form))

        return change

    options_of = [
        let(F.to_date(F.try_to_timestamp(value, F.lit(form))), moved(form)) for form in DATE_FORMATS
    ]
    shapes = [r"\A\d{4}-", r"\A\d{4}/", r"\A\d{2}\.", r"\A\d{2}/"]
    found = F.lit(None).cast("string")
    for shape, new in zip(shapes, options_of, strict=True):
        found = F.when(F.rlike(value, F.lit(shape)), new).otherwise(found)
    return found


def _numbers(value: Column, mark: str) -> Column:
    return F.transform(F.split(value, mark), lambda v: v.cast("int"))


def _ip(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    def change(octets: Column) -> Column:
        new = feistel(octets, _ints(256, 256, 256, 256), "ip", options, undo)
        plain = F.forall(F.split(value, r"\."), lambda v: ~F.rlike(v, F.lit(r"\A0\d")))
        valid = plain & F.forall(octets, lambda v: v < 256)
        return F.when(valid, F.array_join(F.transform(new, lambda v: v.cast("string")), "."))

    return let(_numbers(value, r"\."), change)


def _ssn(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999, each counted from 0."""

    def change(parts: Column) -> Column:
        area, group, serial = (F.get(parts, F.lit(k)) for k in range(3))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        counted = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)

        def written(new: Column) -> Column:
            a, g, s = (F.get(new, F.lit(k)) + 1 for k in range(3))
            a = F.when(a >= 666, a + 1).otherwise(a)
            sizes = ((a, 3), (g, 2), (s, 4))
            return F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in sizes])

        return F.when(valid, let(feistel(counted, _ints(898, 99, 9999), "ssn", options, undo), written))

    return let(_numbers(value, "-"), change)


def _phone(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    code = F.regexp_extract(value, r"\A\+\d{1,3}(?=[^0-9])", 0)

    def change(prefix: Column) -> Column:
        rest = F.substring(value, F.length(prefix) + 1, F.length(value))
        new = F.concat(prefix, _refilled(rest, permuted(_digits(rest), "phone", options, undo)))
        return F.when(F.length(_digits(value)).between(8, 15), new)

    return let(code, change)


def _email(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(permuted(local, "email", options, undo), F.substring(value, F.length(local) + 1, F.length(value)))


_CHANGE = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def _changed(value: Column, options: PseudonymOptions, undo: bool) -> Column:
    """(kind, new text) of a found value; both NULL if it fails its check."""
    kind, new = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, shape in reversed(KINDS):
        is_kind = F.rlike(value, F.lit(rf"\A(?:{shape})\z"))
        new = F.when(is_kind, _CHANGE[name](value, options, undo)).otherwise(new)
        kind = F.when(is_kind, F.lit(name)).otherwise(kind)
    return let(new, lambda n: F.struct(F.when(n.isNotNull(), kind).alias("kind"), n.alias("new")))


def with_pseudonyms(
    df: DataFrame, text: str = "text", options: PseudonymOptions = PseudonymOptions(), undo: bool = False
) -> DataFrame:
    """`df` with `text` rewritten, and `_found`, the kinds of the values replaced, in order."""
    given = F.col(text)
    found = F.when(
        F.rlike(given, F.lit(MAYBE)) & F.rlike(given, F.lit(PATTERN)),
        F.transform(F.regexp_extract_all(given, F.lit(PATTERN), 0), lambda v: F.struct(v.alias("old"), _changed(v, options, undo).alias("made"))),
    )
    gaps = F.split(given, PATTERN, -1)
    pieces = F.transform(
        F.arrays_zip(gaps.alias("gap"), F.col("_values").alias("value")),
        lambda p: F.concat(p["gap"], F.coalesce(p["value"]["made"]["new"], p["value"]["old"], F.lit(""))),
    )
    kinds = F.filter(F.transform("_values", lambda v: v["made"]["kind"]), lambda k: k.isNotNull())
    return (
        df.withColumn("_values", found)
        .withColumn(text, F.when(F.col("_values").isNull(), given).otherwise(F.array_join(pieces, "")))
        .withColumn("_found", F.coalesce(kinds, F.expr("cast(array() as array<string>)")))
        .drop("_values")
    )
