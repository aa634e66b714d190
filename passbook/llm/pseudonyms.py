"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Values are found by pattern and checked (Luhn for cards, mod 97 for IBANs, the calendar, octets, number ranges).
Each is permuted within its own format by a keyed Feistel network: the digits are two halves, which in turn
are shifted by a keyed hash of the other half, modulo the half's own range. Such a network maps the
valid values of a format one to one onto each other: a card stays a card with a right check digit, a
date stays a date, and separators stay where they are. The same value gets the same pseudonym in every
document and in every notation, so records stay linked; without the key it cannot be undone. Dates keep one
thing: whether their day is above 12, because a pseudonym written month first is read day first otherwise.

Only SQL functions are used. The text is cut at the matches and put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.columns import quoted, spare

ROUNDS = 8
KEY = "change-me"

# Notations and ranges of the formats. An email gives labels back, since a full stop may follow it; a name has
# 127 labels at most.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,24}+(?![A-Za-z0-9-])"
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![0-9A-Za-z])"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LENGTHS = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}(?![0-9A-Za-z])" for n, c in IBAN_LENGTHS.items())
_OPEN_IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){2,6}(?: ?[0-9]{1,4})?(?![0-9A-Za-z])"
IBAN = rf"(?<![0-9A-Za-z])(?:{_LENGTHS}|{_OPEN_IBAN})"
ISO_DATE = r"(?:(?<![0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9/])(?:19|20)[0-9]{2}/[0-9]{2}/[0-9]{2}(?![0-9/]))"
DAY_DATE = (
    r"(?:(?<![0-9./])[0-9]{1,2}([./])[0-9]{1,2}\1(?:19|20)[0-9]{2}(?![0-9./]*[0-9])"
    r"|(?<![0-9-])[0-9]{1,2}-[0-9]{1,2}-(?:19|20)[0-9]{2}(?![0-9-]))"
)
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9])"
)
CARD = r"(?<![0-9A-Za-z+.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
#: In this order: what matches several counts as the first. Group 1 of DAY_DATE is renumbered by name.
KINDS = {
    "email": EMAIL, "secret": SECRET, "iban": IBAN, "iso_date": ISO_DATE,
    "day_date": DAY_DATE.replace("([./])", "(?<mark>[./])").replace(r"\1", r"\k<mark>"),
    "ip": IP, "ssn": SSN, "phone": PHONE, "card": CARD,
}
ANY = "|".join(KINDS.values())
NOT_CARD = "|".join(v for k, v in KINDS.items() if k != "card")
# What a card may be within a longer row of numbers that is none: its issuer's digits, and groups as printed on cards.
_BEFORE, _AFTER = r"(?<![0-9A-Za-z+.-])", r"(?![0-9A-Za-z])"
GROUPED = [
    rf"{_BEFORE}(?=((?:[3-689]|2[2-7])(?:{groups}){_AFTER}))"
    for groups in (
        "[0-9]{12,18}", "[0-9]{2,3}(?:[ -][0-9]{4}){3}", "[0-9]{2,3}(?:[ -][0-9]{4}){3}[ -][0-9]{1,3}",
        "[0-9]{2,3}(?:[ -][0-9]{4}){2}[ -][0-9]{1,3}", "[0-9]{2,3}[ -][0-9]{6}[ -][0-9]{4,5}", "[0-9]{2,3}(?:[ -][0-9]{3}){3}",
    )
]
FIRST_DAY = "1900-01-01"
MONTHS = 2400  # to 2099-12-31
EARLY = (160, 180)  # MONTHS * 12 days up to the twelfth of a month
LATE, LATE_GRID = 44_249, (17, 2603)  # the other days; the grid has two places more


def _keyed(key: str, tweak: str, step: Column, value: Column) -> Column:
    """A 60-bit number from a keyed hash."""
    text = F.concat_ws("|", F.lit(key), F.lit(tweak), step.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permuted_pair(a: Column, b: Column, range_a: Column, range_b: Column, key: str, tweak: str) -> Column:
    """The struct ``(a, b)`` permuted within range_a x range_b."""
    ranges = F.struct(range_a.cast("long").alias("a"), range_b.cast("long").alias("b"))
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(state: Column, k: Column) -> Column:
        left = F.pmod(state["a"] + F.pmod(_keyed(key, tweak, k, state["b"]), ranges["a"]), ranges["a"])
        right = F.pmod(state["b"] + F.pmod(_keyed(key, tweak, k, state["a"]), ranges["b"]), ranges["b"])
        return F.struct(
            F.when(k % 2 == 0, left).otherwise(state["a"]).alias("a"), F.when(k % 2 == 0, state["b"]).otherwise(right).alias("b")
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """A string of 1 to 36 digits permuted within its length."""
    size = F.length(digits)
    cut = F.floor(size / 2).cast("int")
    low = F.when(cut > 0, F.substring(digits, F.lit(1), cut).cast("long")).otherwise(F.lit(0))
    high = F.substring(digits, cut + 1, size).cast("long")
    ten = F.lit(10.0)
    pair = permuted_pair(low, high, F.pow(ten, cut), F.pow(ten, size - cut), key, tweak)
    left = F.when(cut > 0, F.lpad(pair["a"].cast("string"), cut, "0")).otherwise(F.lit(""))
    return F.concat(left, F.lpad(pair["b"].cast("string"), size - cut, "0"))


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refilled(value: Column, digits: Column, signs: str = "[0-9]") -> Column:
    """``value`` with its digits (or other ``signs``), in order, replaced by ``digits``."""
    filled = F.aggregate(
        F.split(value, ""),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("next")),
        lambda s, c: F.when(
            c.rlike(signs),
            F.struct(F.concat(s["text"], F.substring(digits, s["next"], F.lit(1))).alias("text"), (s["next"] + 1).alias("next")),
        ).otherwise(F.struct(F.concat(s["text"], c).alias("text"), s["next"].alias("next"))),
    )
    return filled["text"]


def _weighed(digits: Column, doubled_last: bool) -> Column:
    """Luhn's sum; from the right every second digit is doubled, the last one first if so asked."""
    turned = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(
        F.transform(turned, lambda c, k: F.when(k % 2 == (0 if doubled_last else 1), c.cast("int") * 2).otherwise(c.cast("int"))),
        F.lit(0),
        lambda s, d: s + F.when(d > 9, d - 9).otherwise(d),
    )


def _is_card(value: Column) -> Column:
    digits = only_digits(value)
    return F.length(digits).between(13, 19) & (F.pmod(_weighed(digits, False), F.lit(10)) == 0)


def _card(value: Column, key: str) -> Column:
    digits = only_digits(value)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = F.pmod(F.lit(10) - F.pmod(_weighed(body, True), F.lit(10)), F.lit(10))
    return refilled(value, F.concat(body, check.cast("string")))


def _mod97(digits: Column) -> Column:
    return F.aggregate(
        F.filter(F.split(digits, ""), lambda c: c != ""), F.lit(0), lambda s, c: F.pmod(s * 10 + c.cast("int"), F.lit(97))
    )


def _numbers(value: Column) -> Column:
    """The letters as numbers, A = 10; digits stay, signs go."""
    signs = F.filter(F.split(value, ""), lambda c: c.rlike("[0-9A-Z]"))
    return F.array_join(F.transform(signs, lambda c: F.when(c.between("A", "Z"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")


def _is_iban(value: Column) -> Column:
    signs = F.translate(value, " ", "")
    body = F.substring(signs, F.lit(5), F.length(signs))
    whole = _numbers(F.concat(body, F.substring(signs, 1, 4)))
    return F.length(signs).between(15, 34) & (_mod97(whole) == 1)


def _iban(value: Column, key: str) -> Column:
    signs = F.translate(value, " ", "")
    country, old = F.substring(signs, 1, 2), F.substring(signs, F.lit(5), F.length(signs))
    lettered = permuted_letters(old, key, "iban", {k: _ALNUM[k] for k in ("digit", "upper")})
    body = F.when(old.rlike("[A-Z]"), lettered).otherwise(permuted_digits(old, key, "iban"))
    check = F.lit(98) - _mod97(_numbers(F.concat(body, country, F.lit("00"))))
    return refilled(value, F.concat(country, F.lpad(check.cast("string"), 2, "0"), body), r"[0-9A-Z]")


def _late_before(month: Column) -> Column:
    """Days after the twelfth in the months before this one, counted from the first."""
    first = F.lit(FIRST_DAY).cast("date")
    return F.datediff(F.add_months(first, month), first) - month * 12


def _permuted_number(number: Column, grid: tuple[int, int], key: str, tweak: str) -> Column:
    a, b = grid
    pair = permuted_pair(F.floor(number / b), F.pmod(number, F.lit(b)), F.lit(a), F.lit(b), key, tweak)
    return _bound(pair, lambda p: p["a"] * b + p["b"])


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _early_day(number: Column) -> Column:
    return F.date_add(F.add_months(F.lit(FIRST_DAY).cast("date"), F.floor(number / 12).cast("int")), F.pmod(number, F.lit(12)).cast("int"))


def _late_day(rank: Column) -> Column:
    """The day of a rank among the days after the twelfth; its month follows from the rank to within one."""
    guess = F.floor(rank * MONTHS / LATE).cast("int")
    near = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda k: F.struct((guess + k).alias("month"), _late_before(guess + k).alias("before")))
    at = F.array_max(F.filter(near, lambda m: m["before"] <= rank))
    return _bound(at, lambda m: F.date_add(F.add_months(F.lit(FIRST_DAY).cast("date"), m["month"]), (rank - m["before"] + 12).cast("int")))


def _day(day: Column, key: str) -> Column:
    """A day up to the twelfth becomes another such day, a later one another later one."""
    month, in_month = (F.year(day) - 1900) * 12 + F.month(day) - 1, F.dayofmonth(day)
    early = _permuted_number((month * 12 + in_month - 1).cast("long"), EARLY, key, "date")
    rank = (_late_before(month) + in_month - 13).cast("long")
    # two places of the grid are no days: walked over, which takes two steps more at most
    late = F.aggregate(
        F.sequence(F.lit(1), F.lit(2)),
        _permuted_number(rank, LATE_GRID, key, "late date"),
        lambda at, _: F.when(at < LATE, at).otherwise(_permuted_number(at, LATE_GRID, key, "late date")),
    )
    return F.when(in_month <= 12, _bound(early, _early_day)).otherwise(_bound(late, _late_day))


def _date_of(value: Column, kind: str) -> Column:
    """The date a value states, null if the calendar has no such day; the day is first if it can be."""
    if kind == "iso_date":
        return F.try_to_date(F.translate(value, "/", "-"), "yyyy-MM-dd")
    return F.coalesce(*(F.try_to_date(F.translate(value, "./", "--"), form) for form in ("d-M-yyyy", "M-d-yyyy")))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    at = [F.element_at(octets, k) for k in (1, 2, 3, 4)]
    pair = permuted_pair(at[0] * 256 + at[1], at[2] * 256 + at[3], F.lit(65536), F.lit(65536), key, "ip")
    parts = [F.floor(pair["a"] / 256), F.pmod(pair["a"], F.lit(256)), F.floor(pair["b"] / 256), F.pmod(pair["b"], F.lit(256))]
    return F.concat_ws(".", *(p.cast("long").cast("string") for p in parts))


def _is_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & ((x == "0") | ~x.startswith("0")))


def _is_ssn(value: Column) -> Column:
    area = F.substring(value, 1, 3).cast("int")
    return ~area.isin(0, 666) & (area < 900) & (F.substring(value, 5, 2) != "00") & (F.substring(value, 8, 4) != "0000")


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    # 898 areas: 001 to 899 without 666
    place = area - F.when(area > 666, 2).otherwise(1)
    pair = permuted_pair(place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")
    new = pair["a"] + F.when(pair["a"] >= 665, 2).otherwise(1)
    return F.concat_ws(
        "-",
        F.lpad(new.cast("string"), 3, "0"),
        F.lpad((F.floor(pair["b"] / 9999) + 1).cast("string"), 2, "0"),
        F.lpad((F.pmod(pair["b"], F.lit(9999)) + 1).cast("string"), 4, "0"),
    )


def _phone(value: Column, key: str) -> Column:
    """The country code stays; the number is permuted within its length."""
    code = F.regexp_extract(value, r"^(\+[0-9]{1,3})[ .(-]", 1)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, refilled(rest, permuted_digits(only_digits(rest), key, "phone")))


def _shifted(part: Column, other: Column, step: Column, key: str, tweak: str, bases: dict[str, tuple[str, int]]) -> Column:
    """Every letter and digit of ``part`` moved within its own class by a keyed hash of ``other``."""
    letters = F.filter(F.split(part, ""), lambda c: c != "")

    def moved(c: Column, k: Column) -> Column:
        shift = _keyed(key, tweak, F.concat_ws(".", step, k), other)
        out = c
        for _, (first, base) in bases.items():
            last = chr(ord(first) + base - 1)
            turned = F.chr(F.lit(ord(first)) + F.pmod(F.ascii(c) - ord(first) + F.pmod(shift, F.lit(base)), F.lit(base)))
            out = F.when(c.between(first, last), turned).otherwise(out)
        return out

    return F.array_join(F.transform(letters, moved), "")


def permuted_letters(value: Column, key: str, tweak: str, bases: dict[str, tuple[str, int]]) -> Column:
    """A string permuted within its letter classes, the two halves in turn."""
    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("a"), F.substring(value, cut + 1, F.length(value)).alias("b"))

    def step(state: Column, k: Column) -> Column:
        left = _shifted(state["a"], state["b"], k, key, tweak, bases)
        right = _shifted(state["b"], state["a"], k, key, tweak, bases)
        return F.struct(
            F.when(k % 2 == 0, left).otherwise(state["a"]).alias("a"), F.when(k % 2 == 0, state["b"]).otherwise(right).alias("b")
        )

    pair = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return F.concat(pair["a"], pair["b"])


_ALNUM = {"digit": ("0", 10), "lower": ("a", 26), "upper": ("A", 26)}
_HEX = {"digit": ("0", 10), "lower": ("a", 6), "upper": ("A", 6)}


def _email(value: Column, key: str) -> Column:
    """The name is permuted; the domain stays, so that mail of one provider can still be counted."""
    at = F.instr(value, "@")
    return F.concat(permuted_letters(F.substring(value, F.lit(1), at - 1), key, "email", _ALNUM), F.substring(value, at, F.length(value)))


def kind_of(value: Column) -> Column:
    """The kind of a match, null if its check fails."""

    def is_(kind: str) -> Column:
        return value.rlike(rf"\A(?:{KINDS[kind]})\z")

    found = F.when(is_("email"), "email").when(is_("secret") & value.rlike("[0-9]") & value.rlike("[A-Fa-f]"), "secret")
    found = found.when(is_("iban") & _is_iban(value), "iban")
    for kind in ("iso_date", "day_date"):
        found = found.when(is_(kind) & _date_of(value, kind).isNotNull(), kind)
    found = found.when(is_("ip") & _is_ip(value), "ip").when(is_("ssn") & _is_ssn(value), "ssn")
    return found.when(is_("phone"), "phone").when(is_("card") & _is_card(value), "card")


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a checked value; the value itself if ``kind`` is null."""
    iso = F.date_format(_day(_date_of(value, "iso_date"), key), "yyyy-MM-dd")
    iso = F.when(value.contains("/"), F.translate(iso, "-", "/")).otherwise(iso)
    mark = F.regexp_extract(value, "[./-]", 0)
    day_first = F.try_to_date(F.translate(value, "./", "--"), "d-M-yyyy").isNotNull()
    # a date with a part of one digit is written without zeros
    short = ~value.rlike("^[0-9]{2}[./-][0-9]{2}[./-]")
    form = F.when(day_first, F.when(short, "d/M/yyyy").otherwise("dd/MM/yyyy")).otherwise(F.when(short, "M/d/yyyy").otherwise("MM/dd/yyyy"))
    day = F.replace(F.call_function("date_format", _day(_date_of(value, "day_date"), key), form), F.lit("/"), mark)
    return (
        F.when(kind == "email", _email(value, key))
        .when(kind == "secret", permuted_letters(value, key, "secret", _HEX))
        .when(kind == "iban", _iban(value, key))
        .when(kind == "iso_date", iso)
        .when(kind == "day_date", day)
        .when(kind == "ip", _ip(value, key))
        .when(kind == "ssn", _ssn(value, key))
        .when(kind == "phone", _phone(value, key))
        .when(kind == "card", _card(value, key))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, text_column: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with ``text_column`` rewritten, and the kinds replaced in it as ``pseudonym_kinds`` (array).

    A null text stays null with an empty list; texts without a checked value stay as they are to the
    character. Repeated rows are rewritten alike; an empty table gives an empty one. Texts of any length are
    read whole; matches do not overlap, and of kinds that match at one place the first of ``KINDS`` counts. If
    ``docs`` has a column ``pseudonym_kinds``, the new one gets an underscore in front; other columns stay.
    """
    found, kinds, cards = spare(docs, "pseudonym_found", "pseudonym_kinds", "pseudonym_cards")
    text, none = quoted(text_column), F.array().cast("array<string>")
    rows = docs.withColumn(found, F.coalesce(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), none))
    # a row of numbers that is no card as a whole may hold one: then the cards are matched as they are, and the
    # rest of the row is free for other kinds
    failed = F.exists(found, lambda m: (F.length(only_digits(m)) >= 13) & kind_of(m).isNull())
    inner = F.concat(*(F.filter(F.regexp_extract_all(text, F.lit(g), F.lit(1)), _is_card) for g in GROUPED))
    whole = F.filter(found, lambda m: kind_of(m) == "card")
    some_inner = F.when(failed, inner).otherwise(none)
    rows = rows.withColumn(cards, some_inner)
    # of cards that start alike the longer one is tried first
    rows = rows.withColumn(cards, F.when(F.size(cards) > 0, F.sort_array(F.array_distinct(F.concat(cards, whole)), asc=False)))
    pattern = F.concat(F.lit(f"{_BEFORE}(?:"), F.array_join(cards, "|"), F.lit(f"){_AFTER}|{NOT_CARD}"))
    several = F.col(cards).isNotNull()
    rows = rows.withColumn(found, F.when(several, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.col(found)))
    rows = rows.withColumn(found, F.transform(found, lambda m: F.struct(m.alias("value"), kind_of(m).alias("kind"))))
    pieces = F.when(several, F.split(text, pattern)).otherwise(F.split(text, ANY))
    filled = F.concat(F.transform(found, lambda m: pseudonym(m["value"], m["kind"], key)), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(pieces, filled, lambda a, b: F.concat(a, b)), "")
    some = F.exists(found, lambda m: m["kind"].isNotNull())
    new = F.when(some, joined).otherwise(text)
    names = F.filter(F.transform(found, lambda m: m["kind"]), lambda k: k.isNotNull())
    columns = [new.alias(c) if c == text_column else quoted(c) for c in docs.columns]
    return rows.select(*columns, names.alias(kinds))
