"""Format-preserving pseudonyms of personal data by keyed Feistel networks."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_YEAR, YEARS, CYCLE_DAYS = 1700, 400, 146_097  # one Gregorian cycle
LEAP_DAYS = 97
SSN_AREAS, SSN_GROUPS, SSN_SERIALS = 898, 99, 9999  # 001 to 899 without 666, 01 to 99, 0001 to 9999
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "date": r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w/-]|\.\d)",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": (
        r"(?<![\w(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
        r"|(?<![\w+])\+[1-9](?:[ .-]?(?:\(\d{1,4}\)|\d)){6,14}(?![\w-])"
        r"|(?<![\w.,+/-])(?:\d{10}(?![\w/-]|[.,]\d)|0\d{1,4}(?:[ ./-]\d{2,8}){1,4}(?![\w/-]|\.\d))"
    ),
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
DATE = r"^(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})$"
DATE_FORMS = {r"^\d{4}-": "yyyy-M-d", r"^\d{1,2}\.": "d.M.yyyy", r"^\d{1,2}/": "M/d/yyyy"}  # two digits are read as well
DAY_FIRST = "d/M/yyyy"
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())


def pseudonymise(
    docs: DataFrame, key: str, text_col: str = "text", rounds: int = ROUNDS, day_first: bool = False
) -> DataFrame:
    """All rows and columns, the text with pseudonyms, plus ``found``: how many were replaced, per kind.

    E-mail addresses, IPv4 addresses, IBANs, dates, social security numbers, telephone numbers and card numbers are
    looked for in whole texts. With ``day_first``, a slash date that is none with the month first is read with the day
    first. What does not validate (an octet above 255, a day that no calendar has, a wrong check digit) stays as it is. A value is
    permuted among the values of its own format by a Feistel network keyed with ``key``, so equal values get equal
    pseudonyms in every document and different ones stay different; separators and length stay, cards keep a right
    check digit and IBANs right check digits, and social security numbers stay valid ones. Dates stay dates of the 400
    years from 1700 and keep the width of their day and month; dates written with two digits each are linked across the
    forms, those with one digit, and slash dates that can only have the day first, among their like. Ten digits alone are
    a telephone number if the first is 2 or more, and stay one; time stamps and book numbers that begin with 0 or 1 stay.

    A null text stays null and finds nothing; texts without a candidate are not touched; repeated rows are treated
    alike. A column called ``found``, in any case, is replaced. No rows are exchanged.
    """
    text = F.col(f"`{text_col}`")
    kept = [name for name in docs.columns if name.lower() != "found"]
    listing = "_values"
    while listing in {name.lower() for name in kept}:
        listing += "_"
    # every pattern needs a digit or an at sign, which one quick pass finds out for most texts
    values = F.when(F.rlike(text, F.lit("[0-9@]")), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    values = F.coalesce(values, F.array().cast("array<string>"))
    listed = docs.select(
        *[F.col(f"`{name}`") for name in kept],
        F.transform(values, lambda value: _with_kind(value, day_first)).alias(listing),
    ).withColumn(listing, F.transform(listing, lambda one: _replaced(one, key, rounds, day_first)))
    pieces = F.split(text, ANY, -1)
    found = F.col(listing)
    whole = F.concat(
        F.array_join(F.transform(found, lambda one, place: F.concat(F.get(pieces, place), one["new"])), ""),
        F.element_at(pieces, -1),
    )
    counts = F.struct(*[_count(found, kind).alias(kind) for kind in PATTERNS])
    return listed.select(
        *[
            (F.when(F.size(found) > 0, whole).otherwise(text) if name == text_col else F.col(f"`{name}`")).alias(name)
            for name in kept
        ],
        counts.alias("found"),
    )


# ---- kinds and their checks

def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda one: one["valid"] & (one["kind"] == kind)))


def _with_kind(value: Column, day_first: bool) -> Column:
    digits = F.regexp_replace(value, r"\D", "")
    octets = F.split(value, r"\.")
    kind = (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(F.rlike(value, F.lit(r"^\d{1,3}(?:\.\d{1,3}){3}$")), "ip")
        .when(F.rlike(value, F.lit(r"^[A-Z]")), "iban")
        .when(F.rlike(value, F.lit(DATE)), "date")
        .when(F.rlike(value, F.lit(r"^\d{3}-\d{2}-\d{4}$")), "ssn")
        .when(F.rlike(value, F.lit(r"^0\d{1,4}[ ./-]")), "phone")
        .when(F.rlike(value, F.lit(r"^\d(?:[ -]?\d){12,18}$")), "card")
        .otherwise("phone")
    )
    valid = (
        F.when(kind == "ip", F.forall(octets, lambda octet: octet.cast("int") <= 255))
        .when(kind == "iban", _rest_97(value) == 1)
        .when(kind == "date", _day(value, day_first).isNotNull())
        .when(kind == "card", _luhn_sum(digits) % 10 == 0)
        .when(kind == "ssn", F.rlike(digits, F.lit(r"^(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)")))
        .when(kind == "phone", (F.length(digits) >= 8) & ~F.rlike(value, F.lit(r"^[01]\d{9}$")))
        .otherwise(True)
    )
    return F.struct(
        value.alias("old"), kind.alias("kind"), digits.alias("digits"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def _replaced(one: Column, key: str, rounds: int, day_first: bool) -> Column:
    old, kind, digits = one["old"], one["kind"], one["digits"]
    new = (
        F.when(kind == "email", _email(old, key, rounds))
        .when(kind == "ip", _address(old, key, rounds))
        .when(kind == "iban", _iban(old, key, rounds))
        .when(kind == "date", _date(old, key, rounds, day_first))
        .when(kind == "ssn", _in_format(old, _social_number(digits, key, rounds)))
        .when(kind == "card", _card(old, digits, key, rounds))
        .otherwise(_in_format(old, _number(old, digits, key, rounds)))
    )
    return one.withField("new", F.when(one["valid"], new).otherwise(old))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits with every second one from the right, the last not counted, doubled and cast out by nine."""

    def added(digits: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.length(digits)),
            F.lit(0),
            lambda done, place: done
            + _luhn_digit(F.substr(digits, place, F.lit(1)).cast("int"), (F.length(digits) - place) % 2 == 1),
        )

    return _let(digits, added)


def _luhn_digit(digit: Column, doubled: Column) -> Column:
    twice = digit * 2
    return F.when(doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)


def _day(value: Column, day_first: bool) -> Column:
    """Days from the start of the cycle, or null where the value is no date of it."""
    day = F.lit(None).cast("date")
    for start, form in DATE_FORMS.items():
        read = F.try_to_timestamp(value, F.lit(form)).cast("date")
        if day_first and form.startswith("M/"):
            read = F.coalesce(read, F.try_to_timestamp(value, F.lit(DAY_FIRST)).cast("date"))
        day = F.when(F.rlike(value, F.lit(start)), read).otherwise(day)
    since = F.datediff(day, F.lit(f"{FIRST_YEAR}-01-01").cast("date"))
    return F.when((since >= 0) & (since < CYCLE_DAYS), since)


def _rest_97(value: Column) -> Column:
    """Rest of an IBAN by 97: its first four characters go to the end, letters are numbers from 10."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))

    def added(done: Column, character: Column) -> Column:
        code = F.ascii(character)
        return F.when(code >= 65, (done * 100 + code - 55) % 97).otherwise((done * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), added)


# ---- networks

def _drawn(key: str, domain: str, turn: Column, half: Column) -> Column:
    """A keyed number below 2^48 for one half of a value."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(domain), turn.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def _numbers(left: Column, right: Column, sizes: tuple[int, int], domain: str, key: str, rounds: int) -> Column:
    """A permutation of pairs below ``sizes``: in turn, each half is shifted by a number drawn from the other."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right")),
        lambda pair, turn: F.when(
            turn % 2 == 1,
            F.struct(
                F.pmod(pair["left"] + _drawn(key, domain, turn, pair["right"]), F.lit(sizes[0])).alias("left"),
                pair["right"].alias("right"),
            ),
        ).otherwise(
            F.struct(
                pair["left"].alias("left"),
                F.pmod(pair["right"] + _drawn(key, domain, turn, pair["left"]), F.lit(sizes[1])).alias("right"),
            )
        ),
    )


def _characters(value: Column, domain: str, key: str, rounds: int) -> Column:
    """A permutation of strings of one format: digits stay digits, letters keep their case, the rest stays.

    In turn, each half is shifted, character by character, by numbers drawn from the other half.
    """
    cut = F.greatest(F.lit(1), F.floor(F.length(value) / 2)).cast("int")
    halves = F.struct(
        F.substr(value, F.lit(1), cut).alias("left"), F.substr(value, cut + 1, F.length(value)).alias("right")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        halves,
        lambda pair, turn: F.when(
            turn % 2 == 1,
            F.struct(
                _shifted(pair["left"], pair["right"], turn, domain, key).alias("left"), pair["right"].alias("right")
            ),
        ).otherwise(
            F.struct(
                pair["left"].alias("left"), _shifted(pair["right"], pair["left"], turn, domain, key).alias("right")
            )
        ),
        lambda pair: F.concat(pair["left"], pair["right"]),
    )


def _shifted(half: Column, other: Column, turn: Column, domain: str, key: str) -> Column:
    def shift(character: Column, place: Column) -> Column:
        code = F.ascii(character)
        moved = _drawn(key, domain, turn, F.concat_ws("|", place.cast("string"), other))
        turned = F.lit(None).cast("string")
        for low, count in ((48, 10), (65, 26), (97, 26)):
            inside = (code >= low) & (code < low + count)
            turned = F.when(inside, F.char(F.lit(low) + F.pmod(code - low + moved, F.lit(count)))).otherwise(turned)
        return F.coalesce(turned, character)

    return F.array_join(F.transform(F.split(half, ""), shift), "")


def _in_format(old: Column, digits: Column) -> Column:
    """The old value with its digits, in order, replaced."""

    def placed(digits: Column) -> Column:
        def one(character: Column, place: Column) -> Column:
            number = F.length(F.regexp_replace(F.substr(old, F.lit(1), place + 1), r"\D", ""))
            return F.when(F.rlike(character, F.lit(r"\d")), F.substr(digits, number, F.lit(1))).otherwise(character)

        return F.array_join(F.transform(F.split(old, ""), one), "")

    return _let(digits, placed)


def _email(old: Column, key: str, rounds: int) -> Column:
    """Local part and domain labels are permuted; the last label stays."""
    local = F.substring_index(old, "@", 1)
    host = F.substring_index(old, "@", -1)
    top = F.substring_index(host, ".", -1)
    own = F.substr(host, F.lit(1), F.length(host) - F.length(top) - 1)
    hidden = _characters(F.concat(local, F.lit("@"), own), "email", key, rounds)
    return F.concat(hidden, F.lit("."), top)


def _address(old: Column, key: str, rounds: int) -> Column:
    octets = F.transform(F.split(old, r"\."), lambda octet: octet.cast("bigint"))
    pair = _numbers(
        F.get(octets, 0) * 256 + F.get(octets, 1), F.get(octets, 2) * 256 + F.get(octets, 3), (65536, 65536), "ip",
        key, rounds,
    )
    return _let(
        pair,
        lambda pair: F.concat_ws(
            ".", F.shiftright(pair["left"], 8), pair["left"] % 256, F.shiftright(pair["right"], 8), pair["right"] % 256
        ),
    )


class _Days:
    """Dates of the cycle that one form can write, numbered from 0.

    ``months`` is 9 where the month has one digit, else 12; ``days`` is ``single`` (1 to 9), ``late`` (from 13) or
    ``all``. Days up to a year are a line in the year plus its leap days, so numbers and dates are turned into each other
    without a table.
    """

    def __init__(self, months: int, days: str):
        self.months, self.days = months, days
        in_year = 365 if months == 12 else 273
        left_out = {"all": 0, "late": 12 * months}
        self.leaps = 0 if days == "single" else 1
        self.each = 9 * months if days == "single" else in_year - left_out[days]
        self.total = YEARS * self.each + LEAP_DAYS * self.leaps

    def number(self, date: Column) -> Column:
        first = {"all": 1, "late": 13, "single": 1}[self.days]
        return self._years(F.year(date) - FIRST_YEAR) + self._month(date) + F.dayofmonth(date) - first

    def date(self, number: Column) -> Column:
        about = F.floor(number * YEARS / self.total)
        years = F.filter(
            F.sequence(about - 1, about + 1), lambda year: (self._years(year) <= number) & year.between(0, YEARS - 1)
        )

        def in_year(year: Column) -> Column:
            start = F.make_date(year.cast("int") + FIRST_YEAR, F.lit(1), F.lit(1))
            rest = number - self._years(year)
            months = F.transform(
                F.sequence(F.lit(0), F.lit(self.months - 1)), lambda month: F.add_months(start, month)
            )
            month = F.element_at(F.filter(months, lambda one: self._month(one) <= rest), -1)
            late = 12 if self.days == "late" else 0
            return _let(month, lambda one: F.date_add(one, (rest - self._month(one)).cast("int") + late))

        return _let(F.element_at(years, -1), in_year)

    def _years(self, year: Column) -> Column:
        """Dates before a year of the cycle."""
        before = F.make_date(year.cast("int") + FIRST_YEAR, F.lit(1), F.lit(1))
        leaps = F.datediff(before, F.lit(f"{FIRST_YEAR}-01-01").cast("date")) - 365 * year
        return (year * self.each + (leaps if self.leaps else 0)).cast("bigint")

    def _month(self, date: Column) -> Column:
        """Dates of its year before the month of a date."""
        month = F.month(date) - 1
        if self.days == "single":
            return month * 9
        days = F.dayofyear(F.trunc(date, "month")) - 1
        return days - 12 * month if self.days == "late" else days


def _permuted(number: Column, total: int, domain: str, key: str, rounds: int) -> Column:
    """A permutation of the numbers below ``total``.

    Halves are numbers below two near factors. A total without such factors is permuted twice without its last and then
    without its first number, so every number is moved.
    """

    def once(number: Column, total: int, domain: str) -> Column:
        left, right = _near_factors(total)
        pair = _numbers(F.floor(number / right), number % right, (left, right), domain, key, rounds)
        return _let(pair, lambda pair: pair["left"] * right + pair["right"])

    if _near_factors(total)[0] >= 2:
        return once(number, total, domain)
    most = F.lit(total - 1)
    first = F.when(number < most, once(number, total - 1, f"{domain}|first")).otherwise(number)
    return _let(
        first, lambda number: F.when(number > 0, once(number - 1, total - 1, f"{domain}|second") + 1).otherwise(number)
    )


def _near_factors(total: int) -> tuple[int, int]:
    left = next(one for one in range(isqrt(total), 0, -1) if total % one == 0)
    return left, total // left


def _date(old: Column, key: str, rounds: int, day_first: bool) -> Column:
    """The date permuted among those of its width; slash dates that must have the day first among such dates."""
    parts = F.split(old, r"\D")
    year_first = F.rlike(old, F.lit(r"^\d{4}-"))
    slash = F.contains(old, F.lit("/"))
    late = slash & (F.get(parts, 0).cast("int") > 12) if day_first else F.lit(False)
    month_leads = (slash & ~late) | F.lit(False)
    day = F.when(year_first, F.get(parts, 2)).when(month_leads, F.get(parts, 1)).otherwise(F.get(parts, 0))
    month = F.when(month_leads, F.get(parts, 0)).otherwise(F.get(parts, 1))
    date = F.make_date(
        F.when(year_first, F.get(parts, 0)).otherwise(F.get(parts, 2)).cast("int"), month.cast("int"), day.cast("int")
    )

    def written(new: Column) -> Column:
        def padded(value: Column, width: Column) -> Column:
            return F.lpad(value.cast("string"), F.greatest(width, F.length(value.cast("string"))), F.lit("0"))

        new_day, new_month = padded(F.dayofmonth(new), F.length(day)), padded(F.month(new), F.length(month))
        year = F.year(new).cast("string")
        return (
            F.when(year_first, F.concat_ws("-", year, new_month, new_day))
            .when(month_leads, F.concat_ws("/", new_month, new_day, year))
            .when(slash, F.concat_ws("/", new_day, new_month, year))
            .otherwise(F.concat_ws(".", new_day, new_month, year))
        )

    made = F.lit(None).cast("date")
    for months, short_month in ((12, F.length(month) == 2), (9, F.length(month) == 1)):
        for days, fits in (
            ("late", late), ("single", ~late & (F.length(day) == 1)), ("all", ~late & (F.length(day) == 2)),
        ):
            form = _Days(months, days)
            new = _let(_permuted(form.number(date), form.total, f"date|{months}|{days}", key, rounds), form.date)
            made = F.when(short_month & fits, new).otherwise(made)
    return _let(made, written)


def _social_number(digits: Column, key: str, rounds: int) -> Column:
    """Areas run from 001 to 899 without 666; group and serial number are not zero."""
    area = F.substr(digits, F.lit(1), F.lit(3)).cast("int")
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    left = place * SSN_GROUPS + F.substr(digits, F.lit(4), F.lit(2)).cast("int") - 1
    right = F.substr(digits, F.lit(6), F.lit(4)).cast("int") - 1
    pair = _numbers(left, right, (SSN_AREAS * SSN_GROUPS, SSN_SERIALS), "ssn", key, rounds)

    def spelled(pair: Column) -> Column:
        place = F.floor(pair["left"] / SSN_GROUPS)
        area = F.when(place >= 665, place + 2).otherwise(place + 1)
        parts = ((area, 3), (pair["left"] % SSN_GROUPS + 1, 2), (pair["right"] + 1, 4))
        return F.concat(*[F.lpad(value.cast("string"), width, "0") for value, width in parts])

    return _let(pair, spelled)


def _ten_digits(digits: Column, key: str, rounds: int) -> Column:
    """Ten digits of which the first stays below 2, or stays 2 or more, which telephone numbers begin with."""
    half = 100_000
    left, right = F.substr(digits, F.lit(1), F.lit(5)).cast("bigint"), F.substr(digits, F.lit(6), F.lit(5)).cast("bigint")
    low = F.lit(20_000)

    def spelled(shift: Column | int):
        return lambda pair: F.concat(
            *[F.lpad(value.cast("string"), 5, "0") for value in (pair["left"] + shift, pair["right"])]
        )

    real = _let(_numbers(left - low, right, (80_000, half), "phone", key, rounds), spelled(low))
    other = _let(_numbers(left, right, (20_000, half), "phone|other", key, rounds), spelled(0))
    return F.when(left >= low, real).otherwise(other)


def _number(old: Column, digits: Column, key: str, rounds: int) -> Column:
    """What stands before the last ten digits stays in the North American form and before ten digits alone; otherwise up
    to two digits of the country code, or the leading zero, stay. The other digits are permuted, among numbers of the
    same length.
    """
    american = F.rlike(
        old, F.lit(r"(?:^|[ .-]|\+\d{1,3})(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}$|^\d{10}$")
    ) & (F.length(digits) >= 10)
    code = (
        F.when(american, F.length(digits) - 10)
        .when(F.startswith(old, F.lit("+")), F.when(F.rlike(digits, F.lit("^[17]")), 1).otherwise(2))
        .when(F.startswith(old, F.lit("0")), 1)
        .otherwise(0)
    )
    return _let(
        code,
        lambda code: F.concat(
            F.substr(digits, F.lit(1), code),
            F.when(american, _ten_digits(F.substr(digits, code + 1, F.lit(10)), key, rounds)).otherwise(
                _characters(F.substr(digits, code + 1, F.length(digits)), "phone", key, rounds)
            ),
        ),
    )


def _iban(old: Column, key: str, rounds: int) -> Column:
    """Country and format stay, what follows the check digits is permuted, the check digits are computed again."""
    body = F.regexp_replace(F.substr(old, F.lit(5), F.length(old)), " ", "")
    country = F.substr(old, F.lit(1), F.lit(2))

    def checked(body: Column) -> Column:
        check = F.lpad((98 - _rest_97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
        return F.concat(country, check, body)

    def placed(plain: Column) -> Column:
        def one(character: Column, place: Column) -> Column:
            number = F.length(F.regexp_replace(F.substr(old, F.lit(1), place + 1), " ", ""))
            return F.when(character == " ", character).otherwise(F.substr(plain, number, F.lit(1)))

        return F.array_join(F.transform(F.split(old, ""), one), "")

    return _let(_let(_characters(body, "iban", key, rounds), checked), placed)


def _card(old: Column, digits: Column, key: str, rounds: int) -> Column:
    def checked(body: Column) -> Column:
        check = F.pmod(-_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
        return F.concat(body, check.cast("string"))

    body = _characters(F.substr(digits, F.lit(1), F.length(digits) - 1), "card", key, rounds)
    return _in_format(old, _let(body, checked))


def op10_feistel_pseudonyms(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, key="tallyspark", day_first=True).select(
        "doc_id", "text", *[F.col(f"found.{kind}").alias(f"n_{kind}") for kind in PATTERNS]
    )
