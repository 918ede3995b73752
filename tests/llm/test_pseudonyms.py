import datetime
import hashlib
import re
from functools import lru_cache
from math import isqrt

from tallyspark.llm.pseudonyms import CYCLE_DAYS, PATTERNS, pseudonymise


def luhn(number):
    digits = [int(digit) for digit in re.sub(r"\D", "", number)][::-1]
    return sum(digit if at % 2 == 0 else sum(divmod(2 * digit, 10)) for at, digit in enumerate(digits)) % 10 == 0


def replaced(spark, values, key="k", **options):
    rows = spark.createDataFrame([(at, f"see {value}, ok") for at, value in enumerate(values)], "doc_id long, text string")
    out = {row.doc_id: row.text for row in pseudonymise(rows, key, **options).collect()}
    return [out[at][4:-4] for at in range(len(values))]


def drawn(domain, turn, half, key="k"):
    return int(hashlib.sha256(f"{key}|{domain}|{turn}|{half}".encode()).hexdigest()[:12], 16)


def feistel(left, right, sizes, domain, backwards=False):
    """The network by its definition, in either direction."""
    turns = range(1, 9)
    for turn in reversed(turns) if backwards else turns:
        sign = -1 if backwards else 1
        if turn % 2:
            left = (left + sign * drawn(domain, turn, right)) % sizes[0]
        else:
            right = (right + sign * drawn(domain, turn, left)) % sizes[1]
    return left, right


def permuted(number, total, domain):
    def once(number, total, domain):
        left = next(one for one in range(isqrt(total), 0, -1) if total % one == 0)
        moved = feistel(*divmod(number, total // left), (left, total // left), domain)
        assert feistel(*moved, (left, total // left), domain, backwards=True) == divmod(number, total // left)
        return moved[0] * (total // left) + moved[1]

    if next(one for one in range(isqrt(total), 0, -1) if total % one == 0) > 1:
        return once(number, total, domain)
    number = once(number, total - 1, f"{domain}|first") if number < total - 1 else number
    return once(number - 1, total - 1, f"{domain}|second") + 1 if number else 0


@lru_cache
def dates_of(months, days):
    start = datetime.date(1700, 1, 1)
    fits = {"all": lambda d: True, "late": lambda d: d > 12, "single": lambda d: d < 10}[days]
    every = (start + datetime.timedelta(at) for at in range(CYCLE_DAYS))
    found = [date for date in every if date.month <= months and fits(date.day)]
    return found, {date: at for at, date in enumerate(found)}


def plain_date(value, day_first=True):
    """The pseudonym of a date by looking up lists of all dates of its form."""
    parts = re.split(r"\D", value)
    order = "ymd" if re.match(r"\d{4}-", value) else "dmy"
    late = day_first and "/" in value and int(parts[0]) > 12
    if "/" in value and not late:
        order = "mdy"
    part = dict(zip(order, parts, strict=True))
    months = 9 if len(part["m"]) == 1 else 12
    days = "late" if late else "single" if len(part["d"]) == 1 else "all"
    found, numbers = dates_of(months, days)
    number = numbers[datetime.date(int(part["y"]), int(part["m"]), int(part["d"]))]
    new = found[permuted(number, len(found), f"date|{months}|{days}")]
    spelled = {"y": str(new.year), "m": str(new.month).zfill(len(part["m"])), "d": str(new.day).zfill(len(part["d"]))}
    return re.search(r"[./-]", value).group().join(spelled[one] for one in order)


def slash_dates(years):
    out = []
    for at in range((datetime.date(1990 + years, 1, 1) - datetime.date(1990, 1, 1)).days):
        day = datetime.date(1990, 1, 1) + datetime.timedelta(at)
        for d in {str(day.day), f"{day.day:02}"}:
            for m in {str(day.month), f"{day.month:02}"}:
                out += [f"{m}/{d}/{day.year}", f"{d}/{m}/{day.year}"]
    return sorted(set(out))


def test_all_slash_dates_of_ten_years_stay_different(spark):
    values = slash_dates(10)
    new = replaced(spark, values, day_first=True)
    assert len(values) > 11_730 and len(set(new)) == len(values)
    assert new[::37] == [plain_date(value) for value in values[::37]]
    assert all(len(old) == len(fresh) for old, fresh in zip(values, new, strict=True))


def test_other_dates_as_by_their_lists(spark):
    values = [
        f"{year}{mark}{month}{mark}{day}" if mark == "-" else f"{day}{mark}{month}{mark}{year}"
        for mark in "-." for year in (1700, 1704, 1900, 2000, 2099) for month in ("1", "02", "9", "12") for day in ("1", "07", "28")
    ]
    assert replaced(spark, values) == [plain_date(value, day_first=False) for value in values]


def test_social_security_numbers(spark):
    valid = [f"{area:03}-{group:02}-{serial:04}" for area in (1, 665, 667, 899) for group in (1, 99) for serial in (1, 77, 9999)]
    new = replaced(spark, valid)
    assert len(set(new)) == len(valid) and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", one) for one in new)
    areas = [area for area in range(1, 900) if area != 666]
    for old, fresh in zip(valid, new, strict=True):
        area, group, serial = map(int, old.split("-"))
        left, right = feistel(areas.index(area) * 99 + group - 1, serial - 1, (898 * 99, 9999), "ssn")
        assert fresh == f"{areas[left // 99]:03}-{left % 99 + 1:02}-{right + 1:04}"
    invalid = ["000-12-3456", "666-12-3456", "900-12-3456", "999-99-9999", "123-00-4567", "123-45-0000"]
    assert replaced(spark, invalid) == invalid


def test_ten_digits(spark):
    stay = ["1700000000", "0306406152"]  # a time stamp, a book number
    assert replaced(spark, stay) == stay
    values = ["5551234567", "(555) 123-4567", "555.123.4567", "+1 555 123 4567", "9999999999", "2000000000", "155-123-4567"]
    new = replaced(spark, values)
    plain = [re.sub(r"\D", "", one)[-10:] for one in new]
    assert len({plain[0], plain[1], plain[2], plain[3]}) == 1 and plain[0] != "5551234567"
    assert all(one[0] in "23456789" for one in plain[:6]) and plain[6][0] in "01" and new[3].startswith("+1 ")
    left, right = feistel(55512 - 20000, 34567, (80_000, 100_000), "phone")
    assert plain[0] == f"{left + 20000:05}{right:05}"


def test_names_in_any_case(spark):
    docs = spark.createDataFrame([(1, "a@b.de", 1, 2, 3)], "doc_id long, text string, _values int, FOUND int, _VALUES_ int")
    out = pseudonymise(docs, "k")
    assert out.columns == ["doc_id", "text", "_values", "_VALUES_", "found"] and out.first().found.email == 1


def test_all_dates_are_numbered():
    assert len(dates_of(12, "all")[0]) == CYCLE_DAYS


def test_formats_and_links(spark):
    values = [
        "ann.lee42@mail.example.com", "10.0.0.255", "2024-02-29", "29.02.2024", "02/29/2024", "+1 (988) 555-2485",
        "4041894974608795", "4041 8949 7460 8795", "988-555-2485",
    ]
    new = replaced(spark, values)
    assert new == replaced(spark, values)  # linked
    assert new != replaced(spark, values, "other")
    shape = lambda text: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", text)))
    for old, fresh in zip(values, new, strict=True):
        assert fresh != old
        if "255" != old[-3:]:
            assert shape(fresh) == shape(old)
    assert new[0].endswith(".com") and all(0 <= int(octet) <= 255 for octet in new[1].split("."))
    days = [datetime.datetime.strptime(new[2 + at], form).date() for at, form in enumerate(("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"))]
    assert len(set(days)) == 1 and 1700 <= days[0].year < 2100
    assert luhn(new[6]) and re.sub(r"\D", "", new[7]) == new[6] and new[5].startswith("+1 (")


def test_permutation(spark):
    addresses = [f"7.{a}.{b}.9" for a in range(10) for b in range(40)]
    assert len(set(replaced(spark, addresses))) == 400
    days = [(datetime.date(1999, 1, 1) + datetime.timedelta(day)).isoformat() for day in range(400)]
    moved = replaced(spark, days)
    assert len(set(moved)) == 400 and all(datetime.date.fromisoformat(day) for day in moved)
    phones = [f"(555) 010-{number:04}" for number in range(400)]
    assert len(set(replaced(spark, phones))) == 400


def test_invalid_values_stay(spark):
    values = ["10.0.0.256", "2023-02-29", "4041894974608796", "1234-5678", "1.2.3", "31/12/1999", "v1.2.3.4.5", "0001-01-01"]
    assert replaced(spark, values) == values


def test_odd_rows(spark, odd_docs, no_docs):
    out = pseudonymise(odd_docs, "k")
    assert out.columns == [*odd_docs.columns, "found"]
    assert sorted(map(str, out.select(*odd_docs.columns).collect())) == sorted(map(str, odd_docs.collect()))
    assert all(sum(row.found) == 0 for row in out.collect())
    assert pseudonymise(no_docs, "k").count() == 0
    many = spark.createDataFrame([(1, "a@b.de 2000-01-01 " * 400)], "doc_id long, text string")
    row = pseudonymise(many, "k").first()
    assert row.found.email == 400 and row.found.date == 400 and len(set(row.text.split())) == 2
    assert list(row.found.asDict()) == list(PATTERNS)


def rest_97(value):
    plain = value.replace(" ", "")
    return int("".join(str(int(character, 36)) for character in plain[4:] + plain[:4])) % 97


def test_numbers_of_other_countries(spark):
    values = [
        "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606", "123-45-6789",
        "+44 20 7946 0958", "5551234567", "+33 1 23 45 67 89", "030 12345678", "06 12 34 56 78", "+442079460958",
        "1999-1-5", "5.6.1999", "31/12/1999", "31/1/1999", "05/06/1999",
    ]
    rows = spark.createDataFrame([(at, f"see {value}, ok") for at, value in enumerate(values)], "doc_id long, text string")
    out = pseudonymise(rows, "k", day_first=True)
    again = {row.doc_id: row.text[4:-4] for row in out.collect()}
    new = [again[at] for at in range(len(values))]
    shape = lambda text: re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", text))
    for old, fresh in zip(values, new, strict=True):
        assert fresh != old
        assert shape(fresh) == shape(old)
    assert all(rest_97(value) == 1 for value in values[:3] + new[:3]) and new[0][:2] == "DE"
    assert datetime.datetime.strptime(new[12], "%d/%m/%Y") and datetime.datetime.strptime(new[13], "%d/%m/%Y")
    assert datetime.datetime.strptime(new[10], "%Y-%m-%d") and datetime.datetime.strptime(new[11], "%d.%m.%Y")
    assert replaced(spark, ["DE88 3704 0044 0532 0130 00"]) == ["DE88 3704 0044 0532 0130 00"]
