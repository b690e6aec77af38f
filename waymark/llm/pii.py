r"""Personal data: format-preserving Feistel pseudonyms, in Spark expressions only.

Card numbers (Luhn), phone numbers, social security numbers, IPv4 addresses and calendar
dates are found and validated, then permuted within their own format by a keyed Feistel
network: equal values get equal pseudonyms in every document, however they are spelled, different ones different ones,
separators stay where they are, and a pseudonym is valid itself. E-mail addresses, which
have no fixed format to permute, get a keyed name.

- cards: all digits but the last are permuted, the last is the new check digit;
- phone numbers: the country code is told from the digits and stays, the national number is permuted. In country
  code 1, which is also that of numbers written without any, a valid area or exchange (first digit 2 to 9)
  becomes a valid one. So +1 212 555 0123, +12125550123 and (212) 555-0123 are one number;
- social security numbers: areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999, permuted among these;
- addresses: the four octets as one number;
- dates from 1900 to 2099, written in the form they had. Days of one digit and of two, months of one digit and of two make
  four classes, each permuted in itself, so 1/2/1999 gets as many digits as it has and stays linked to
  01/02/1999 and 1999-02-01. Day before month is tried first. Other dates stay. Of an ISO timestamp the date is replaced
  and the time stays.

What looks alike but fails validation stays as it is. Whoever has the key can undo the pseudonyms: there is no default.

Defined results:
- null text stays null, with counts 0; empty texts and texts without findings are unchanged;
- an e-mail address may have any number of labels, a text any length: no pattern repeats a group without bound and backtracks;
- repeated rows get equal results; a null doc_id keeps its row; an empty table gives no rows;
- ``pseudonymise`` keeps all columns in place; the column it adds, ``pii`` unless told otherwise, replaces one of that name;
- an empty or null key is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ROUNDS = 8
#: The session's setting that holds the key. Spark hides the values of settings of such a name in logs and pages.
KEY_SETTING = "spark.waymark.pii.secret"
#: Known to every reader of this file, so no secret: for the registered query and pipeline over synthetic tables alone.
OPEN_KEY = "synthetic-tables-only"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
CARD = (
    r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
    r"(?![A-Za-z0-9])"
)
DATE = (
    r"(?<![A-Za-z0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?:(?=[Tt][0-9])|(?![A-Za-z0-9]))"
    r"|(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![A-Za-z0-9]))"
)
SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
IP = r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![A-Za-z0-9]|\.[0-9])"
PHONE = (
    r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}"
    r"|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![A-Za-z0-9])"
)
#: In this order at any place of the text.
KINDS = {"email": EMAIL, "card": CARD, "date": DATE, "ssn": SSN, "ip": IP, "phone": PHONE}
ANY = "|".join(KINDS.values())
FIRST_YEAR, YEARS = 1900, 200
LEAP_DAYS = 49
#: Days 10 and later of the months 1 to 9 (without 29 February), and of 10 to 12, before each month.
BEFORE_MONTH = (0, 22, 41, 63, 84, 106, 127, 149, 171, 0, 22, 43)
#: By class (day under 10, month under 10): how many dates, and two factors whose product is that or just over it.
DATES = {
    (True, True): (81 * YEARS, (135, 120)),
    (True, False): (27 * YEARS, (72, 75)),
    (False, False): (65 * YEARS, (104, 125)),
    (False, True): (192 * YEARS + LEAP_DAYS, (193, 200)),
}

# Country calling codes of one and of two digits; all others have three.
CODES_1 = "1 7"
CODES_2 = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58"
    " 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
)


def _noise(key: str, tweak: Column, i: Column, half: Column) -> Column:
    """48 keyed bits of a round number and a half."""
    said = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 12), 16, 10).cast("bigint")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column) -> Column:
    """struct<a,b>: a keyed permutation of the pairs with a < size_a and b < size_b."""

    def turn(state: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, size_a).otherwise(size_b)
        mixed = F.pmod(state["a"] + _noise(key, tweak, i, state["b"]), size)
        return F.struct(state["b"].alias("a"), mixed.alias("b"))

    begin = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, turn)


def _pair(numbers: Column, then) -> Column:
    """Bind a struct once and use it several times."""
    return F.element_at(F.transform(F.array(numbers), then), 1)


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of two digits or more -> one of the same length."""
    left = F.floor(F.length(digits) / 2).cast("int")
    right = F.length(digits) - left
    power = lambda n: F.pow(F.lit(10), n).cast("bigint")
    out = feistel(
        F.substr(digits, F.lit(1), left),
        F.substr(digits, left + 1, right),
        power(left),
        power(right),
        key,
        F.concat(F.lit(kind), F.length(digits).cast("string")),
    )
    return _pair(
        out, lambda p: F.concat(F.lpad(p["a"].cast("string"), left, F.lit("0")), F.lpad(p["b"].cast("string"), right, F.lit("0")))
    )


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, whose last digit counts once."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when((F.length(digits) - i) % 2 == 0, digit).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def into_form(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order."""
    chars = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(digits, i, F.lit(1)))
    return F.array_join(
        F.zip_with(F.split(value, "[0-9]", -1), chars, lambda s, d: F.concat(s, F.coalesce(d, F.lit("")))), ""
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def new_card(value: Column, key: str) -> Column:
    digits = digits_of(value)
    body = permute_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    whole = _pair(
        body,
        lambda b: F.concat(b, F.pmod(10 - luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")),
    )
    return F.when((F.length(digits) <= 19) & (luhn_sum(digits) % 10 == 0), into_form(value, whole))


def country_code(digits: Column) -> Column:
    """The calling code that a number's digits open with."""
    one, two = F.substring(digits, 1, 1), F.substring(digits, 1, 2)
    return F.when(one.isin(CODES_1.split()), one).when(two.isin(CODES_2.split()), two).otherwise(F.substring(digits, 1, 3))


def new_national(national: Column, code: Column, key: str) -> Column:
    """The digits of a national number permuted. Ten digits under code 1 keep their kind of area and exchange."""

    def number(at: int, size: int) -> Column:
        return F.substring(national, at, size).cast("int")

    def part(value: Column) -> tuple[Column, Column]:
        """(place in its kind, size of the kind): 000 to 199, or 200 to 999."""
        return F.when(value < 200, value).otherwise(value - 200), F.when(value < 200, 200).otherwise(800)

    area, areas = part(number(1, 3))
    exchange, exchanges = part(number(4, 3))
    tweak = F.concat_ws("-", F.lit("phone1"), areas, exchanges)
    out = feistel(area * exchanges + exchange, number(7, 4), areas * exchanges, F.lit(10_000), key, tweak)

    def write(p: Column) -> Column:
        a = F.floor(p["a"] / exchanges) + F.when(areas == 800, 200).otherwise(0)
        e = p["a"] % exchanges + F.when(exchanges == 800, 200).otherwise(0)
        return F.concat(*[F.lpad(n.cast("string"), size, "0") for n, size in ((a, 3), (e, 3), (p["b"], 4))])

    american = (code == "1") & (F.length(national) == 10)
    return F.when(american, _pair(out, write)).otherwise(permute_digits(national, key, "phone"))


def new_phone(value: Column, key: str) -> Column:
    written = digits_of(value)
    named = F.startswith(value, F.lit("+"))
    code = F.when(named, country_code(written)).otherwise("1")
    national = F.when(named, F.substr(written, F.length(code) + 1)).otherwise(written)

    def rewrite(p: Column) -> Column:
        return F.concat(F.when(named, p["code"]).otherwise(""), new_national(p["national"], p["code"], key))

    whole = _pair(_pair(F.struct(code.alias("code"), national.alias("national")), rewrite), lambda d: into_form(value, d))
    return F.when(F.length(written).between(7, 15), whole)


def new_ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.element_at(F.split(value, "-"), i).cast("int") for i in (1, 2, 3))
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9_999), key, F.lit("ssn"))

    def write(p: Column) -> Column:
        a = F.floor(p["a"] / 99)
        parts = ((F.when(a >= 665, a + 2).otherwise(a + 1), 3), (p["a"] % 99 + 1, 2), (p["b"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(n.cast("string"), size, "0") for n, size in parts])

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _pair(out, write))


def new_ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("int"))
    part = lambda i: F.element_at(octets, i)
    side = F.lit(65536)
    out = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), side, side, key, F.lit("ip"))
    text = _pair(
        out,
        lambda p: F.concat_ws(
            ".", F.shiftright(p["a"], 8), p["a"] % 256, F.shiftright(p["b"], 8), p["b"] % 256
        ),
    )
    return F.when(F.forall(octets, lambda o: o <= 255), text)


def permute_below(n: Column, size: int, sides: tuple[int, int], key: str, tweak: str) -> Column:
    """A keyed permutation of the numbers below ``size``, which is at most the product of the sides."""
    a, b = sides

    def turn(at: Column) -> Column:
        out = feistel(F.floor(at / b), at % b, F.lit(a), F.lit(b), key, F.lit(tweak))
        return _pair(out, lambda p: p["a"] * b + p["b"])

    if size == a * b:
        return turn(n)
    # numbers over the size are walked along their cycle, which leaves them after so many steps at most
    steps = F.sequence(F.lit(1), F.lit(a * b - size))
    return F.aggregate(steps, turn(n), lambda at, _: F.when(at < size, at).otherwise(turn(at)))


def new_day(day: Column, key: str) -> Column:
    """struct<y,m,d> (ints, a date from 1900 to 2099) -> another one of its class."""
    y, m, d = day["y"] - FIRST_YEAR, day["m"], day["d"]
    before = F.array(*[F.lit(n) for n in BEFORE_MONTH])

    def date(year: Column, month: Column, of_month: Column) -> Column:
        return F.struct(
            (year + FIRST_YEAR).cast("int").alias("y"), month.cast("int").alias("m"), of_month.cast("int").alias("d")
        )

    def late(n: Column, in_year: int, months: range) -> Column:
        """The n-th date of the months with a day of two digits."""
        rest = n % in_year
        month = F.array_max(F.filter(F.array(*[F.lit(i) for i in months]), lambda i: F.element_at(before, i) <= rest))
        return _pair(month, lambda i: date(F.floor(n / in_year), i, rest - F.element_at(before, i) + 10))

    def permuted(number: Column, kind: tuple[bool, bool], write) -> Column:
        size, sides = DATES[kind]
        return _pair(permute_below(number.cast("bigint"), size, sides, key, f"date{kind[0]:d}{kind[1]:d}"), write)

    in_months = y * 192 + F.element_at(before, m) + d - 10
    leap = F.lit(192 * YEARS) + F.floor((y - 4) / 4)
    number = F.when((m == 2) & (d == 29), leap).otherwise(in_months)

    def write_early(n: Column) -> Column:
        is_leap = n >= 192 * YEARS
        year = (n - 192 * YEARS) * 4 + 4
        return F.when(is_leap, date(year, F.lit(2), F.lit(29))).otherwise(late(n, 192, range(1, 10)))

    return (
        F.when(
            (d < 10) & (m < 10),
            permuted(y * 81 + (m - 1) * 9 + d - 1, (True, True), lambda n: date(F.floor(n / 81), F.floor(n % 81 / 9) + 1, n % 9 + 1)),
        )
        .when(
            d < 10,
            permuted(y * 27 + (m - 10) * 9 + d - 1, (True, False), lambda n: date(F.floor(n / 27), F.floor(n % 27 / 9) + 10, n % 9 + 1)),
        )
        .when(
            m >= 10,
            permuted(y * 65 + F.element_at(before, m) + d - 10, (False, False), lambda n: late(n, 65, range(10, 13))),
        )
        .otherwise(permuted(number, (False, True), write_early))
    )


def new_date(value: Column, key: str) -> Column:
    parts = F.split(value, "[-/.]")
    one, two, three = (F.element_at(parts, i) for i in (1, 2, 3))
    iso = F.length(one) == 4

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")

    first = F.when(iso, day(one, two, three)).otherwise(day(three, two, one))
    told = F.coalesce(first, F.when(~iso, day(three, one, two)))
    mark = F.regexp_extract(value, "[-/.]", 0)
    numbers = F.struct(F.year(told).alias("y"), F.month(told).alias("m"), F.dayofmonth(told).alias("d"))

    def write(new: Column) -> Column:
        y = new["y"].cast("string")
        as_long = lambda n, old: F.lpad(n.cast("string"), F.length(old), F.lit("0"))
        return (
            F.when(iso, F.concat_ws("-", y, as_long(new["m"], two), as_long(new["d"], three)))
            .when(first.isNotNull(), F.concat(as_long(new["d"], one), mark, as_long(new["m"], two), mark, y))
            .otherwise(F.concat(as_long(new["m"], one), mark, as_long(new["d"], two), mark, y))
        )

    good = F.year(told).between(FIRST_YEAR, FIRST_YEAR + YEARS - 1)
    return F.when(good, _pair(_pair(numbers, lambda n: new_day(n, key)), write))


def new_email(value: Column, key: str) -> Column:
    name = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), 1, 12)
    return F.concat(F.lit("u"), name, F.lit("@example.org"))


MAKERS = {"email": new_email, "card": new_card, "date": new_date, "ssn": new_ssn, "ip": new_ip, "phone": new_phone}


def pseudonym(value: Column, key: str) -> Column:
    """struct<kind,text>: the pseudonym of a match, or the match itself with a null kind."""
    asis = F.struct(F.lit(None).cast("string").alias("kind"), value.alias("text"))

    def made(kind: str) -> Column:
        named = lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("text"))
        return _pair(MAKERS[kind](value, key), lambda t: F.when(t.isNull(), asis).otherwise(named(t)))

    out = asis
    for kind in reversed(KINDS):
        out = F.when(F.regexp_like(value, F.lit(f"^(?:{KINDS[kind]})$")), made(kind)).otherwise(out)
    return out


FOUND = "array<struct<kind:string,text:string>>"


def session_key(spark: SparkSession) -> str:
    """The key that the session sets, or the open one: only for the registered query and pipeline."""
    return spark.conf.get(KEY_SETTING, None) or OPEN_KEY


def pseudonymise(docs: DataFrame, key: str, column: str = "pii") -> DataFrame:
    """``docs`` with text replaced, and in ``column`` the kinds replaced, in order of the text. No shuffle."""
    if not key:
        raise ValueError("pseudonyms need a key")
    pattern = F.lit(ANY)
    text = F.col("text")
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: pseudonym(m, key))
    some = F.when(F.regexp_like(text, F.lit("[@0-9]")), found).otherwise(F.array().cast(FOUND))
    marked = docs.withColumn(column, F.coalesce(some, F.array().cast(FOUND)))
    rebuilt = F.array_join(
        F.zip_with(
            F.split(text, pattern, -1),
            F.transform(column, lambda p: p["text"]),
            lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))),
        ),
        "",
    )
    return marked.withColumn("text", F.when(F.size(column) > 0, rebuilt).otherwise(text)).withColumn(
        column, F.filter(F.transform(column, lambda p: p["kind"]), lambda k: k.isNotNull())
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with pseudonyms, and how many values of each kind were replaced."""
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"), *counts)
