from __future__ import annotations

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from waymark.llm import pii

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
KEY = "k"


def py_feistel(a, b, size_a, size_b, tweak):
    for i in range(pii.ROUNDS):
        noise = int(hashlib.sha256(f"{KEY}|{tweak}|{i}|{b}".encode()).hexdigest()[:12], 16)
        a, b = b, (a + noise) % (size_a if i % 2 == 0 else size_b)
    return a, b


def py_digits(d, kind):
    u = len(d) // 2
    v = len(d) - u
    a, b = py_feistel(int(d[:u]), int(d[u:]), 10**u, 10**v, f"{kind}{len(d)}")
    return f"{a:0{u}d}{b:0{v}d}"


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def into(form, digits):
    rest = iter(digits)
    return re.sub("[0-9]", lambda m: next(rest), form)


def py_new(m):
    digits = re.sub(r"\D", "", m)
    if "@" in m:
        return "u" + hashlib.sha256(f"{KEY}|email|{m.lower()}".encode()).hexdigest()[:12] + "@example.org"
    if re.fullmatch(r"\d{13,19}", m):
        if not luhn(m):
            return m
        body = py_digits(m[:-1], "card")
        return next(body + c for c in "0123456789" if luhn(body + c))
    if re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}", m):
        o = list(map(int, m.split(".")))
        if max(o) > 255:
            return m
        a, b = py_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
        return f"{a >> 8}.{a % 256}.{b >> 8}.{b % 256}"
    if m[0] in "+(" or re.fullmatch(r"\d{3}[ .-]\d{3}[ .-]\d{4}", m):
        one, two = digits[0], digits[:2]
        code = "" if m[0] != "+" else one if one in "17" else two if two in pii.CODES_2.split() else digits[:3]
        return into(m, code + py_national(digits[len(code) :], code or "1"))
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", m):
        area, group, serial = map(int, m.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return m
        place = [x for x in range(1, 900) if x != 666]
        a, b = py_feistel(place.index(area) * 99 + group - 1, serial - 1, 898 * 99, 9999, "ssn")
        return f"{place[a // 99]:03d}-{a % 99 + 1:02d}-{b + 1:04d}"
    return m


def py_national(n, code):
    if code != "1" or len(n) != 10:
        return py_digits(n, "phone")
    area, exchange = int(n[:3]), int(n[3:6])
    areas, exchanges = (200 if x < 200 else 800 for x in (area, exchange))
    a = (area if areas == 200 else area - 200) * exchanges + (exchange if exchanges == 200 else exchange - 200)
    a, b = py_feistel(a, int(n[6:]), areas * exchanges, 10_000, f"phone1-{areas}-{exchanges}")
    x, y = divmod(a, exchanges)
    return f"{x + (areas == 800) * 200:03d}{y + (exchanges == 800) * 200:03d}{b:04d}"


def py_dates():
    """Every date to its pseudonym, by listing the classes in the order that numbers them."""
    first = datetime.date(1900, 1, 1)
    every = [first + datetime.timedelta(i) for i in range(73_049)]
    out = {}
    for kind, (size, (a, b)) in pii.DATES.items():
        own = [d for d in every if (d.day < 10, d.month < 10) == kind]
        own.sort(key=lambda d: (d.month == 2 and d.day == 29, d))
        assert len(own) == size
        for n, d in enumerate(own):
            at = n
            while True:
                x, y = py_feistel(at // b, at % b, a, b, f"date{kind[0]:d}{kind[1]:d}")
                at = x * b + y
                if at < size:
                    break
            out[d] = own[at]
    return out


def brute(text):
    return re.sub(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
        r"|(?<![A-Za-z0-9])\d{13,19}(?![A-Za-z0-9])"
        r"|(?<![A-Za-z0-9-])\d{3}-\d\d-\d{4}(?![A-Za-z0-9-])"
        r"|(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![A-Za-z0-9]|\.[0-9])"
        r"|(?<![A-Za-z0-9])\+\d{1,3} \(\d{3}\) \d{3}-\d{4}(?![A-Za-z0-9])",
        lambda m: py_new(m[0]),
        text,
    )


def test_documents_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {r.doc_id: r.text for r in pii.pseudonymise(docs, KEY).collect()}
    changed = 0
    for r in docs.collect():
        assert out[r.doc_id] == brute(r.text), r.doc_id
        changed += out[r.doc_id] != r.text
    assert changed > 10


def test_digits_are_permuted(spark):
    frame = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = [r.x for r in frame.select(pii.permute_digits(F.col("d"), KEY, "t").alias("x")).collect()]
    assert sorted(out) == [f"{i:03d}" for i in range(1000)]


def test_days_are_permuted(spark):
    days = spark.range(73_049).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    out = days.select("d", pii.new_date(F.date_format("d", "yyyy-MM-dd"), KEY).alias("x")).collect()
    got = {r.d: datetime.date.fromisoformat(r.x) for r in out}
    assert got == py_dates() and len(set(got.values())) == 73_049


def test_dates_keep_their_digits(spark):
    rows = [(1, "1/2/1999 01/02/1999 1999-02-01 01.2.1999"), (2, "12/31/1999 31.12.1999"), (3, "29/2/2000"), (4, "10/9/1950")]
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id bigint, text string"), KEY).collect()]
    new = py_dates()
    a, b, c, d = (new[datetime.date(*x)] for x in ((1999, 2, 1), (1999, 12, 31), (2000, 2, 29), (1950, 9, 10)))
    assert out[0] == f"{a.day}/{a.month}/{a.year} 0{a.day}/0{a.month}/{a.year} {a.isoformat()} 0{a.day}.{a.month}.{a.year}"
    assert out[1] == f"{b.month}/{b.day}/{b.year} {b.day}.{b.month}.{b.year}"
    assert out[2] == f"{c.day}/{c.month}/{c.year}" and out[3] == f"{d.day}/{d.month}/{d.year}"


def test_spellings_of_a_number_are_linked(spark):
    rows = [
        (1, "+1 212 555 0123; +12125550123; (212) 555-0123; 212.555.0123; +1 (212) 555-0123"),
        (2, "+44 20 7946 0958; +442079460958; +44 (20) 7946-0958"),
        (3, "000-12-3456 666-12-3456 900-12-3456 123-00-6789 123-45-0000"),
    ]
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id bigint, text string"), KEY).collect()]
    for text, code in ((out[0], "1"), (out[1], "44")):
        numbers = [re.sub(r"\D", "", x) for x in text.split(";")]
        assert {x if x.startswith(code) and len(x) > 10 else "1" + x for x in numbers} == {max(numbers, key=len)}
        assert numbers[0] not in re.sub(r"[^\d;]", "", rows[0][1] + rows[1][1]).split(";")
    assert re.fullmatch(r"1[2-9]\d\d[2-9]\d{6}", re.sub(r"\D", "", out[0].split(";")[0]))
    assert out[2] == rows[2][1]


def test_social_security_numbers_are_permuted(spark):
    cells = spark.range(0, 898 * 99 * 9_999, 44_449).select(
        F.format_string("%03d-%02d-%04d",
            F.floor(F.col("id") / (99 * 9_999)) + 1 + (F.col("id") >= 665 * 99 * 9_999).cast("int"),
            F.floor(F.col("id") / 9_999) % 99 + 1, F.col("id") % 9_999 + 1).alias("v"))
    out = cells.select("v", pii.new_ssn(F.col("v"), KEY).alias("x")).collect()
    assert all(r.x == py_new(r.v) != r.v for r in out) and len({r.x for r in out}) == len(out) > 10_000


def test_texts_that_tire_a_pattern(spark):
    n = 1_000_000
    m = n // 5
    rows = [(1, "a@" + "b." * n + "com"), (2, "1." * m), (3, "a.b-" * m + "@x"), (4, "1234-" * m), (5, "+1 " * m), (6, "1/2/" * m)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: (r.size, r.pii) for r in pii.pseudonymise(docs, KEY).select("doc_id", F.length("text").alias("size"), "pii").collect()}
    assert out[1] == (len("u0123456789ab@example.org"), ["email"])
    assert all(out[i][0] == len(text) for i, text in rows[1:])


def test_a_key_is_asked_for(spark):
    docs = spark.createDataFrame([(1, "a@b.cd")], "doc_id bigint, text string")
    for key in ("", None):
        with pytest.raises(ValueError):
            pii.pseudonymise(docs, key)
    one, two = (pii.pseudonymise(docs, key).first().text for key in ("x", "y"))
    assert one != two
    assert pii.session_key(spark) == pii.OPEN_KEY
    spark.conf.set(pii.KEY_SETTING, "own")
    try:
        assert pii.session_key(spark) == "own"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_forms_links_and_edges(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "card 4111 1111 1111 1111, again 4111111111111111; not 4111111111111112"),
        (4, "born 1980-02-29 or 29.02.1980 or 02/29/1980, not 1981-02-29 or 31/31/1999 or 1700-01-01"),
        (5, "call (212) 555-0123 or +44 20 7946 0958! 123-45-6789, host 10.0.0.255 not 300.1.1.1"),
        (6, "A.b@x.example.com a.b@X.example.com é@ 12 v1.2.3.4"),
        (7, "x" * 2_000_000 + " 4111111111111111"),
        (3, "card 4111 1111 1111 1111, again 4111111111111111; not 4111111111111112"),
        (None, "a@b.cd"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pii", F.lit("clash")).withColumn("kind", F.lit(1))
    out = pii.pseudonymise(docs, KEY).collect()
    assert out[0].text is None and out[0].pii == [] and out[1].text == ""
    cards = re.findall(r"[\d ]{16,}\d|\d{16}", out[2].text)
    assert cards[0].strip().replace(" ", "") == cards[1].strip() and luhn(cards[1].strip())
    assert out[2].text.endswith("not 4111111111111112") and "4111 1111" not in out[2].text
    assert out[2].pii == ["card", "card"] and out[7].text == out[2].text
    iso, dotted, slashed = re.findall(r"[\d./-]{10}", out[3].text)[:3]
    day = datetime.date.fromisoformat(iso)
    assert day.strftime("%d.%m.%Y") == dotted and day.strftime("%m/%d/%Y") == slashed and iso != "1980-02-29"
    assert out[3].text.endswith("not 1981-02-29 or 31/31/1999 or 1700-01-01")
    assert out[4].pii == ["phone", "phone", "ssn", "ip"] and out[4].text.endswith("not 300.1.1.1")
    assert re.match(r"call \(\d{3}\) \d{3}-\d{4} or \+44 \d\d \d{4} \d{4}! \d{3}-\d\d-\d{4}, host", out[4].text)
    one, two = re.findall(r"u[0-9a-f]{12}@example.org", out[5].text)
    assert one == two and out[5].text.endswith("é@ 12 v1.2.3.4")
    assert out[6].pii == ["card"] and out[8].pii == ["email"] and out[6].kind == 1
    assert pii.pseudonymise(docs.limit(0), KEY).count() == 0


def test_dates_of_timestamps(spark):
    rows = [(1, "2024-05-17"), (2, "at 2024-05-17T08:30:00Z, 2024-05-17t08:30 and 2024-05-17T, 2024-05-17Text")]
    alone, text = (r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id bigint, text string"), KEY).collect())
    assert alone != "2024-05-17"
    assert text == f"at {alone}T08:30:00Z, {alone}t08:30 and 2024-05-17T, 2024-05-17Text"
