"""Text cleaning with the semantics of browser strings: trim, number prefixes, HTML, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a browser trims it; Spark's trim takes blanks alone.
SPACE = r"[\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
# What counts as an address in a text, and what stays outside of it.
URL = r"""https?://[^\s<>"]+"""
PLAIN_URL = r"""(?i)(?:https?://|www\.)[^\s<]+[^\s<.,;:!?)'\]"]*"""
TRAILING = r"[),.!?:;]+$"
# What sanitising lets through.
ALLOWED_TAGS = ["h2", "h3", "p", "ul", "ol", "li", "a", "strong", "em", "br"]


def trim(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or null if nothing is left."""
    return F.nullif(trim(text), F.lit(""))


def strip_cdata(text: Column) -> Column:
    """Without a CDATA wrapper; null (not a string) gives the empty string."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(text, r"^<!\[CDATA\[", ""), r"\]\]>$", ""), F.lit(""))


def html_to_text(text: Column) -> Column:
    """Line breaks for br tags, other tags dropped, trimmed."""
    return trim(F.regexp_replace(F.regexp_replace(text, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", ""))


def number_prefix(text: Column) -> Column:
    """The number that a text begins with (after white space), null if there is none."""
    number = F.regexp_extract(trim(text), r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?", 0)
    return F.nullif(number, F.lit("")).try_cast("double")


def in_range(lng: Column, lat: Column) -> Column:
    """Inside the globe's bounds, which belong to it; false for NaN, which sorts above all numbers, and for null."""
    good = lng.between(-180, 180) & lat.between(-90, 90) & ~F.isnan(lng) & ~F.isnan(lat)
    return F.coalesce(good, F.lit(False))


def parse_coordinates(text: Column) -> Column:
    """'lng,lat[,altitude]' -> struct<lng,lat>, null if it isn't that or out of range."""
    parts = F.split(trim(text), ",")
    lng, lat = (number_prefix(F.get(parts, i)) for i in (0, 1))
    return F.when(in_range(lng, lat), F.struct(lng.alias("lng"), lat.alias("lat")))


def first_url(text: Column) -> Column:
    return F.regexp_substr(text, F.lit(URL))


def has_anchor(text: Column) -> Column:
    return F.rlike(text, F.lit(r"(?i)<a\b"))


def escape_html(text: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def escape_attribute(text: Column) -> Column:
    return F.replace(escape_html(text), F.lit("'"), F.lit("&#39;"))


def linkify(text: Column) -> Column:
    """Addresses become anchors, all else is escaped; punctuation after an address stays outside."""

    def anchor(match: Column) -> Column:
        url = F.regexp_replace(match, TRAILING, "")
        rest = F.substr(match, F.length(url) + 1)
        target = F.when(F.startswith(url, F.lit("www.")), F.concat(F.lit("https://"), url)).otherwise(url)
        return F.concat(
            F.lit('<a href="'), escape_attribute(target), F.lit('">'), escape_html(url), F.lit("</a>"), escape_html(rest)
        )

    links = F.transform(F.regexp_extract_all(text, F.lit(PLAIN_URL), F.lit(0)), anchor)
    gaps = F.transform(F.split(text, PLAIN_URL, -1), escape_html)
    return F.array_join(F.zip_with(gaps, links, lambda g, a: F.concat(g, F.coalesce(a, F.lit("")))), "")


def prepare_description(text: Column) -> Column:
    """Blank: empty; with anchors: as it is; else with its addresses linked."""
    return F.when(trim(text) == "", F.lit("")).when(has_anchor(text), text).otherwise(linkify(text))


def sanitise(text: Column) -> Column:
    """Listed tags only, without attributes but href, links opening apart. A display filter, no security boundary."""
    listed = "|".join(ALLOWED_TAGS)
    kept = F.regexp_replace(prepare_description(text), r"(?is)<(script|style)\b.*?</\1\s*>", "")
    kept = F.regexp_replace(kept, rf"(?i)<(?!/?(?:{listed})\b)[^>]*>", "")
    kept = F.regexp_replace(kept, rf"(?i)<(?!a\b)({listed})\b[^>]*>", "<$1>")
    href = r"""(?i)<a\b[^>]*?\bhref="(https?://[^"]*|mailto:[^"]*|/[^"]*)"[^>]*>"""
    linked = F.regexp_replace(kept, href, '<a href="$1" target="_blank" rel="noopener noreferrer">')
    return F.regexp_replace(linked, r"(?i)<a\b(?! href=\"[^\"]*\" target=\"_blank\" rel=)[^>]*>", "<a>")


def url_label(url: Column) -> Column:
    return F.regexp_replace(url, r"^https?://(www\.)?", "")


def fixed4(lat: Column, lng: Column) -> Column:
    return F.format_string("%.4f, %.4f", lat, lng)


def strip_slashes(url: Column) -> Column:
    return F.regexp_replace(url, "/+$", "")


def join_path(base: Column, path: Column) -> Column:
    return F.concat(strip_slashes(base), F.lit("/"), F.regexp_replace(path, "^/+", ""))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def pascal_case(text: Column) -> Column:
    parts = F.filter(F.split(text, "[^a-zA-Z0-9]+"), lambda p: p != "")
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), ""
    )


def before_dash(text: Column) -> Column:
    return F.substring_index(text, "-", 1)


def round_half_up(number: Column) -> Column:
    """To the nearest integer, halves upward for negatives too."""
    return F.floor(number + 0.5)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://(?:[^@/]*@)?([^:/?]+)", 1)


def major_version(text: Column) -> Column:
    return F.regexp_extract(text, r"([0-9]+)(?:\.[0-9]+)*", 1).try_cast("int")


def executable_lines(sql: Column) -> Column:
    """SQL text without client commands and without the two lines that recreate the default schema."""
    skipped = ["CREATE SCHEMA public;", "COMMENT ON SCHEMA public IS 'standard public schema';"]
    kept = F.filter(F.split(sql, r"\r?\n"), lambda x: ~F.startswith(x, F.lit("\\")) & ~trim(x).isin(skipped))
    return F.array_join(kept, "\n")


def wants_transaction(sql: Column) -> Column:
    return ~F.exists(F.split(sql, r"\r?\n"), lambda x: trim(x) == "-- cursor:no-transaction")
