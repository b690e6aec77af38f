"""Key/value bags: array<struct<name,value>> in document order, a later value replacing an earlier one of its key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_url, html_to_text


def tidy(bag: Column) -> Column:
    """Entries with a name and a value; a key keeps its first place and its last value."""
    good = F.filter(bag, lambda e: e["name"].isNotNull() & (e["name"] != "") & e["value"].isNotNull())
    names = F.array_distinct(F.transform(good, lambda e: e["name"]))
    return F.transform(
        names,
        lambda n: F.struct(n.alias("name"), F.element_at(F.filter(good, lambda e: e["name"] == n), -1)["value"].alias("value")),
    )


def value_of(bag: Column, key: str) -> Column:
    """The key's value, null if it is absent or empty."""
    return F.nullif(F.try_element_at(F.filter(bag, lambda e: e["name"] == key), F.lit(1))["value"], F.lit(""))


def first_where(bag: Column, test) -> Column:
    return F.try_element_at(F.filter(bag, test), F.lit(1))["value"]


def description(raw: Column, bag: Column) -> Column:
    """The text of the raw description, or 'key: value' lines of the bag without its coordinates."""
    lines = F.transform(
        F.filter(bag, lambda e: ~F.rlike(e["name"], F.lit("(?i)latitude|longitude"))),
        lambda e: F.concat(e["name"], F.lit(": "), e["value"]),
    )
    return F.when(F.coalesce(raw, F.lit("")) != "", html_to_text(raw)).otherwise(F.array_join(lines, "\n"))


def website(bag: Column, raw: Column) -> Column:
    """The first address under a key that speaks of one, else the first address in the raw description."""
    own = first_where(
        bag, lambda e: F.rlike(e["name"], F.lit("(?i)website|url|link")) & F.startswith(e["value"], F.lit("http"))
    )
    return F.coalesce(own, first_url(raw))


def address(bag: Column) -> Column:
    """'city, state', or the first value under a key that speaks of an address."""
    city = F.coalesce(value_of(bag, "Location City"), value_of(bag, "City"))
    state = F.coalesce(value_of(bag, "Location State"), value_of(bag, "State"))
    other = first_where(bag, lambda e: F.contains(F.lower(e["name"]), F.lit("address")))
    return F.coalesce(F.nullif(F.concat_ws(", ", city, state), F.lit("")), other)
