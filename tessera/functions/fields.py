"""Ordered name and value lists: open-ended attributes that are not columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def make_fields(pairs: dict[str, Column]) -> Column:
    """A fields list of the pairs with non-null values, in order."""
    each = F.array(*(F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs.items()))
    return F.filter(each, lambda f: f["value"].isNotNull())


def values_of(fields: Column, name: str) -> Column:
    """All values of a name in source order."""
    return F.transform(F.filter(fields, lambda f: f["name"] == name), lambda f: f["value"])


def first_of(fields: Column, name: str) -> Column:
    """First value of a name; null without one."""
    return F.get(values_of(fields, name), 0)


def pivot(fields: Column, names: list[str]) -> list[Column]:
    """One list column for each name."""
    return [values_of(fields, n).alias(n) for n in names]


def as_json_lists(fields: Column) -> tuple[Column, Column]:
    """Names and values as two parallel JSON lists."""
    return F.to_json(F.transform(fields, lambda f: f["name"])), F.to_json(F.transform(fields, lambda f: f["value"]))


def differing_names(a: Column, b: Column) -> Column:
    """Sorted distinct names of the pairs that only one of two lists has."""
    return F.array_sort(F.array_distinct(F.transform(F.concat(F.array_except(a, b), F.array_except(b, a)), lambda f: f["name"])))
