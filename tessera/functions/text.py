"""Column expressions on semi-structured text: elements, entity blocks, listings, addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def elements(source: Column, tag: str) -> Column:
    """Every <tag ...>...</tag> or <tag .../> of the text as it stands, for elements that do not nest in themselves."""
    return F.regexp_extract_all(F.coalesce(source, F.lit("")), F.lit(rf"(?s)(<{tag}(?:\s[^>]*)?/>|<{tag}(?:\s[^>]*)?>.*?</{tag}>)"), F.lit(1))


def attribute(element: Column, name: str) -> Column:
    """Value of an attribute in the first tag of an element; null without it."""
    return F.nullif(F.regexp_extract(element, rf'^<[^>]*?\s{name}="([^"]*)"', 1), F.lit(""))


def inner_text(element: Column) -> Column:
    """Text of an element without tags, white space made single."""
    return F.trim(F.regexp_replace(F.regexp_replace(element, r"<[^>]*>", " "), r"\s+", " "))


def hrefs(source: Column) -> Column:
    """Targets of href attributes in order."""
    return F.regexp_extract_all(F.coalesce(source, F.lit("")), F.lit('href="([^"]*)"'), F.lit(1))


def entity_blocks(text: Column) -> Column:
    """Blocks of line-tagged text: each starts at a line ^NAME = KEY; array of (entity, key, body), bodies as served."""
    parts = F.filter(F.split(text, r"(?m)^(?=\^)"), lambda b: b.startswith("^"))
    return F.transform(parts, lambda b: F.struct(F.regexp_extract(b, r"^\^([A-Za-z]+)\s*=", 1).alias("entity"), F.trim(F.regexp_extract(b, r"^\^[A-Za-z]+\s*=\s*([^\r\n]*)", 1)).alias("key"), b.alias("body")))


def tagged_fields(body: Column) -> Column:
    """(name, value) pairs of the lines !name = value outside tables; empty values are left out."""
    plain = strip_tables(body)
    lines = F.filter(F.split(plain, r"\r?\n"), lambda s: s.rlike(r"^![^=]+=\s*\S"))
    return F.transform(lines, lambda s: F.struct(F.trim(F.regexp_extract(s, r"^!([^=]+?)\s*=", 1)).alias("name"), F.trim(F.regexp_extract(s, r"^![^=]+=(.*)$", 1)).alias("value")))


def relation_lines(text: Column, entity: str) -> Column:
    """(label, far) of the relation lines of an entity in line-tagged text: what stands before and behind the first colon."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda s: s.startswith(f"!{entity}_relation"))
    stated = F.transform(lines, lambda s: F.trim(F.regexp_replace(s, r"^[^=]*=", "")))
    return F.transform(stated, lambda v: F.struct(F.trim(F.substring_index(v, ":", 1)).alias("label"), F.trim(F.regexp_replace(v, r"^[^:]*:?", "")).alias("far")))


def strip_tables(text: Column) -> Column:
    """Line-tagged text without its sample and platform tables."""
    return F.regexp_replace(text, r"(?ims)^!(sample|platform)_table_begin.*?^!(sample|platform)_table_end[^\n]*(\n|\z)", "")


def tokens(text: Column, separators: str = r"[;,\s]+") -> Column:
    """Non-empty pieces between separators."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda x: x != "")


def number_tokens(text: Column) -> Column:
    """Pieces between white space that are numbers."""
    return F.filter(tokens(text, r"\s+"), lambda x: x.rlike(r"^[0-9]+$"))


def first_line_and_rest(text: Column) -> tuple[Column, Column]:
    """Text before the first line break, and after it (empty without one)."""
    at = F.locate("\n", text)
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text), F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(F.lit(""))


def last_segment(url: Column) -> Column:
    """Last path segment of an address, without query and fragment."""
    return F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1)


def host(url: Column) -> Column:
    """Host of an address; empty if it has none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def query_value(url: Column, key: str) -> Column:
    """Value of a query key; null without it."""
    return F.nullif(F.regexp_extract(url, rf"[?&]{key}=([^&#]*)", 1), F.lit(""))


def text_from_places(index: Column) -> Column:
    """Words of a map from word to places, in order of place."""
    each = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(each), lambda s: s["w"]), " ")
