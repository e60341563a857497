"""Records and links from marked-up source text.

One Arrow function turns XML into ordered (path, value) rows, which built-in functions cannot do
in document order; what records and links are is then stated as rules over those rows.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.functions import text as tx


def _flat(element: ET.Element, path: str) -> Iterator[tuple[str, str]]:
    """(path, value) of attributes, then own text, then children, in document order."""
    for name, value in element.attrib.items():
        yield f"{path}@{name}", value
    own = (element.text or "").strip()
    if own:
        yield path, own
    for child in element:
        yield from _flat(child, f"{path}/{child.tag}")


def flatten_xml(df: DataFrame, key: str = "key", text: str = "raw_text") -> DataFrame:
    """(key, pos, path, value) for each attribute and text of each row's XML; text that is no XML gives one row of path "!error"."""

    def run(batches):
        for batch in batches:
            keys, places, paths, values = [], [], [], []
            for k, body in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                try:
                    root = ET.fromstring(body) if body else None
                    rows = list(_flat(root, root.tag)) if root is not None else []
                except ET.ParseError as error:
                    rows = [("!error", str(error))]
                keys += [k] * len(rows)
                places += range(len(rows))
                paths += [p for p, _ in rows]
                values += [v for _, v in rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(places, pa.int64()), pa.array(paths, pa.string()), pa.array(values, pa.string())], names=["key", "pos", "path", "value"])

    return df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key string, pos long, path string, value string")


def records_of(flat: DataFrame, typed: dict[str, str]) -> DataFrame:
    """(key, one column for each typed path, fields): first values by path, and all pairs as an ordered field list."""
    first = [F.min_by(F.when(F.col("path") == p, F.col("value")), F.when(F.col("path") == p, F.col("pos"))).alias(c) for c, p in typed.items()]
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("pos", "path", "value"))), lambda s: F.struct(s["path"].alias("name"), s["value"].alias("value")))
    return flat.groupBy("key").agg(*first, pairs.alias("fields"))


def links_of(flat: DataFrame, rules: list[tuple[str, str, str]], source: str) -> DataFrame:
    """Links (from, to, relation, source) from rules (path, relation, pattern of the far end); ends outside their pattern are none."""
    parts = [
        flat.filter((F.col("path") == path) & F.col("value").rlike(f"^{pattern}$")).select(F.col("key").alias("from"), F.col("value").alias("to"), F.lit(relation).alias("relation"), F.lit(source).alias("source"))
        for path, relation, pattern in rules
    ]
    return reduce(DataFrame.union, parts).distinct()


def tagged_records(df: DataFrame, text: str = "raw_text") -> DataFrame:
    """(entity, key, raw_text, fields) of line-tagged text with several entities a row."""
    blocks = df.select(F.explode(tx.entity_blocks(F.col(text))).alias("b"))
    return blocks.select("b.entity", "b.key", F.col("b.body").alias("raw_text"), tx.tagged_fields(F.col("b.body")).alias("fields"))


def relation_links(records: DataFrame, names: dict[str, tuple[str, str, bool]], source: str) -> DataFrame:
    """Links from relation fields "label: far end": names gives label -> (relation, pattern in the far end, reverse).

    A label that names does not hold keeps its own name with the far end as it stands; a field
    without a far end raises.
    """
    each = records.select("key", F.explode("fields").alias("f")).filter(F.col("f.name").endswith("_relation"))
    label = F.trim(F.regexp_extract("f.value", r"^([^:]+):", 1))
    far = F.trim(F.regexp_extract("f.value", r"^[^:]+:\s*(.*)$", 1))
    far = F.when(far == "", F.raise_error(F.concat(F.lit("relation without a far end: "), "f.value"))).otherwise(far)
    relation, end, back = label, far, F.lit(False)
    for name, (r, pattern, reverse) in names.items():
        here = label == name
        relation = F.when(here, F.lit(r)).otherwise(relation)
        end = F.when(here, F.regexp_extract(far, f"({pattern})", 1)).otherwise(end)
        back = F.when(here, F.lit(reverse)).otherwise(back)
    rows = each.select("key", relation.alias("relation"), end.alias("end"), back.alias("back"))
    return rows.select(F.when(F.col("back"), F.col("end")).otherwise(F.col("key")).alias("from"), F.when(F.col("back"), F.col("key")).otherwise(F.col("end")).alias("to"), "relation", F.lit(source).alias("source")).distinct()


def read_structure(lengths: str = "lengths"):
    """Read lengths as text, halves to even, such as 28+94; zero lengths are left out."""
    return F.array_join(F.transform(F.filter(lengths, lambda n: F.bround(n) > 0), lambda n: F.bround(n).cast("long").cast("string")), "+")
