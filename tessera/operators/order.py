"""Ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.sources.scratch import cut


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with its place (from 0) in the order; rows that tie get places in some order.

    Rows go to ranges of the order, each range is numbered on its own, and the sizes of the ranges
    before it are added. Only one count for each range reaches the driver. The ranges are written
    down first, so that counts and places are of the same ranges.
    """
    ranges = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = {r["_range"]: r["count"] for r in ranges.groupBy("_range").count().collect()}
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    start = F.get(F.lit(before or [0]), F.col("_range"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1 + start
    return ranges.withColumn(name, place.cast("long")).drop("_range")


def quantiles(df: DataFrame, key: str, n: int) -> DataFrame:
    """(k, cut) for k = 1..n-1: the exact discrete k/n quantiles of a key of any ordered type."""
    keys = ranked(df.select(F.col(key).alias("cut")).filter("cut is not null"), [F.col("cut")])
    total = keys.count()
    if not total:
        return keys.select(F.lit(None).cast("long").alias("k"), "cut")
    places: dict[int, list[int]] = {}
    for k in range(1, n):
        places.setdefault(-(-k * total // n) - 1, []).append(k)
    of = F.create_map(*(F.lit(x) for pair in places.items() for x in pair))
    at = keys.filter(F.col("rank").isin(list(places)))
    return at.select(F.explode(of[F.col("rank").cast("int")]).alias("k"), "cut").select(F.col("k").cast("long").alias("k"), "cut")


def natural_rank(df: DataFrame, key: str) -> DataFrame:
    """df with `place`: natural order (prefix, length, text) of the key within each prefix, from 0."""
    from tessera.functions.keys import prefix_of

    prefix = prefix_of(F.col(key))
    rows = ranked(df.withColumn("_prefix", prefix), [F.col("_prefix"), F.length(key), F.col(key)])
    first = rows.groupBy("_prefix").agg(F.min("rank").alias("_first"))
    return rows.join(first, "_prefix").withColumn("place", F.col("rank") - F.col("_first")).drop("_prefix", "_first", "rank").select(*df.columns, "place")
