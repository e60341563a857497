"""Keyed append log: newest wins, deletes as tombstones, compaction with a change tally."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: What a log row says.
PUT, REMOVE, ASKED = "put", "remove", "asked"


def newest(log: DataFrame, key: list[str], order: list[str], *, removed: Column | None = None) -> DataFrame:
    """Last row of each key by write order; keys whose last row is a tombstone are gone.

    A map-side maximum, so a key with any number of rows moves one row from each task.
    """
    rest = [c for c in log.columns if c not in key]
    last = log.groupBy(*key).agg(F.max_by(F.struct(*rest, (removed if removed is not None else F.lit(False)).alias("_gone")), F.struct(*order)).alias("_row"))
    return last.filter(~F.coalesce(F.col("_row._gone"), F.lit(False))).select(*key, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*log.columns)


def merged(base: DataFrame, *deltas: DataFrame, key: list[str], removed: str) -> DataFrame:
    """Base rows overlaid by deltas, oldest first; a delta row with `removed` true deletes its key.

    Reading the layers merged gives what packing them and then reading gives.
    """
    layers = base.withColumn("_layer", F.lit(0))
    for k, delta in enumerate(deltas, 1):
        layers = layers.unionByName(delta.withColumn("_layer", F.lit(k)))
    return newest(layers, key, ["_layer"], removed=F.col(removed)).drop("_layer")


def asked_since_removal(log: DataFrame, key: str, op: str, order: str) -> DataFrame:
    """Keys with the flag whether they were asked for after their last removal (or were never removed and asked)."""
    at = log.groupBy(key).agg(F.max(F.when(F.col(op) == ASKED, F.col(order))).alias("a"), F.max(F.when(F.col(op) == REMOVE, F.col(order))).alias("r"))
    return at.select(key, (F.col("a").isNotNull() & (F.col("r").isNull() | (F.col("a") > F.col("r")))).alias("asked"))


def change_tally(old: DataFrame, new: DataFrame, key: str, value: str, bucket: Column) -> DataFrame:
    """Keys added, replaced (value differs) and removed from old to new, by bucket of the key."""
    a = old.select(key, F.col(value).alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select(key, F.col(value).alias("_new"), F.lit(True).alias("_in_new"))
    both = a.join(b, key, "full").withColumn("bucket", bucket)
    count = lambda c: F.count_if(c).cast("long")
    return both.groupBy("bucket").agg(
        count(F.col("_in_old").isNull()).alias("added"),
        count(F.col("_in_old").isNotNull() & F.col("_in_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("replaced"),
        count(F.col("_in_new").isNull()).alias("removed"),
    )
