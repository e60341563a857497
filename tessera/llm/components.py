"""Connected components of an edge table by minimum-label propagation with label shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed

#: Keys that are split over several tasks, at most: those with more than this share of all rows.
HOT_KEYS = 2000


def hot_keys(rows: DataFrame, key: str, total: int) -> DataFrame:
    """(key, splits) of keys with more than total / HOT_KEYS rows, hence at most HOT_KEYS of them; counts are summed before they are shuffled."""
    most = max(1, total // HOT_KEYS)
    counts = rows.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).filter(F.col("n") > most)
    return F.broadcast(counts.select("key", F.least(F.ceil(F.col("n") / most), F.lit(HOT_KEYS)).cast("int").alias("splits")))


def looked_up(rows: DataFrame, key: str, spread: str, table: DataFrame, value: str, hot: DataFrame) -> DataFrame:
    """rows with the value that table (key, value; each key once) has for their key, null if none.

    Rows of a hot key go to as many tasks as it has splits, by a hash of their column spread, and
    the table's row of that key to each of them.
    """
    splits = hot.select(F.col("key").alias(key), "splits")
    left = rows.join(splits, key, "left").withColumn("_salt", F.when(F.col("splits").isNotNull(), F.pmod(F.xxhash64(spread), F.col("splits"))).otherwise(F.lit(0)).cast("int")).drop("splits")
    right = table.select(F.col("key").alias(key), F.col("value").alias(value)).join(splits, key, "left")
    right = right.select(key, value, F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)).alias("_salt"))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every node of the edges (a, b); label is the smallest id of its component.

    Each round takes the least of a node's label, its neighbours' labels and the label of its own
    label, so chains shrink geometrically; the loop ends when no label changes. A node with very many
    neighbours, or a label of very many nodes, is looked up in several tasks. Only one count a round
    reaches the driver. Self links and repeated edges do no harm; no edges give no rows.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    total = both.count()
    hubs = hot_keys(both, "b", total)
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")))
    while True:
        table = labels.select(F.col("id").alias("key"), F.col("label").alias("value"))
        near = looked_up(both, "b", "a", table, "label", hubs).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("m"))
        up = looked_up(labels, "label", "id", table, "root", hot_keys(labels, "label", total))
        least = F.least("label", F.coalesce("root", "label"), F.coalesce("m", "label"))
        nxt = checkpointed(up.join(near, "id", "left").select("id", F.col("label").alias("was"), least.alias("label")))
        changed = nxt.filter("was <> label").limit(1).count()
        labels = nxt.select("id", "label")
        if not changed:
            return labels
