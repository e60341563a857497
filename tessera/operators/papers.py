"""Keyed tables with rules: status ladders, latest attempts, re-keying, alias lookups, constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


class BrokenRule(ValueError):
    """A table breaks its key, vocabulary or not-null rules."""


def latest(attempts: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last attempt of each key; the later row of a tie is the one the order puts last."""
    rest = [c for c in attempts.columns if c not in key]
    row = attempts.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return row.select(*key, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*attempts.columns)


def ladder(rules: list[tuple[Column, str, str]], otherwise: tuple[str, str]) -> tuple[Column, Column]:
    """(status, reason) of the first rule that holds; a null condition does not hold."""
    status, reason = F.lit(otherwise[0]), F.lit(otherwise[1])
    for test, s, r in reversed(rules):
        test = F.coalesce(test, F.lit(False))
        status, reason = F.when(test, F.lit(s)).otherwise(status), F.when(test, F.lit(r)).otherwise(reason)
    return status.alias("status"), reason.alias("reason")


def counted(df: DataFrame, columns: list[str], all_values: DataFrame) -> DataFrame:
    """Counts by the columns, 0 for the combinations in all_values that do not occur."""
    n = df.groupBy(*columns).agg(F.count("*").cast("long").alias("n"))
    return all_values.join(n, columns, "left").select(*columns, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def rekeyed(df: DataFrame, moves: DataFrame, key: str, unique: list[str], order: list[str]) -> DataFrame:
    """Rows moved to their canonical key (moves: old, new); of rows that then collide on `unique` the first by order stays."""
    m = moves.select(F.col("old").alias(key), F.col("new").alias("_new"))
    moved = df.join(m, key, "left").withColumn("_moved", F.col("_new").isNotNull()).withColumn(key, F.coalesce("_new", key))
    w = Window.partitionBy(*unique).orderBy("_moved", *order)
    return moved.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*df.columns)


def merged_lists(df: DataFrame, key: str, lists: list[str]) -> DataFrame:
    """Rows of one key merged: each list column as the sorted union."""
    return df.groupBy(key).agg(*(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists))


def alias_lookup(wanted: DataFrame, table: DataFrame, key: str, alias: str) -> DataFrame:
    """(wanted, key) by key, else by an element of the alias list; the smallest key if several rows have the alias.

    Two equi-joins in place of a disjunctive one, so nothing is compared crosswise.
    """
    w = wanted.select("wanted").distinct()
    direct = w.join(table.select(F.col(key).alias("wanted")).distinct(), "wanted").select("wanted", F.col("wanted").alias(key), F.lit(0).alias("_via"))
    other = table.select(F.explode(alias).alias("wanted"), key)
    indirect = w.join(other, "wanted").groupBy("wanted").agg(F.min(key).alias(key)).select("wanted", key, F.lit(1).alias("_via"))
    return direct.union(indirect).groupBy("wanted").agg(F.min_by(key, "_via").alias(key))


def check_rules(df: DataFrame, key: list[str], not_null: list[str] = (), vocabulary: dict[str, list[str]] | None = None) -> None:
    """Raise BrokenRule for a null in the key or a not-null column, a word outside a vocabulary, or a repeated key."""
    bad = [F.count_if(F.col(c).isNull()).alias(f"null in {c}") for c in dict.fromkeys([*key, *not_null])]
    bad += [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v)).alias(f"unknown word in {c}") for c, v in (vocabulary or {}).items()]
    found = {k: n for k, n in df.agg(*bad).first().asDict().items() if n}
    if found:
        raise BrokenRule(", ".join(f"{k}: {n} rows" for k, n in found.items()))
    twice = df.groupBy(*key).count().filter("count > 1").limit(3).collect()
    if twice:
        raise BrokenRule(f"repeated key {[tuple(r)[:-1] for r in twice]}")


def ranked_new_first(df: DataFrame, group: list[str], first: str, second: str, key: str) -> DataFrame:
    """df with `place` by newest first date, then newest second date, nulls last, then key; from 1 in each group."""
    w = Window.partitionBy(*group).orderBy(F.col(first).desc_nulls_last(), F.col(second).desc_nulls_last(), key)
    return df.withColumn("place", F.row_number().over(w).cast("long"))


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Lower and upper end of the 95 % Wilson interval of a proportion; null for no trials."""
    p, m = hits / n, n.cast("double")
    mid, half = p + z * z / (2 * m), z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))
    return (mid - half) / (1 + z * z / m), (mid + half) / (1 + z * z / m)


def papers_for(links: DataFrame, store: DataFrame, files: DataFrame) -> DataFrame:
    """(accession, paper, status, n_files) of links (accession, paper): the store's status, or that it lacks the paper; files with a path are held."""
    held = files.groupBy("paper").agg(F.count("path").cast("long").alias("n_files"))
    both = links.distinct().join(store.select("paper", "status"), "paper", "left").join(held, "paper", "left")
    return both.select("accession", "paper", F.coalesce("status", F.lit("not in the store")).alias("status"), F.coalesce("n_files", F.lit(0).cast("long")).alias("n_files"))
