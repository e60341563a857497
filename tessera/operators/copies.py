"""Which of several copies of a record is kept, and in what the others differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_copies(df: DataFrame, key: list[str], dated: Column, order: list[Column]) -> DataFrame:
    """df with `copy`, 1 for the kept row of each key.

    The newest date wins if all copies of the key have one; ties, and keys with an undated copy,
    go by the order. Keys have few copies, so the window stays small.
    """
    w = Window.partitionBy(*key)
    # Spark counts no partial sums over a window, but the copies of a key are few
    return (
        df.withColumn("_date", dated)
        .withColumn("_all", F.count_if(F.col("_date").isNull()).over(w) == 0)
        .withColumn("copy", F.row_number().over(w.orderBy(F.when(F.col("_all"), F.col("_date")).desc_nulls_last(), *order)))
        .drop("_date", "_all")
    )


def kept(df: DataFrame, key: list[str], dated: Column, order: list[Column]) -> DataFrame:
    """The kept copy of each key."""
    return rank_copies(df, key, dated, order).filter("copy = 1").drop("copy")


def least(df: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Values of the row of each key that comes first by the order, nulls last; a map-side minimum."""
    by = F.struct(*(x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))))
    row = df.groupBy(*key).agg(F.min_by(F.struct(*values), by).alias("_row"))
    return row.select(*key, *(F.col(f"_row.{v}").alias(v) for v in values))


def differing(ranked: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys whose other copies differ from the kept one, with the sorted names of the differing columns."""
    kept_row = ranked.filter("copy = 1").select(*key, F.struct(*columns).alias("_k"))
    others = ranked.filter("copy > 1").select(*key, F.struct(*columns).alias("_o"))
    names = F.filter(F.array(*(F.when(~F.col(f"_k.{c}").eqNullSafe(F.col(f"_o.{c}")), F.lit(c)) for c in columns)), lambda x: x.isNotNull())
    each = others.join(kept_row, key).select(*key, F.explode(names).alias("_name"))
    return each.groupBy(*key).agg(F.array_sort(F.collect_set("_name")).alias("differs"))


def repeated_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value, with their number."""
    return df.select(key, value).distinct().groupBy(key).agg(F.count("*").cast("long").alias("n_values")).filter("n_values > 1")
