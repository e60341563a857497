"""Checks of finished tables: order, cell-by-cell comparison, recomputed hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def differing_cells(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """(column, cells, first): for every column the number of differing cells of rows in both, and the least key with one.

    Rows on one side only count under the column "(row)".
    """
    values = [c for c in a.columns if c not in key]
    x = a.select(*key, F.struct(*values).alias("_a"), F.lit(True).alias("_ia"))
    y = b.select(*key, F.struct(*values).alias("_b"), F.lit(True).alias("_ib"))
    both = x.join(y, key, "full")
    whole = F.col("_ia").isNull() | F.col("_ib").isNull()
    names = F.array(F.when(whole, F.lit("(row)")), *(F.when(~whole & ~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in values))
    each = both.select(F.struct(*key).alias("_key"), F.explode(F.filter(names, lambda n: n.isNotNull())).alias("column"))
    return each.groupBy("column").agg(F.count("*").cast("long").alias("cells"), F.min("_key").alias("first"))


def wrong_hashes(df: DataFrame, text: str, sha256: str) -> DataFrame:
    """(rows, wrong): rows, and rows whose stored hash is not that of their text; the text never leaves its task."""
    return df.agg(F.count("*").cast("long").alias("rows"), F.count_if(~F.sha2(text, 256).eqNullSafe(F.col(sha256))).cast("long").alias("wrong"))


def out_of_order(path_rows: DataFrame, key: list[str]) -> DataFrame:
    """(file, rows): rows of each file that are less than the row before; for tables read with their file metadata.

    Each file is checked by its own row numbers, so files need no common order.
    """
    from pyspark.sql import Window

    at = path_rows.select(*key, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row"))
    k = F.struct(*(x for c in key for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))))
    before = F.lag(k).over(Window.partitionBy("file").orderBy("_row"))
    return at.withColumn("_bad", F.coalesce(k < before, F.lit(False))).groupBy("file").agg(F.count_if("_bad").cast("long").alias("rows"))
