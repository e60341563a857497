"""Seals of written tables: rows, bytes and an order-free checksum of every file, and the inputs of a version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A seal's rows.
SEAL = "table string, file string, rows long, bytes long, checksum decimal(38,0)"


def seal(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table, file, rows, bytes, checksum) of the data files of Parquet tables by name and path.

    The checksum is the sum of the rows' hashes, so it depends on what rows a file holds and not on their
    order, and one file's rows may be read by many tasks; no file is held whole. An empty file has no row here.
    """
    out = None
    for name, path in sorted(tables.items()):
        rows = spark.read.parquet(path)
        each = rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.xxhash64(*rows.columns).cast("decimal(38,0)").alias("h"))
        found = each.groupBy("file").agg(F.count("*").alias("rows"), F.max("bytes").alias("bytes"), F.sum("h").cast("decimal(38,0)").alias("checksum")).select(F.lit(name).alias("table"), "file", "rows", "bytes", "checksum")
        out = found if out is None else out.unionByName(found)
    return out


def broken_seals(spark: SparkSession, sealed: DataFrame, tables: dict[str, str]) -> DataFrame:
    """(table, file, fault) of files that are not as sealed: missing, not in the seal, or of other size, rows or content."""
    now = seal(spark, tables).select("table", "file", F.struct("rows", "bytes", "checksum").alias("now"))
    was = sealed.select("table", "file", F.struct("rows", "bytes", "checksum").alias("was"))
    fault = (
        F.when(F.col("now").isNull(), "missing")
        .when(F.col("was").isNull(), "not in the seal")
        .when(F.col("now.rows") != F.col("was.rows"), "rows differ")
        .when(F.col("now.checksum") != F.col("was.checksum"), "content differs")
        .when(F.col("now.bytes") != F.col("was.bytes"), "size differs")
    )
    return was.join(now, ["table", "file"], "full").select("table", "file", fault.alias("fault")).filter("fault is not null")


def inputs_of(sealed: DataFrame) -> DataFrame:
    """(table, files, rows, checksum): what a version was made from, one row for each input table."""
    return sealed.groupBy("table").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("checksum").cast("decimal(38,0)").alias("checksum"))
