"""Shared pieces of the training-data operators: table access, the shared folder, bounded label samples."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where that is unset in a session on one machine a temporary folder is made and set as
    the checkpoint folder; on a cluster that would lose data, and ValueError is raised.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tessera/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """df through checkpoint() in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fold(key: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; null ids are in fold null."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n))


def label_sample(labels: DataFrame, column: str, per_value: int, values: tuple[int, ...], keep: Column) -> DataFrame:
    """Ids of at most per_value rows for each label value, picked by hash order of the id.

    The result has at most per_value * len(values) rows, which is what makes it safe to broadcast.
    """
    parts = []
    for v in values:
        part = labels.filter((F.col(column) == v) & keep & F.col("doc_id").isNotNull()).select("doc_id", F.col(column).cast("int").alias("label"))
        parts.append(part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_value))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mapped(docs: DataFrame, run, results: str, carry: list[str]) -> DataFrame:
    """Rows of docs with result columns that run(rows) computes from a struct array of whole rows.

    The output has one struct column "row" with the carried columns of docs, so results never
    clash with columns of the same name, and the result columns beside it.
    """
    kinds = [StructField(c, docs.schema[c].dataType) for c in carry]
    schema = StructType([StructField("row", StructType(kinds)), *_parse_ddl(results)])
    names = [f.name for f in schema]

    def go(batches):
        for batch in batches:
            rows = batch.column("row")
            kept = [pc.struct_field(rows, c) for c in carry]
            row = pa.StructArray.from_arrays(kept, names=carry)
            yield pa.RecordBatch.from_arrays([row, *run(rows)], names=names)

    return docs.select(F.struct(*docs.columns).alias("row")).mapInArrow(go, schema)


def _parse_ddl(ddl: str) -> list[StructField]:
    return list(StructType.fromDDL(ddl))
