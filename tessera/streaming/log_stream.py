"""The keyed log as a stream: change rows arrive, the newest row of each key stands in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.log import newest


class LogTable:
    """Newest row per key, kept as numbered layers under a folder.

    Every micro-batch writes the layer of its number, once: a batch that is replayed after a
    failure overwrites its own layer, so the result is the same as if it had run once.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: list[str], removed: str | None = None) -> None:
        self.spark, self.path, self.key, self.order, self.removed = spark, path.rstrip("/"), key, order, removed

    def upsert(self, batch: DataFrame, number: int) -> None:
        """foreachBatch sink. Tombstones stay in the layers, so that they still cover older rows."""
        newest(batch, self.key, self.order).write.mode("overwrite").parquet(f"{self.path}/layer={number}")

    def read(self) -> DataFrame:
        """The current rows over all layers."""
        rows = self.spark.read.parquet(self.path)
        return newest(rows, self.key, ["layer", *self.order], removed=F.col(self.removed) if self.removed else None).drop("layer")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(stream: DataFrame, time: str, kind: str, *, size: str = "1 day", late: str = "3 days") -> DataFrame:
    """Rows by time window and kind, finished once the watermark has passed: the look-back of `late` as a bounded-lateness rule."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
