"""The raw log on disk: parts of puts, removals and asked keys over a packed base."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.keys import bucket_of
from tessera.operators import log

_STATE = "base long, covers long, name string, counts string"
_ROW = "accession string, raw_text string, hash string, fetch_date string, op string"


class RawLog:
    """Rows of one source by accession under a folder.

    parts/part=N holds what was appended N-th, base/name=X what a packing has left, and state the JSON
    row of each packing: its number, the last part it covers and its base's name. A reader takes the
    newest state row, its base and the parts after it, so a packing that broke off changes nothing,
    and reads before and after a packing agree. Two packings at a time write apart; of two of one
    number the one that covers more counts, then the one of the later name.
    """

    def __init__(self, spark: SparkSession, path: str, width: int = 1000) -> None:
        self.spark, self.path, self.width = spark, path.rstrip("/"), width

    def _read(self, folder: str, schema: str, kind: str = "parquet") -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).format(kind).load(f"{self.path}/{folder}")
        except AnalysisException:  # nothing written there yet
            return None

    def _state(self) -> tuple[int, int, str]:
        """Number, covered parts and base's name of the newest packing."""
        rows = self._read("state", _STATE, "json")
        last = None if rows is None else rows.orderBy(*(F.col(c).desc() for c in ("base", "covers", "name"))).first()
        return (0, 0, "") if last is None else (last.base, last.covers, last.name)

    def append(self, number: int, rows: DataFrame) -> None:
        """Add puts (accession, raw_text, fetch_date) as part `number`; a part that is written again replaces itself."""
        self._write(number, rows.select("accession", "raw_text", F.sha2("raw_text", 256).alias("hash"), F.col("fetch_date").cast("string"), F.lit(log.PUT).alias("op")))

    def remove(self, number: int, keys: DataFrame) -> None:
        """Add removals of keys (accession)."""
        self._write(number, self._bare(keys, log.REMOVE))

    def ask(self, number: int, keys: DataFrame) -> None:
        """Note keys (accession) that were asked for and gave nothing."""
        self._write(number, self._bare(keys, log.ASKED))

    @staticmethod
    def _bare(keys: DataFrame, op: str) -> DataFrame:
        none = F.lit(None).cast("string")
        return keys.select("accession", none.alias("raw_text"), none.alias("hash"), none.alias("fetch_date"), F.lit(op).alias("op")).distinct()

    def _write(self, number: int, rows: DataFrame) -> None:
        rows.sortWithinPartitions("accession").write.mode("overwrite").parquet(f"{self.path}/parts/part={number}")

    def layers(self, wanted: DataFrame | None = None) -> DataFrame:
        """All rows that count, with `part` as write order; wanted (accession) narrows them before anything is shuffled."""
        base, covers, name = self._state()
        out = self.spark.createDataFrame([], f"{_ROW}, part long")
        if base and (rows := self._read(f"base/name={name}", _ROW)) is not None:
            out = out.union(rows.withColumn("part", F.lit(0).cast("long")))
        if (parts := self._read("parts", f"{_ROW}, part long")) is not None:
            out = out.union(parts.filter(F.col("part") > covers).select(*out.columns))
        return out if wanted is None else out.join(wanted.select("accession").distinct(), "accession", "left_semi").select(*out.columns)

    def read(self, wanted: DataFrame | None = None) -> DataFrame:
        """(accession, raw_text, hash, fetch_date): the newest row of each key that is not removed."""
        rows = self.layers(wanted).filter(F.col("op") != log.ASKED)
        return log.newest(rows, ["accession"], ["part"], removed=F.col("op") == log.REMOVE).select("accession", "raw_text", "hash", "fetch_date")

    def asked(self) -> DataFrame:
        """(accession, asked) for keys with asked or removed rows."""
        return log.asked_since_removal(self.layers().filter(F.col("op") != log.PUT), "accession", "op", "part")

    def pack(self) -> DataFrame:
        """Write all layers as a new base; (bucket, added, replaced, removed) against the old one.

        Asked keys stay until a removal covers them. The new base counts once its state row is written.
        """
        base, _, name = self._state()
        new_name = uuid.uuid4().hex
        parts = self._read("parts", f"{_ROW}, part long")
        last = (parts.agg(F.max("part").alias("m")).first()["m"] if parts is not None else None) or 0
        asked = self._bare(self.asked().filter("asked"), log.ASKED)
        packed = self.read().withColumn("op", F.lit(log.PUT)).unionByName(asked)
        packed.repartitionByRange("accession").sortWithinPartitions("accession").write.parquet(f"{self.path}/base/name={new_name}")
        none = self.spark.createDataFrame([], _ROW)
        old = (self._read(f"base/name={name}", _ROW) if base else None) or none
        new = self._read(f"base/name={new_name}", _ROW) or none
        tally = log.change_tally(old.filter(F.col("op") == log.PUT), new.filter(F.col("op") == log.PUT), "accession", "hash", bucket_of(F.col("accession"), self.width))
        total = tally.agg(*(F.sum(c).alias(c) for c in ("added", "replaced", "removed"))).first().asDict()
        mark = self.spark.createDataFrame([(base + 1, last, new_name, json.dumps(total))], _STATE)
        mark.coalesce(1).write.mode("append").json(f"{self.path}/state")
        return tally
