from pyspark.sql import functions as F

import pytest
from pyspark.errors import PySparkException

from tessera import schema
from tessera.operators.papers import BrokenRule
from tessera.sources.raw_log import RawLog
from tessera.sources.tables import Versions, layout_faults, manifest, read_keyed, write_keyed, write_table


def rows(spark, *pairs):
    return spark.createDataFrame([(a, t, "2020-01-01") for a, t in pairs], "accession string, raw_text string, fetch_date string")


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "accession string")


def content(raw):
    return {(r.accession, r.raw_text) for r in raw.read().collect()}


def test_packing_changes_nothing_that_is_read(spark, tmp_path):
    raw = RawLog(spark, str(tmp_path / "raw"))
    assert content(raw) == set()
    raw.append(1, rows(spark, ("GSE1", "a"), ("GSE2", "a"), ("GSE3000", "a")))
    raw.remove(2, keys(spark, "GSE2"))
    raw.ask(3, keys(spark, "GSE9", "GSE2"))
    raw.append(4, rows(spark, ("GSE1", "b")))
    before, asked = content(raw), {tuple(r) for r in raw.asked().collect()}
    assert before == {("GSE1", "b"), ("GSE3000", "a")}
    assert asked == {("GSE9", True), ("GSE2", True)}
    assert {tuple(r) for r in raw.pack().collect()} == {("GSEnnn", 1, 0, 0), ("GSE3nnn", 1, 0, 0)}
    assert content(raw) == before and {tuple(r) for r in raw.asked().collect()} == asked
    raw.append(5, rows(spark, ("GSE1", "c"), ("GSE4", "c")))
    raw.append(5, rows(spark, ("GSE1", "c"), ("GSE4", "c")))  # written again by a retry
    raw.remove(6, keys(spark, "GSE3000", "GSE9"))
    before = content(raw)
    assert before == {("GSE1", "c"), ("GSE4", "c")}
    assert {tuple(r) for r in raw.pack().collect()} == {("GSEnnn", 1, 1, 0), ("GSE3nnn", 0, 0, 1)}
    assert content(raw) == before
    assert {r.accession for r in raw.read(keys(spark, "GSE4", "GSE5")).collect()} == {"GSE4"}


def test_keyed_tables_and_layout(spark, tmp_path):
    path = str(tmp_path / "notes")
    good = spark.createDataFrame([("GSE2", "b", "x"), ("GSE1", "a", "y"), ("GSE3", "a", "z")], "accession string, kind string, detail string")
    write_keyed(good, schema.NOTES, path, ["accession"], vocabulary={"kind": ["a", "b"]})
    with pytest.raises(BrokenRule):
        write_keyed(good.union(good), schema.NOTES, path, ["accession"])
    broken = good.withColumn("detail", F.when(F.col("detail") == "z", F.raise_error(F.lit("no more"))).otherwise(F.col("detail")))
    with pytest.raises(PySparkException):
        write_keyed(broken, schema.NOTES, path, ["accession"])
    assert read_keyed(spark, schema.NOTES, path).count() == 3 and read_keyed(spark, schema.NOTES, str(tmp_path / "none")).count() == 0
    versions = Versions(spark, path)
    root, path = path, versions.path(versions.current(), "notes")
    assert layout_faults(spark, schema.NOTES, path) == []
    assert layout_faults(spark, schema.HOLDINGS, path)
    write_keyed(good.limit(1), schema.NOTES, root, ["accession"])
    assert read_keyed(spark, schema.NOTES, root).count() == 1
    good.coalesce(1).orderBy(F.desc("accession")).write.parquet(str(tmp_path / "bad"))
    assert layout_faults(spark, schema.NOTES, str(tmp_path / "bad"))
    assert manifest(spark, path).filter("bytes > 0 and length(sha256) = 64").count() >= 1
    write_table(good.select("accession", F.col("kind").alias("reason"), "detail"), schema.GAPS, str(tmp_path / "gaps"), parts=2)
    assert [r.accession for r in spark.read.parquet(str(tmp_path / "gaps")).collect()] != []


def test_two_writers_of_one_number(spark, tmp_path):
    one, two = (Versions(spark, str(tmp_path / "v")) for _ in range(2))
    for versions in (one, two):
        versions.history = lambda: []  # both have read before either wrote
    one.publish("a")
    two.publish("b")
    found = [Versions(spark, str(tmp_path / "v")).history() for _ in range(2)]
    assert found[0] == found[1] and sorted(found[0]) == ["a", "b"]
    raw = RawLog(spark, str(tmp_path / "raw"))
    raw.append(1, rows(spark, ("GSE1", "a")))
    other, seen = RawLog(spark, str(tmp_path / "raw")), raw._state()
    other._state = lambda: seen
    raw.pack()
    raw.append(2, rows(spark, ("GSE2", "b")))
    other.pack()  # it took the same number, but covers more
    del other._state
    assert content(raw) == content(other) == {("GSE1", "a"), ("GSE2", "b")}
