"""Scans: tab-separated text, JSON lines, marked-up records cut by their end tag, dated snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tessera.functions.keys import kind_of
from tessera.functions.text import attribute


def tab_rows(spark: SparkSession, path: str, schema: StructType | str, keep: Column | None = None) -> DataFrame:
    """Rows of a tab-separated file with a header; a cell of one hyphen reads as empty text.

    The header gives the order of columns and must hold those of the schema.
    """
    df = spark.read.csv(path, schema=schema, sep="\t", header=True, quote="", escape="", enforceSchema=False)
    strings = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    df = df.select(*(F.when(F.col(c) == "-", "").otherwise(F.coalesce(F.col(c), F.lit(""))).alias(c) if c in strings else F.col(c) for c in df.columns))
    return df if keep is None else df.filter(keep)


def _cut_off(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """No rows of (key, raw_text); raises if a file's last start tag comes after its last end tag.

    Files are cut before the end tag's last character, so that an end tag at the very end is still followed by a part.
    """
    parts = spark.read.option("lineSep", f"</{tag}").text(path)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    found = parts.select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.col("value").startswith(">").alias("ends"), F.col("value").rlike(rf"<{tag}(?:[\s>]|$)").alias("starts"))
    # of a part that begins behind an end tag, a start tag is the later of the two
    last = found.groupBy("file").agg(F.max(F.when(F.col("starts"), F.col("at"))).alias("start"), F.max(F.when(F.col("ends"), F.col("at"))).alias("end"))
    cut = F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("start") >= F.col("end")))
    said = F.raise_error(F.concat(F.lit(f"no end tag of the last <{tag}> in "), F.col("file"))).cast("boolean")
    return last.filter(F.when(cut, said).otherwise(F.lit(False))).select(F.lit("").alias("key"), F.lit("").alias("raw_text"))


def marked_records(spark: SparkSession, path: str, tag: str, key: str) -> DataFrame:
    """(key, raw_text): every <tag ...>...</tag> of the files, text exactly as stored; key is a pattern with one group.

    Files are cut at the end tag by the text source, so one large file is read by many tasks.
    An element without its end tag at the end of a file raises, in a second scan once all rows are read.
    """
    parts = spark.read.option("lineSep", f"</{tag}>").text(path)
    body = F.regexp_extract("value", rf"(?s)(<{tag}[\s>].*)$", 1)
    whole = F.concat(body, F.lit(f"</{tag}>"))
    found = parts.filter(body != "").select(F.regexp_extract(whole, key, 1).alias("key"), whole.alias("raw_text"))
    return found.filter("key <> ''").unionByName(_cut_off(spark, path, tag))


#: A line of a series listing; its other fields are not read.
SERIES_LINE = "accession string, gdstype string, bioproject string, gpl string, samples array<struct<accession:string>>"


def series_listing(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Rows of a series listing, JSON lines with nested samples; blank lines are none, and a line that is no JSON object raises.

    kind keeps the series whose type holds it, whatever the case. Types as they are written are few, but the
    condition is on their lower-case text, which the scan cannot test for itself.
    """
    rows = spark.read.schema(SERIES_LINE).option("mode", "FAILFAST").json(path)
    return rows if kind is None else rows.filter(F.lower(F.coalesce("gdstype", F.lit(""))).contains(kind.lower()))


def series_targets(spark: SparkSession, path: str, kind: str = "sequencing") -> DataFrame:
    """(accession, gdstype, bioproject) of the listed series of a type; neither platforms nor samples are read."""
    return series_listing(spark, path, kind).select("accession", "gdstype", F.trim(F.coalesce("bioproject", F.lit(""))).alias("bioproject"))


def series_lines(spark: SparkSession, path: str) -> DataFrame:
    """(accession): the series of each line, each of its samples, and each platform of its ;-separated numbers."""
    rows = series_listing(spark, path)
    platforms = F.transform(F.filter(F.split(F.coalesce("gpl", F.lit("")), ";"), lambda x: F.trim(x) != ""), lambda x: F.concat(F.lit("GPL"), F.trim(x)))
    samples = F.coalesce(F.transform("samples", lambda s: s["accession"]), F.array().cast("array<string>"))
    return rows.select(F.explode(F.concat(F.array("accession"), samples, platforms)).alias("accession")).filter("accession is not null")


def first_cells(spark: SparkSession, path: str) -> DataFrame:
    """(accession): the first cell of each line of a tab-separated file with a header, empty ones left out; no other cell is read."""
    df = spark.read.csv(path, sep="\t", header=True, quote="", escape="")
    return df.select(F.trim(F.col(f"`{df.columns[0]}`")).alias("accession")).filter("accession <> ''")


def tag_accessions(spark: SparkSession, path: str, tag: str, kind: str) -> DataFrame:
    """(accession): the accessions of a kind that the opening tags of a marked-up file state, a tag on one line; repeats are possible."""
    tags = F.regexp_extract_all("value", F.lit(rf"(<{tag}\s[^>]*>)"), F.lit(1))
    rows = spark.read.text(path).select(F.explode(F.transform(tags, lambda t: attribute(t, "accession"))).alias("accession"))
    return rows.filter(kind_of(F.col("accession")) == kind)


def key_list(spark: SparkSession, path: str) -> DataFrame:
    """(key, place): one key a line, upper case, blank lines left out, the first place of repeated ones."""
    rows = spark.read.text(path).select(F.upper(F.trim("value")).alias("key"), F.monotonically_increasing_id().alias("place")).filter("key <> ''")
    return rows.groupBy("key").agg(F.min("place").alias("place"))


def file_list(text: Column) -> Column:
    """Rows (archive, name, size) of an archive listing: a File row belongs to the Archive row above it.

    The text is one listing of bounded length; the enclosing archive is carried forward by a fold.
    """
    lines = F.transform(F.filter(F.split(text, r"\r?\n"), lambda s: s.rlike(r"^(File|Archive)\t")), lambda s: F.split(s, "\t"))
    empty = F.struct(F.lit(None).cast("string").alias("archive"), F.array().cast("array<struct<archive:string,name:string,size:bigint>>").alias("rows"))

    def step(acc: Column, c: Column) -> Column:
        is_file = F.get(c, 0) == "File"
        row = F.struct(acc["archive"].alias("archive"), F.get(c, 1).alias("name"), F.get(c, 3).try_cast("bigint").alias("size"))
        return F.struct(F.when(is_file, acc["archive"]).otherwise(F.get(c, 1)).alias("archive"), F.when(is_file, F.concat(acc["rows"], F.array(row))).otherwise(acc["rows"]).alias("rows"))

    return F.aggregate(lines, empty, step, lambda acc: acc["rows"])


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(source, added, replaced, removed) of a counts log of JSON lines: torn lines are skipped, of records with
    one source, bucket and parts the first counts."""
    kind = "source string, bucket string, parts string, added long, replaced long, removed long"
    rows = spark.read.schema(kind).option("mode", "DROPMALFORMED").json(path).filter("source is not null").withColumn("_n", F.monotonically_increasing_id())
    first = rows.groupBy("source", "bucket", "parts").agg(F.min_by(F.struct("added", "replaced", "removed"), "_n").alias("r"))
    return first.groupBy("source").agg(*(F.sum(f"r.{c}").cast("long").alias(c) for c in ("added", "replaced", "removed")))


def newest_snapshot(spark: SparkSession, root: str, name: str, date: str | None = None) -> tuple[str, str]:
    """(date, path) of the newest dated folder root/yyyy-MM-dd that holds the file, or of the given date."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", name.rsplit("/", 1)[-1]).load(f"{root.rstrip('/')}/*/").select(F.col("path"))
    dated = rows.select(F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/[^/]+$", 1).alias("date"), "path").filter("date <> ''")
    found = (dated.filter(F.col("date") == date) if date else dated).orderBy(F.col("date").desc()).first()
    if found is None:
        raise FileNotFoundError(f"no snapshot of {name} under {root}")
    return found.date, found.path


def typed_empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """A table without rows."""
    return spark.createDataFrame([], schema)
