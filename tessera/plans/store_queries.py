"""Queries on the build of all sources, on what it makes of each kind of text, and on reading what it has published.

The input tables are turned into texts: each order is an experiment package, a sample and a series with its own
sample and one of five platforms; each customer is a study and a project.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera import schema
from tessera.functions import fields as fl
from tessera.operators import build, parts, rules, subsets
from tessera.sources import readers, tables
from tessera.sources.scratch import work_path

from .base import Catalogue, table
from .build_queries import _RUNS_SQL, _packages, _projects, _samples, _tasks, _text

CATALOGUE = Catalogue()
add = CATALOGUE.add

_DAY = "2024-05-01"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return rows.withColumn("k", F.col("o_custkey") % 5).withColumn("after", F.col("o_orderkey") + 1).withColumn("o9", F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of orders over all tasks, before they become texts."""
    return rows.repartition(_tasks(rows.sparkSession), "o_orderkey")


def _families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(accession, raw_text): each order as a line-tagged family of a series, its platform and its sample.

    A platform's title is the order's status, so its copies differ; the sample's table has no end line.
    """
    status, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    raw = F.concat(
        _text("^SERIES = GSE{o_orderkey}\n!Series_title = order {o_orderkey} = {o_orderstatus}\n!Series_status = Public on Jan 05 2010\n!Series_submission_date = Feb 3 2009\n!Series_empty = \n!Series_type = "),
        F.when(urgent, "Expression profiling by array").otherwise("Expression profiling by High Throughput Sequencing"),
        _text("\n!Series_pubmed_id = {o_custkey}\n!Series_web_link = https://www.example.org/article-abstract/doi/10.1000/A.{o_custkey}/12345/title\n!Series_sample_id = GSM{o_orderkey}\n!Series_relation = BioProject: https://www.example.org/bioproject/PRJNA{o_custkey}\n"),
        F.when(status == "F", _text("!Series_relation = SuperSeries of: GSE{after}\n!Series_supplementary_file = NONE\n")).otherwise(_text("!Series_supplementary_file = ftp://ftp.example.org/GSE{o_orderkey}_RAW.tar\n")),
        F.when(status == "P", _text("!Series_relation = Odd label: thing {o_custkey}\n")).otherwise(""),
        _text("^PLATFORM = GPL{k}\n!Platform_title = {o_orderstatus}\n!Platform_status = Public on Mar 07 2011\n#ID = a column\n!platform_table_begin\n!Platform_lost = 1\n!platform_table_end\n!Platform_last = x\n"),
        _text("^SAMPLE = GSM{o_orderkey}\n!Sample_status = Public on Mar 07 2011\n!Sample_last_update_date = Apr 09 2012\n!Sample_series_id = GSE{o_orderkey}\n!Sample_platform_id = GPL{k}\n"),
        _text("!Sample_relation = BioSample: https://www.example.org/biosample/SAMN{o_orderkey}\n!Sample_relation = SRA: https://www.example.org/sra?term=SRX{o_orderkey}\n!sample_table_begin\n!Sample_lost = 1\n"),
    )
    return _dealt(_orders(spark, sf_dir)).select(_text("GSE{o_orderkey}").alias("accession"), raw.alias("raw_text"))


def _saved_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(accession, raw_text): packages as saved; of status P those of priority 4 are empty and those of priority 5 are cut off."""
    p = F.col("o_orderstatus") == "P"
    text = F.when(p & F.col("o_orderpriority").startswith("4"), "").when(p & F.col("o_orderpriority").startswith("5"), F.substring_index("raw_text", "<RUN_SET>", 1)).otherwise(F.col("raw_text"))
    return _packages(spark, sf_dir).select("accession", text.alias("raw_text"))


def _sources(spark: SparkSession, sf_dir: str) -> build.Sources:
    orders = _orders(spark, sf_dir)
    target = F.when(F.col("o_orderstatus") == "O", _text("PRJNA{o_custkey}")).otherwise("")
    listing = _text("#Archive/File\tName\tTime\tSize\tType\nArchive\tGSE{o_orderkey}_RAW.tar\t01/02/2020 03:04:05\t{o_orderkey}\tTAR\nFile\tf{o_orderkey}.txt\t01/02/2020 03:04:05\t7\tTXT\n")
    late = orders.filter("o_orderstatus = 'P'")
    kind = F.when(F.col("o_orderpriority").startswith("3"), "Expression profiling by array").otherwise("Expression profiling by high throughput SEQUENCING")
    series = orders.select(_text("GSE{o_orderkey}").alias("accession"), kind.alias("gdstype"), _text("PRJNA{o_custkey}").alias("bioproject"))
    absent = late.select(_text("GSE9{o9}").alias("accession"), F.lit("sequencing").alias("gdstype"), F.lit("").alias("bioproject"))
    reasons = late.filter("o_orderpriority like '2%'").select(_text("GSE9{o9}").alias("accession"), F.lit("withdrawn").alias("reason"), F.lit("by its owner").alias("detail"))
    none = F.lit(None).cast("date")
    tab = orders.select(_text("SRX{o_orderkey}").alias("accession"), F.col("o_orderstatus").alias("status"), F.lit("2020-01-02").cast("date").alias("submitted"), none.alias("updated"), none.alias("published"))
    keyed = lambda rows, key: rows.select(F.regexp_extract("raw_text", f'{key} *accession="([^"]*)"', 1).alias("accession"), "raw_text")
    return build.Sources(
        packages=_saved_packages(spark, sf_dir),
        soft=_families(spark, sf_dir),
        link_replies=orders.select(_text("GSE{o_orderkey}").alias("accession"), F.concat(_text("GSE{o_orderkey}\tsra\t1\tSRP{o_custkey}\nGSE{o_orderkey}\tbioproject\t2\t"), target, F.lit("\n")).alias("raw_text")),
        paper_replies=orders.select(_text("GSE{o_orderkey}").alias("accession"), _text("{o_custkey}\n7{o_orderkey}\nnone").alias("raw_text")),
        listings=orders.select(_text("GSE{o_orderkey}").alias("accession"), listing.alias("raw_text")),
        projects=keyed(_projects(spark, sf_dir), "<ArchiveID"),
        samples=keyed(_samples(spark, sf_dir), "<BioSample"),
        tab=tab,
        series=series.union(absent),
        reasons=reasons,
        known=tab.select("accession", F.lit("tab").alias("source")).union(late.select(_text("SRX9{o9}"), F.lit("tab"))),
    )


def _built(spark: SparkSession, sf_dir: str):
    """(root, store): a store built from all sources. What snapshots list are also experiments that nothing holds."""
    root = work_path(spark, "store")
    return root, build.build(spark, root, "v1", _sources(spark, sf_dir), _DAY)


#: Orders o with whether their package is whole; runs of whole packages; all links with their source.
_STORE_SQL = f"""
    {_RUNS_SQL}, o AS (SELECT *, o_custkey % 5 AS k, NOT (o_orderstatus = 'P' AND left(o_orderpriority, 1) IN ('4', '5')) AS whole FROM orders),
    g AS (SELECT * FROM o WHERE whole),
    l AS (
        SELECT 'SRX' || o_orderkey AS f, 'SRP' || o_custkey AS t, 'study' AS r, 'SRA XML' AS s FROM g UNION SELECT 'SRX' || o_orderkey, 'SRS' || o_orderkey, 'SRA sample', 'SRA XML' FROM g
        UNION SELECT 'SRX' || o_orderkey, 'SRR' || o_orderkey || '0' || l_linenumber, 'run', 'SRA XML' FROM g JOIN r ON l_orderkey = o_orderkey
        UNION SELECT 'SRP' || o_custkey, 'PRJNA' || o_custkey, 'BioProject', 'SRA XML' FROM g UNION SELECT 'SRS' || o_orderkey, 'SAMN' || o_orderkey, 'BioSample', 'SRA XML' FROM g
        UNION SELECT 'PRJNA9' || c_nationkey, 'PRJNA' || c_custkey, 'umbrella of', 'BioProject XML' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)
        UNION SELECT 'PRJNA' || c_custkey, 'PMID:' || c_nationkey || '77', 'PubMed', 'BioProject XML' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)
        UNION SELECT 'PRJNA' || o_custkey, 'DOI:10.1000/x.' || o_custkey, 'DOI', 'BioProject XML' FROM o
        UNION SELECT 'GSE' || o_orderkey, 'PMID:' || o_custkey, 'PubMed', 'SOFT' FROM o UNION SELECT 'GSE' || o_orderkey, 'GSM' || o_orderkey, 'sample', 'SOFT' FROM o
        UNION SELECT 'GSE' || o_orderkey, 'PRJNA' || o_custkey, 'BioProject', 'SOFT' FROM o UNION SELECT 'GSE' || o_orderkey, 'GSE' || (o_orderkey + 1), 'SuperSeries of', 'SOFT' FROM o WHERE o_orderstatus = 'F'
        UNION SELECT 'GSE' || o_orderkey, 'thing ' || o_custkey, 'Odd label', 'SOFT' FROM o WHERE o_orderstatus = 'P' UNION SELECT 'GSM' || o_orderkey, 'GPL' || k, 'platform', 'SOFT' FROM o
        UNION SELECT 'GSM' || o_orderkey, 'SAMN' || o_orderkey, 'BioSample', 'SOFT' FROM o UNION SELECT 'GSM' || o_orderkey, 'SRX' || o_orderkey, 'SRA', 'SOFT' FROM o
        UNION SELECT 'GSE' || o_orderkey, 'DOI:10.1000/a.' || o_custkey, 'DOI', 'SOFT Series_web_link' FROM o
        UNION SELECT 'GSE' || o_orderkey, 'SRP' || o_custkey, 'SRA', 'Entrez link' FROM o UNION SELECT 'GSE' || o_orderkey, 'PRJNA' || o_custkey, 'BioProject', 'Entrez link' FROM o WHERE o_orderstatus = 'O'
        UNION SELECT 'GSE' || o_orderkey, 'PMID:' || o_custkey, 'PubMed', 'PubMed' FROM o UNION SELECT 'GSE' || o_orderkey, 'PMID:7' || o_orderkey, 'PubMed', 'PubMed' FROM o
        UNION SELECT 'GSE' || o_orderkey, 'PRJNA' || o_custkey, 'BioProject', 'GEO summary' FROM o)
"""
#: Numbers of records by type.
_HELD_SQL = """
    SELECT 'SRA experiment' AS type, count(*) AS n FROM g UNION ALL SELECT 'SRA study', count(DISTINCT o_custkey) FROM g UNION ALL SELECT 'SRA sample', count(*) FROM g UNION ALL SELECT 'SRA run', count(*) FROM g JOIN r ON l_orderkey = o_orderkey
    UNION ALL SELECT 'BioProject', count(DISTINCT o_custkey) FROM o UNION ALL SELECT 'BioSample', count(*) FROM o UNION ALL SELECT 'GEO Series', count(*) FROM o UNION ALL SELECT 'GEO Sample', count(*) FROM o UNION ALL SELECT 'GEO Platform', count(DISTINCT k) FROM o
"""


@add(f"""
    WITH {_STORE_SQL}, h AS ({_HELD_SQL})
    SELECT 'holdings ' || type AS part, n::BIGINT AS n FROM h UNION ALL SELECT 'links ' || r || ' by ' || s, count(*)::BIGINT FROM l GROUP BY r, s
    UNION ALL SELECT 'known tab', (count(*) + count(*) FILTER (WHERE o_orderstatus = 'P'))::BIGINT FROM o
    UNION ALL SELECT 'gaps ' || CASE WHEN o_orderpriority LIKE '2%' THEN 'withdrawn' ELSE 'unexplained' END, count(*)::BIGINT FROM o WHERE o_orderstatus = 'P' GROUP BY 1
    UNION ALL SELECT 'notes copies differ', count(*)::BIGINT FROM (SELECT k FROM o GROUP BY k HAVING count(DISTINCT o_orderstatus) > 1) HAVING count(*) > 0
    UNION ALL SELECT 'notes unknown GEO relation label', 1 FROM o WHERE o_orderstatus = 'P' HAVING count(*) > 0
    UNION ALL SELECT CASE WHEN o_orderpriority LIKE '4%' THEN 'notes no SRA package' ELSE 'notes unparsable SRA package' END, count(*)::BIGINT FROM o WHERE NOT whole GROUP BY 1
    UNION ALL SELECT 'notes series type disagrees', count(*)::BIGINT FROM o WHERE o_orderpriority LIKE '1%' HAVING count(*) > 0
    UNION ALL SELECT 'files TAR', count(*)::BIGINT FROM o UNION ALL SELECT 'files TXT in an archive', count(*)::BIGINT FROM o
""")
def build_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole build from all sources to a published version, counted by table."""
    _, store = _built(spark, sf_dir)
    words = lambda *names: F.concat_ws(" ", *(F.lit(n[1:]) if n[0] == "'" else F.col(n) for n in names))
    inside = F.concat_ws(" ", F.lit("files"), "type", F.when(F.col("archive").isNotNull(), F.lit("in an archive")))
    counted = [(schema.HOLDINGS, words("'holdings", "type")), (schema.LINKS_BY_TO, words("'links", "relation", "'by", "source")), (schema.KNOWN, words("'known", "source")), (schema.GAPS, words("'gaps", "reason")), (schema.NOTES, words("'notes", "kind")), (schema.SUPPLEMENTARY, inside)]
    return reduce(DataFrame.union, [store.table(t).groupBy(part.alias("part")).agg(F.count("*").cast("long").alias("n")) for t, part in counted])


@add(f"""
    WITH {_STORE_SQL}, w AS (SELECT g.* FROM g JOIN orders USING (o_orderkey) WHERE orders.o_totalprice > 450000), x AS (SELECT 'SRX' || o_orderkey AS key, * FROM w)
    SELECT 'record' AS part, key, 'SRA experiment 2020-01-02' AS value FROM x UNION ALL SELECT 'state', key, 'held' FROM x UNION ALL SELECT 'state', 'SRX9' || lpad(o_orderkey::VARCHAR, 9, '0'), 'not mirrored' FROM o WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'state', 'NONE1', 'not found' UNION ALL SELECT r, f, t FROM l WHERE r IN ('study', 'SRA sample', 'run') AND f IN (SELECT key FROM x)
    UNION ALL SELECT 'title', key, 'order ' || o_orderkey FROM x UNION ALL SELECT 'study field', key, 'SRP' || o_custkey FROM x
    UNION ALL SELECT 'file', 'GSE' || o_orderkey, 'f' || o_orderkey || '.txt 7' FROM x UNION ALL SELECT 'file', 'GSE' || o_orderkey, 'GSE' || o_orderkey || '_RAW.tar ' || o_orderkey FROM x
""")
def store_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, links, fields, texts, files and states of wanted keys, read from a store."""
    _, store = _built(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    whole = ~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority").startswith("4") | F.col("o_orderpriority").startswith("5")))
    some = orders.filter("o_totalprice > 450000").filter(whole)
    wanted = some.select(F.concat(F.lit(" srx"), F.col("o_orderkey").cast("string")).alias("key"))
    absent = _orders(spark, sf_dir).filter("o_orderstatus = 'P'").select(_text("SRX9{o9}").alias("key")).union(spark.createDataFrame([("none1",)], "key string"))
    found = store.open_many(wanted)
    records = found.select(F.lit("record").alias("part"), F.col("accession").alias("key"), F.concat_ws(" ", "type", F.col("submitted").cast("string")).alias("value"))
    states = store.state_of(wanted.union(absent)).select(F.lit("state"), "key", "state")
    links = store.links(wanted, ["study", "SRA sample", "run"]).select("relation", "from", "to")
    titles = store.raw(wanted).select(F.lit("title"), "accession", F.regexp_extract("raw_text", "<TITLE>([^<]*)</TITLE>", 1))
    pivot = store.field_table("SRA experiment", ["EXPERIMENT/STUDY_REF@accession"]).toDF("accession", "values").join(F.broadcast(found.select("accession")), "accession", "left_semi")
    studies = pivot.select(F.lit("study field"), "accession", F.get("values", 0))
    files = store.files(some.select(_text("GSE{o_orderkey}").alias("key"))).select(F.lit("file"), "owner", F.concat_ws(" ", "name", F.col("size").cast("string")))
    return reduce(DataFrame.union, [records, states, links, titles, studies, files])


#: Held records by type; the members of the subset of dear series; its links, and what they know.
_SUBSET_SQL = f"""
    {_STORE_SQL}, e AS (
        SELECT 'SRX' || o_orderkey AS a, 'SRA experiment' AS type FROM g UNION SELECT 'SRP' || o_custkey, 'SRA study' FROM g UNION SELECT 'SRS' || o_orderkey, 'SRA sample' FROM g
        UNION SELECT 'SRR' || o_orderkey || '0' || l_linenumber, 'SRA run' FROM g JOIN r ON l_orderkey = o_orderkey UNION SELECT 'PRJNA' || o_custkey, 'BioProject' FROM o UNION SELECT 'SAMN' || o_orderkey, 'BioSample' FROM o
        UNION SELECT 'GSE' || o_orderkey, 'GEO Series' FROM o UNION SELECT 'GSM' || o_orderkey, 'GEO Sample' FROM o UNION SELECT 'GPL' || k, 'GEO Platform' FROM o),
    q AS (SELECT 'GSE' || o_orderkey AS a FROM orders WHERE o_totalprice > 400000 UNION SELECT 'GSE9' || lpad(o_orderkey::VARCHAR, 9, '0') FROM o WHERE o_orderstatus = 'P'),
    n AS (SELECT a, type FROM e WHERE a IN (FROM q) UNION SELECT e.a, e.type FROM n JOIN l ON f = n.a JOIN e ON e.a = l.t WHERE l.r IN ('sample', 'platform', 'SRA', 'run', 'study', 'SRA sample', 'BioSample', 'BioProject') AND e.type <> 'GEO Series'),
    m AS (FROM n UNION SELECT a, type FROM e WHERE type = 'BioProject' AND a IN (SELECT f FROM l WHERE r = 'umbrella of' AND t IN (SELECT a FROM n WHERE type = 'BioProject'))),
    pa AS (SELECT a FROM m UNION SELECT t FROM l WHERE (t LIKE 'PMID:%' OR t LIKE 'DOI:%') AND f IN (SELECT a FROM m WHERE type IN ('GEO Series', 'BioProject'))),
    kl AS (SELECT DISTINCT f, t, r, s FROM l WHERE f IN (FROM pa) OR t IN (FROM pa)),
    ab AS (SELECT a FROM m UNION FROM q UNION SELECT f FROM kl UNION SELECT t FROM kl WHERE t NOT LIKE 'PMID:%' AND t NOT LIKE 'DOI:%'),
    kn AS (SELECT 'SRX' || o_orderkey AS a FROM o WHERE 'SRX' || o_orderkey IN (FROM ab) UNION ALL SELECT 'SRX9' || lpad(o_orderkey::VARCHAR, 9, '0') FROM o WHERE o_orderstatus = 'P' AND 'SRX9' || lpad(o_orderkey::VARCHAR, 9, '0') IN (FROM ab))
"""


@add(f"""
    WITH RECURSIVE {_SUBSET_SQL}
    SELECT 'records ' || type AS part, count(*)::BIGINT AS n FROM m GROUP BY type UNION ALL SELECT 'holdings', count(*)::BIGINT FROM m UNION ALL SELECT 'links ' || r || ' by ' || s, count(*)::BIGINT FROM kl GROUP BY r, s
    UNION ALL SELECT 'known', count(*)::BIGINT FROM kn UNION ALL SELECT 'files', (2 * count(*))::BIGINT FROM m WHERE type = 'GEO Series'
    UNION ALL SELECT 'gaps', count(*)::BIGINT FROM q WHERE a NOT IN (SELECT a FROM e) UNION ALL SELECT 'not held', count(*)::BIGINT FROM q WHERE a NOT IN (SELECT a FROM m)
    UNION ALL SELECT 'notes', count(*)::BIGINT FROM o WHERE NOT whole AND 'SRX' || o_orderkey IN (SELECT a FROM kn)
    UNION ALL SELECT 'outside', count(*)::BIGINT FROM (SELECT DISTINCT f, t FROM kl WHERE r = 'SuperSeries of' AND (f IN (FROM q)) <> (t IN (FROM q)))
""")
def store_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store cut to the series of dear orders and some that are not held: what they lead to, all rows about it, and what stays outside; counted by table."""
    _, store = _built(spark, sf_dir)
    dear = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(_text(" gse{o_orderkey}").alias("key"))
    absent = _orders(spark, sf_dir).filter("o_orderstatus = 'P'").select(_text("GSE9{o9}").alias("key"))
    made = subsets.subset(store, dear.union(absent), work_path(spark, "subset"))
    part = made.store
    counted = [
        (part.table(schema.RECORDS), F.concat_ws(" ", F.lit("records"), "type")),
        (part.table(schema.HOLDINGS), F.lit("holdings")),
        (part.table(schema.LINKS_BY_TO), F.concat_ws(" ", F.lit("links"), "relation", F.lit("by"), "source")),
        (part.table(schema.KNOWN), F.lit("known")),
        (part.table(schema.SUPPLEMENTARY), F.lit("files")),
        (part.table(schema.GAPS), F.lit("gaps")),
        (made.not_held, F.lit("not held")),
        (part.table(schema.NOTES), F.lit("notes")),
        (made.outside, F.lit("outside")),
    ]
    found = reduce(DataFrame.union, [rows.groupBy(name.alias("part")).agg(F.count("*").cast("long").alias("n")) for rows, name in counted])
    # tables without a row still count
    named = spark.createDataFrame([(p,) for p in ("holdings", "known", "files", "gaps", "not held", "notes", "outside")], "part string").select("part", F.lit(0).cast("long").alias("n"))
    return found.union(named).groupBy("part").agg(F.sum("n").alias("n"))


@add(f"""
    WITH {_STORE_SQL} SELECT 'target' AS part, 'GSE' || o_orderkey AS accession FROM o WHERE o_orderpriority NOT LIKE '3%' UNION ALL SELECT 'target', 'GSE9' || lpad(o_orderkey::VARCHAR, 9, '0') FROM o WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'no package', 'SRX' || o_orderkey FROM o WHERE NOT whole AND o_orderpriority LIKE '4%'
""")
def noted_and_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a version notes as saved without a package, and the series that its gaps were counted from."""
    _, store = _built(spark, sf_dir)
    wanted = build.build_targets(store, _sources(spark, sf_dir).series)
    return wanted.select(F.lit("target").alias("part"), "accession").union(store.noted("no SRA package").select(F.lit("no package"), "accession"))


@add("""
    SELECT 'as declared' AS written, NULL AS fault, count(*)::BIGINT AS rows FROM orders UNION ALL SELECT 'by default', 'compressed by SNAPPY, declared ZSTD', count(*)::BIGINT FROM orders
    UNION ALL SELECT 'by default', 'dictionary in content_hash, raw_text, declared plain', count(*)::BIGINT FROM orders UNION ALL SELECT 'by default', 'row groups of more than 2048 rows', count(*)::BIGINT FROM orders HAVING count(*) > 2048
""")
def layout_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footers of a table written as declared, and of one by a writer's defaults in one file: codec, dictionaries and row groups."""
    root, declared = work_path(spark, "layout"), schema.RECORDS
    none = F.lit(None).cast("date")
    rows = table(spark, sf_dir, "orders").select(_text("GSM{o_orderkey}").alias("accession"), F.lit("GEO Sample").alias("type"), F.col("o_orderstatus").alias("status"), none.alias("submitted"), none.alias("updated"), none.alias("published"), F.lit(None).cast(schema.FIELDS).alias("fields"), F.col("o_orderpriority").alias("raw_text"), F.col("o_orderstatus").alias("content_hash"), F.lit(_DAY).cast("date").alias("snapshot_date"))
    tables.write_table(rows, declared, f"{root}/declared")
    rows.coalesce(1).write.option("compression", "snappy").parquet(f"{root}/plain")
    out = []
    for name, path in (("as declared", "declared"), ("by default", "plain")):
        held = tables.footers(spark, f"{root}/{path}").agg(F.sum(F.aggregate("rows_in_groups", F.lit(0).cast("long"), lambda a, n: a + n)).alias("rows"))
        faults = tables.footer_faults(spark, declared, f"{root}/{path}").select("fault").distinct()
        out.append(held.join(faults, F.lit(True), "left").select(F.lit(name).alias("written"), "fault", "rows"))
    return reduce(DataFrame.union, out)


@add(f"WITH {_STORE_SQL}, h AS ({_HELD_SQL}) SELECT 'v1' AS version, 0::BIGINT AS faults, sum(n)::BIGINT AS records FROM h")
def build_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of a version held against its stored hash and the holdings."""
    root, store = _built(spark, sf_dir)
    faults = build.provenance(spark, root, "v1").agg(F.count("*").cast("long").alias("faults"))
    return store.table(schema.RECORDS).agg(F.lit("v1").alias("version"), F.count("*").cast("long").alias("records")).join(F.broadcast(faults)).select("version", "faults", "records")


@add("""
    SELECT 'GSE' || o_orderkey AS accession, 'GEO Series' AS type, 'Public' AS status, DATE '2009-02-03' AS submitted, NULL::DATE AS updated, DATE '2010-01-05' AS published,
           CASE o_orderstatus WHEN 'O' THEN 10 ELSE 11 END + CASE o_orderstatus WHEN 'F' THEN 0 ELSE 0 END AS n_fields, 'order ' || o_orderkey || ' = ' || o_orderstatus AS head FROM orders
    UNION ALL SELECT 'GSM' || o_orderkey, 'GEO Sample', 'Public', NULL, DATE '2012-04-09', DATE '2011-03-07', 6, NULL FROM orders UNION ALL SELECT 'GPL' || (o_custkey % 5), 'GEO Platform', 'Public', NULL, NULL, DATE '2011-03-07', 3, o_orderstatus FROM orders
""")
def family_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records of line-tagged families: empty values are fields, table lines are none, a table without its end line lasts to the next entity."""
    found = rules.soft_records(parts.parsed_tagged(_families(spark, sf_dir), texts=False))
    head = F.coalesce(fl.first_of(F.col("fields"), "Series_title"), fl.first_of(F.col("fields"), "Platform_title"))
    return found.select("accession", "type", "status", "submitted", "updated", "published", F.size("fields").alias("n_fields"), head.alias("head"))


@add(f"WITH {_STORE_SQL} SELECT f AS \"from\", t AS \"to\", r AS relation, s AS source FROM l WHERE s LIKE 'SOFT%'")
def family_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of line-tagged families: relation lines of every form, identifiers, papers, and names in addresses."""
    return rules.soft_links(parts.parsed_tagged(_families(spark, sf_dir), texts=False)).distinct()


@add("""
    SELECT 'SRP' || o_custkey AS accession, 'SRA study' AS type, o_orderstatus AS center, 3 AS n_fields, 'STUDY@accession' AS first FROM orders
    UNION ALL SELECT 'SRX' || o_orderkey, 'SRA experiment', NULL, 4, 'EXPERIMENT@accession' FROM orders UNION ALL SELECT 'SRS' || o_orderkey, 'SRA sample', NULL, 3, 'SAMPLE@accession' FROM orders
""".replace("o_orderstatus AS center, 3", "o_orderstatus AS center, 4"))
def package_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of packages from one parse: an experiment's own fields, and the submitter's center on its study."""
    # runs are not wanted, and so are no parts
    shape = replace(rules.PACKAGE, wanted=("EXPERIMENT", "STUDY", "SAMPLE", "SUBMISSION"))
    found = rules.package_records(parts.parsed_xml(_packages(spark, sf_dir), shape))
    f = F.col("fields")
    return found.select("accession", "type", fl.first_of(f, "SUBMISSION@center_name").alias("center"), F.size(f).alias("n_fields"), F.get(f, 0)["name"].alias("first"))


@add("""
    SELECT 'GPL' || k AS accession, 'kept GSE' || min(o) AS kept, (sum(n) - max_by(n, -o))::BIGINT AS others, 'Platform_title' AS names
    FROM (SELECT o_custkey % 5 AS k, o_orderstatus, min(o_orderkey) AS o, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY k HAVING count(*) > 1
""")
def copies_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose copies differ: the copy kept, how many others, and the fields that differ."""
    found = rules.differing_copies(rules.soft_records(parts.parsed_tagged(_families(spark, sf_dir), texts=False)))
    d = F.col("detail")
    return found.select("accession", F.regexp_extract(d, r"^([^;]*);", 1).alias("kept"), F.regexp_extract(d, r"; (\d+) other", 1).cast("long").alias("others"), F.regexp_extract(d, r"differ in: (.*)$", 1).alias("names"))


@add("SELECT o_custkey % 5 AS k, min(o_orderkey) AS origin, arg_min(o_orderstatus, o_orderkey) AS title, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def kept_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy of each platform that is kept, of as many as families state."""
    found = rules.soft_records(parts.parsed_tagged(_families(spark, sf_dir))).filter("type = 'GEO Platform'")
    kept = rules.kept_records(found, count="n")
    return kept.select(F.substring("accession", 4, 9).cast("long").alias("k"), F.substring("origin", 4, 20).cast("long").alias("origin"), fl.first_of(F.col("fields"), "Platform_title").alias("title"), "n")


@add("""
    SELECT 'SRX' || o_orderkey AS accession, CASE o_orderpriority WHEN '1-URGENT' THEN 'mismatched' WHEN '2-HIGH' THEN 'truncated' WHEN '3-MEDIUM' THEN 'unescaped' ELSE 'empty' END AS fault FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def text_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with saved packages: a tag that another closes, a text cut off, a bare ampersand, or nothing at all."""
    rows = _packages(spark, sf_dir)
    p, raw = F.col("o_orderpriority"), F.col("raw_text")
    text = F.when(p.startswith("1"), F.replace(raw, F.lit("</TITLE>"), F.lit(""))).when(p.startswith("2"), F.substring_index(raw, "</RUN_SET>", 1)).when(p.startswith("3"), F.replace(raw, F.lit("<TITLE>order"), F.lit("<TITLE>R&D"))).when(p.startswith("5"), raw).otherwise("")
    return parts.xml_faults(rows.select("accession", text.alias("raw_text")))


def _listed(spark: SparkSession, sf_dir: str) -> str:
    """Path of a series listing as snapshots have it: gzipped JSON lines with nested samples, among them fields that nobody reads."""
    path = work_path(spark, "lines")
    samples = F.array(F.struct(_text("GSM{o_custkey}").alias("accession"), F.lit("t").alias("title")), F.struct(_text("GSM7{o_custkey}").alias("accession"), F.lit("u").alias("title")))
    kind = F.when(F.col("o_orderpriority").startswith("1"), "Expression profiling by array").otherwise("Other; Expression profiling by high throughput Sequencing")
    rows = _orders(spark, sf_dir).select(_text("GSE{o_orderkey}").alias("accession"), F.lit("a title").alias("title"), kind.alias("gdstype"), F.when(F.col("o_orderstatus") != "P", _text("PRJNA{o_custkey} ")).alias("bioproject"), _text("{k};9").alias("gpl"), F.when(F.col("o_orderstatus") != "F", samples).alias("samples"))
    rows.write.option("compression", "gzip").json(path)
    return path


@add("""
    SELECT accession, count(*)::BIGINT AS n FROM (SELECT 'GSE' || o_orderkey AS accession FROM orders UNION ALL SELECT 'GSM' || o_custkey FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'GSM7' || o_custkey FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT 'GPL' || (o_custkey % 5) FROM orders UNION ALL SELECT 'GPL9' FROM orders) GROUP BY 1
""")
def json_lines_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series, nested samples and platforms of a listing in JSON lines."""
    return readers.series_lines(spark, _listed(spark, sf_dir)).groupBy("accession").agg(F.count("*").cast("long").alias("n"))


@add("SELECT 'GSE' || o_orderkey AS accession, 'Other; Expression profiling by high throughput Sequencing' AS gdstype, CASE WHEN o_orderstatus <> 'P' THEN 'PRJNA' || o_custkey ELSE '' END AS bioproject FROM orders WHERE o_orderpriority <> '1-URGENT'")
def listed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed series of a wanted type with their project."""
    return readers.series_targets(spark, _listed(spark, sf_dir))
