"""Queries on what series reach, on listings of four forms, and on dated snapshots and logs of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators import packages, reach
from tessera.sources import readers
from tessera.sources.scratch import work_path

from .base import Catalogue, table
from .build_queries import _packages, _projects, _samples, _text

CATALOGUE = Catalogue()
add = CATALOGUE.add


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, raw_text): each order as a series; its lines are experiments, and orders of status F reanalyse the one before."""
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(_text("!Sample_relation = SRA: https://www.example.org/sra?term=SRX{l_partkey}"))), "\n").alias("s"))
    rows = table(spark, sf_dir, "orders").join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("before", F.col("o_orderkey") - 1)
    before = F.when(F.col("o_orderstatus") == "F", _text("!Series_relation = Reanalysis of: GSE{before}\n")).otherwise("")
    return rows.select(_text("GSE{o_orderkey}").alias("key"), F.concat(_text("^SERIES = GSE{o_orderkey}\n"), before, F.coalesce("s", F.lit("")), F.lit("\n")).alias("raw_text"))


def _tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a row of a tab: urgent ones are runs, those of status F come from another center."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").select(
        F.when(urgent, _text("SRR{o_orderkey}")).otherwise(_text("SRX{o_orderkey}")).alias("Accession"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("Status"),
        F.when(urgent, "RUN").otherwise("EXPERIMENT").alias("Type"),
        F.when(F.col("o_orderstatus") == "F", "DDBJ").otherwise("GEO").alias("Center"),
        F.when(F.col("o_totalprice") > 100000, _text("GSM{o_custkey}_r1")).otherwise(_text("lab {o_custkey}")).alias("Alias"),
        F.when(urgent, _text("SRX{o_orderkey}")).otherwise("").alias("Experiment"),
        _text("PRJNA{o_custkey}").alias("BioProject"),
        _text("SRP{o_custkey}").alias("Study"),
    )


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(accession, samples): each customer as the sample of a series of its nation."""
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_set(_text("GSM{c_custkey}")).alias("samples")).select(_text("GSE{c_nationkey}").alias("accession"), "samples")


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key): series of open orders."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(_text("GSE{o_orderkey}").alias("key"))


def _saved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of saved replies: each order's customer as an experiment, and as a project if the order is open."""
    target = F.when(F.col("o_orderstatus") == "O", _text("PRJNA7{o_custkey}")).otherwise("")
    raw = F.concat(_text("GSE{o_orderkey}\tsra\t1\tSRX7{o_custkey}\nGSE{o_orderkey}\tbioproject\t2\t"), target, F.lit("\n"))
    return table(spark, sf_dir, "orders").select(F.explode(packages.entrez_links(raw)).alias("l")).select("l.*")


_OWN_SQL = "own AS (SELECT 'SRX' || o_orderkey AS accession, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status, CASE WHEN o_orderstatus <> 'F' AND o_totalprice > 100000 THEN 'GSM' || o_custkey END AS sample FROM orders WHERE o_orderpriority <> '1-URGENT')"
_LIST_SQL = """
    live AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O'),
    want AS (SELECT accession FROM own WHERE sample IN (SELECT 'GSM' || c_custkey FROM customer WHERE c_nationkey IN (SELECT k FROM live)) UNION SELECT 'SRX' || l_partkey FROM lineitem WHERE l_orderkey IN (SELECT k FROM live))
"""


@add("SELECT DISTINCT 'SRX' || l_partkey AS found FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'")
def named_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments that the texts of live series name."""
    return reach.named_in(_texts(spark, sf_dir), reach.named_experiments, _live(spark, sf_dir))


@add("""
    WITH RECURSIVE w AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 400000 UNION SELECT o_orderkey - 1 FROM w JOIN orders ON o_orderkey = w.k WHERE o_orderstatus = 'F') SELECT 'GSE' || k AS key FROM w
""")
def related_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series reached over the relation lines of texts, in turn."""
    roots = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(_text("GSE{o_orderkey}").alias("key"))
    return reach.related(_texts(spark, sf_dir), roots)


@add(f"WITH {_OWN_SQL} SELECT * FROM own")
def tab_experiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment rows of a tab with the sample that their alias names."""
    return reach.tab_experiments(_tab(spark, sf_dir))


@add("SELECT DISTINCT 'GSM' || c_custkey AS sample FROM customer WHERE c_nationkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')")
def listed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples listed under live series."""
    return reach.samples_under(_listing(spark, sf_dir), _live(spark, sf_dir))


@add("SELECT DISTINCT 'SRX' || o_orderkey AS accession FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0")
def experiments_of_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments of a tab under wanted projects or studies."""
    customers = table(spark, sf_dir, "customer")
    parents = customers.filter("c_mktsegment = 'BUILDING'").select(_text("PRJNA{c_custkey}").alias("key")).union(customers.filter("c_acctbal < 0").select(_text("SRP{c_custkey}")))
    return reach.experiments_under(_tab(spark, sf_dir), parents)


@add(f"WITH {_OWN_SQL}, {_LIST_SQL} SELECT accession, coalesce(status, '') AS status FROM want LEFT JOIN own USING (accession)")
def experiment_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments of live series by text or sample, with the status that the tab gives them."""
    return reach.experiment_list(_texts(spark, sf_dir), _tab(spark, sf_dir), _listing(spark, sf_dir), _live(spark, sf_dir))


@add(f"WITH {_OWN_SQL}, {_LIST_SQL} SELECT accession FROM want UNION SELECT 'SRX7' || o_custkey FROM orders WHERE o_orderstatus = 'O'")
def reached_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments that live series reach from three sources of links."""
    return reach.reached(_texts(spark, sf_dir), _tab(spark, sf_dir), _listing(spark, sf_dir), _saved_links(spark, sf_dir), _live(spark, sf_dir))


@add("SELECT 'PRJNA' || o_custkey AS key FROM orders UNION SELECT 'PRJNA7' || o_custkey FROM orders WHERE o_orderstatus = 'O'")
def linked_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects that saved packages and link replies name."""
    return reach.linked_projects(packages.package_links(_packages(spark, sf_dir), relations=("BioProject",)), _saved_links(spark, sf_dir))


@add("SELECT l_orderkey AS paper, (count(*) FILTER (WHERE l_returnflag IN ('A', 'R') AND l_linestatus <> 'F'))::BIGINT + (count(*) FILTER (WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_quantity > 25))::BIGINT AS n_held, count(*)::BIGINT AS n_files FROM lineitem GROUP BY 1")
def held_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of papers that count as held: of a readable kind, with a path."""
    lines = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "A", "xml").when(F.col("l_returnflag") == "R", "pdf").otherwise("zip")
    path = F.when(F.col("l_linestatus") != "F", F.lit("a/b")).when(F.col("l_quantity") > 25, F.lit("c")).when(F.col("l_quantity") > 10, F.lit(""))
    return lines.groupBy(F.col("l_orderkey").alias("paper")).agg(F.count_if(reach.held(kind, path)).cast("long").alias("n_held"), F.count("*").cast("long").alias("n_files"))


@add("""
    SELECT 'lines' AS form, 'GSE' || o_orderkey AS accession FROM orders UNION ALL SELECT 'lines', 'GSM' || o_custkey FROM orders UNION ALL SELECT 'tab', 'SRX' || o_orderkey FROM orders
    UNION ALL SELECT 'project', 'PRJNA' || c_custkey FROM customer UNION ALL SELECT 'sample', 'SAMN' || o_orderkey FROM orders
""")
def snapshot_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accession that snapshots of four forms list."""
    root = work_path(spark, "listed")
    orders = table(spark, sf_dir, "orders")
    orders.select(_text("GSE{o_orderkey}").alias("accession"), F.array(F.struct(_text("GSM{o_custkey}").alias("accession"))).alias("samples")).write.option("compression", "gzip").json(f"{root}/lines")
    orders.select(_text("SRX{o_orderkey}").alias("Accession"), F.col("o_orderstatus").alias("Status")).write.csv(f"{root}/tab", sep="\t", header=True, quote="", escape="")
    _projects(spark, sf_dir).select("raw_text").write.text(f"{root}/project")
    _samples(spark, sf_dir).select("raw_text").write.text(f"{root}/sample")
    parts = [F.lit(form).alias("form") for form in ("lines", "tab", "project", "sample")]
    found = [readers.series_lines(spark, f"{root}/lines"), readers.first_cells(spark, f"{root}/tab"), readers.tag_accessions(spark, f"{root}/project", "ArchiveID", "BioProject"), readers.tag_accessions(spark, f"{root}/sample", "BioSample", "BioSample")]
    out = found[0].select(parts[0], "accession")
    for form, rows in zip(parts[1:], found[1:], strict=True):
        out = out.unionAll(rows.select(form, "accession"))
    return out


@add("SELECT '2024-02-01' AS newest, '2024-01-15' AS asked, count(*)::BIGINT AS n FROM customer WHERE c_acctbal > 0")
def dated_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of dated snapshots, read, and an older one by its date."""
    root = work_path(spark, "dated")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    for date, kept in (("2024-01-15", rows.filter("c_acctbal <= 0")), ("2024-02-01", rows.filter("c_acctbal > 0")), ("notadate", rows)):
        kept.write.parquet(f"{root}/{date}")
    newest, path = readers.newest_snapshot(spark, root, "*.parquet")
    asked, _ = readers.newest_snapshot(spark, root, "*.parquet", "2024-01-15")
    return spark.read.parquet(path.rsplit("/", 1)[0]).agg(F.lit(newest).alias("newest"), F.lit(asked).alias("asked"), F.count("*").cast("long").alias("n"))


@add("SELECT o_orderpriority AS source, sum(o_custkey)::BIGINT AS added, sum(o_orderkey)::BIGINT AS replaced, count(*)::BIGINT AS removed FROM orders GROUP BY 1")
def counts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a log of JSON lines in which every record stands twice and every third line is torn."""
    path = work_path(spark, "counts")
    rows = table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.col("o_orderpriority").alias("source"), F.col("o_orderkey").cast("string").alias("bucket"), F.lit("p").alias("parts"), F.col("o_custkey").alias("added"), F.col("o_orderkey").alias("replaced"), F.lit(1).alias("removed"))).alias("value"))
    rows.select(F.explode(F.array("value", "value", F.substring("value", 1, 20))).alias("value")).write.text(path)
    return readers.read_counts(spark, path)
