"""Queries on papers' standings and closed copies, on work in rounds, on sealed tables and on lookups that skip what they need not read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera import schema
from tessera.functions import keys, text as tx
from tessera.operators import packages, paper_files, parts, refresh, rounds, standing
from tessera.sources import seals
from tessera.sources.scratch import work_path
from tessera.sources.tables import Versions
from tessera.store import Store

from .base import Catalogue, table
from .build_queries import _packages, _tasks, _text

CATALOGUE = Catalogue()
add = CATALOGUE.add

_TIER = {"A": "pmc", "N": "openalex", "R": "host"}


def _tier() -> F.Column:
    return F.create_map(*(F.lit(x) for p in _TIER.items() for x in p))[F.col("l_returnflag")]


def _paper_tables(spark: SparkSession, sf_dir: str, parts: str = "true") -> dict[str, DataFrame]:
    """Parts, or those of a condition, as papers; lines of high price as attempts, those of the highest as files."""
    size = F.col("p_size")
    papers = table(spark, sf_dir, "part").filter(parts).select(
        _text("P{p_partkey}").alias("paper"),
        F.col("p_partkey").cast("long").alias("pmid"),
        F.when(size > 35, _text("PMC{p_partkey}")).alias("pmcid"),
        _text("10.1000/{p_partkey}").alias("doi"),
        F.array(_text("10.2000/X{p_partkey}")).alias("other_dois"),
        (F.col("p_retailprice") > 950).alias("openalex_pdf"),
        F.when(F.col("p_type").startswith("S"), F.array(F.lit("https://x.org"))).alias("host_links"),
        F.when(size < 5, F.lit("2024-01-01")).otherwise("2020-01-01").cast("date").alias("published"),
        F.when(size == 50, "skipped").alias("status"),
        F.when(size == 50, "placeholder").alias("reason"),
        (size == 49).alias("retracted"),
    )
    lines = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    outcome = F.when(q < 44, "error").when(q < 46, "failed").when(q < 48, "blocked").otherwise("empty")
    attempts = lines.filter("l_extendedprice > 80000").select(_text("P{l_partkey}").alias("paper"), _tier().alias("tier"), F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").cast("string").alias("account"), outcome.alias("outcome"))
    files = lines.filter("l_extendedprice > 85000").select(_text("P{l_partkey}").alias("paper"), F.when(F.col("l_linestatus") == "F", "xml").otherwise("pdf").alias("kind"), _text("{l_orderkey}-{l_linenumber}").alias("name"), F.when(q > 48, "a/b").otherwise("").alias("path"), _tier().alias("tier"))
    return {"papers": papers, "attempts": attempts, "files": files}


_PAPER_SQL = """
    p AS (SELECT 'P' || p_partkey AS paper, p_size AS size, p_size > 35 AS pmc, p_retailprice > 950 AS oa, p_type LIKE 'S%' AS host, p_partkey FROM part),
    a AS (SELECT 'P' || l_partkey AS paper, CASE l_returnflag WHEN 'A' THEN 'pmc' WHEN 'N' THEN 'openalex' ELSE 'host' END AS tier, l_shipdate::DATE AS date, l_suppkey::VARCHAR AS account,
        CASE WHEN l_quantity < 44 THEN 'error' WHEN l_quantity < 46 THEN 'failed' WHEN l_quantity < 48 THEN 'blocked' ELSE 'empty' END AS outcome FROM lineitem WHERE l_extendedprice > 80000),
    f AS (SELECT 'P' || l_partkey AS paper, CASE WHEN l_linestatus = 'F' THEN 'xml' ELSE 'pdf' END AS kind, l_orderkey || '-' || l_linenumber AS name, CASE WHEN l_quantity > 48 THEN 'a/b' ELSE '' END AS path,
        CASE l_returnflag WHEN 'A' THEN 'pmc' WHEN 'N' THEN 'openalex' ELSE 'host' END AS tier FROM lineitem WHERE l_extendedprice > 85000)
"""


@add(f"""
    WITH {_PAPER_SQL},
    t AS (SELECT paper, count(*) FILTER (WHERE tier = 'pmc' AND outcome = 'error') AS pe, count(*) FILTER (WHERE tier = 'pmc' AND outcome <> 'error') AS po, count(*) FILTER (WHERE tier = 'openalex') AS n,
        count(*) FILTER (WHERE tier = 'openalex' AND outcome = 'error') AS ne, count(*) FILTER (WHERE tier = 'openalex' AND outcome = 'failed') AS nf, count(*) FILTER (WHERE tier = 'host') AS h,
        (list(outcome ORDER BY date DESC, account DESC, outcome DESC) FILTER (WHERE tier = 'host'))[1] AS hl FROM a GROUP BY 1),
    x AS (SELECT paper, (list(tier ORDER BY name, tier) FILTER (WHERE kind = 'xml'))[1] AS xml_tier, (list(tier ORDER BY name, tier) FILTER (WHERE kind = 'pdf'))[1] AS pdf_tier FROM f WHERE path <> '' GROUP BY 1),
    m AS (SELECT p.*, xml_tier, pdf_tier, x.paper IS NOT NULL AS held, coalesce(h, 0) AS h, hl, coalesce(n, 0) AS n,
        CASE WHEN pmc AND coalesce(po, 0) = 0 AND coalesce(pe, 0) < 3 THEN 'pmc' WHEN oa AND coalesce(nf, 0) = 0 AND coalesce(ne, 0) < 3 THEN 'openalex' WHEN host AND coalesce(h, 0) = 0 THEN 'host' ELSE 'paperpile' END AS near FROM p LEFT JOIN t USING (paper) LEFT JOIN x USING (paper))
    SELECT paper, CASE WHEN size IN (49, 50) THEN 'skipped' WHEN held THEN 'fetched' WHEN size < 5 OR near <> 'paperpile' THEN 'waiting' ELSE 'manual' END AS status,
        CASE WHEN size = 50 THEN 'placeholder' WHEN size = 49 THEN 'retracted' WHEN held THEN NULL WHEN size < 5 THEN 'pmc-embargo' WHEN near = 'pmc' THEN 'pmc-sync' WHEN near = 'openalex' THEN 'openalex-backlog' WHEN near = 'host' THEN 'host-link'
             WHEN h > 0 THEN CASE WHEN hl = 'blocked' THEN 'host-blocked' ELSE 'host-failed' END WHEN n > 0 THEN 'openalex-failed' ELSE 'no-route' END AS reason,
        CASE WHEN size IN (49, 50) OR held THEN NULL WHEN size < 5 AND near NOT IN ('pmc', 'host') THEN NULL ELSE near END AS tier, xml_tier, pdf_tier FROM m
""")
def paper_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every paper stands by its row, its attempts in order and its held files."""
    t = _paper_tables(spark, sf_dir)
    return standing.standings(t["papers"], t["attempts"], t["files"], F.lit("2024-06-01").cast("date"))


@add(f"WITH {_PAPER_SQL} SELECT paper, name FROM f WHERE kind = 'pdf' AND tier <> 'pmc' AND paper IN (SELECT paper FROM f WHERE kind = 'xml' AND tier = 'pmc' AND path <> '')")
def replaced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed files that the first tier's marked-up text replaces."""
    return standing.replaced(_paper_tables(spark, sf_dir)["files"]).select("paper", "name")


@add(f"""
    WITH {_PAPER_SQL}, i AS (SELECT paper, p_partkey, size FROM p WHERE size > 5),
    l AS (SELECT DISTINCT o_custkey AS c, l_partkey AS k FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' AND l_quantity > 30),
    w AS (SELECT DISTINCT paper FROM i JOIN l ON k = p_partkey)
    SELECT 'papers' AS part, paper AS key, 1::BIGINT AS n FROM i WHERE paper IN (FROM w) UNION ALL SELECT 'attempts', paper, count(*)::BIGINT FROM a WHERE paper IN (FROM w) GROUP BY 2 UNION ALL SELECT 'files', paper, count(*)::BIGINT FROM f WHERE paper IN (FROM w) GROUP BY 2
    UNION ALL SELECT 'outside', 'PRJNA' || c, count(*)::BIGINT FROM l WHERE k NOT IN (SELECT p_partkey FROM i) GROUP BY 2
""")
def paper_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed copy of the paper tables for the papers that held projects link by PMID, DOI or another DOI, and the links that lead outside."""
    tables = _paper_tables(spark, sf_dir, "p_size > 5")
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 30").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.col("l_returnflag")
    key = F.col("l_partkey").cast("string")
    # each pair of a customer and a part is linked by one name, the one of its least flag
    one = lines.groupBy("o_custkey", "l_partkey", "o_orderstatus").agg(F.min(flag).alias("l_returnflag"))
    first = one.filter("o_orderstatus <> 'F'").groupBy("o_custkey", "l_partkey").agg(F.min("l_returnflag").alias("l_returnflag"))
    to = F.when(flag == "A", F.concat(F.lit("PMID:"), key)).when(flag == "N", F.concat(F.lit("DOI:10.1000/"), key)).otherwise(F.concat(F.lit("DOI:10.2000/x"), key))
    links = first.select(_text("PRJNA{o_custkey}").alias("from"), to.alias("to"), F.when(flag == "A", "PubMed").otherwise("DOI").alias("relation"))
    other = one.filter("o_orderstatus = 'F'").select(_text("SAMN{o_custkey}").alias("from"), to.alias("to"), F.lit("PubMed").alias("relation"))
    held = orders.select(_text("PRJNA{o_custkey}").alias("accession"), F.lit("BioProject").alias("type")).union(orders.select(_text("SAMN{o_custkey}"), F.lit("BioSample")))
    kept, outside = standing.paper_subset(tables, links.union(other), held)
    each = [kept[name].groupBy(F.lit(name).alias("part"), F.col("paper").alias("key")).agg(F.count("*").cast("long").alias("n")) for name in sorted(kept)]
    return reduce(DataFrame.union, [*each, outside.groupBy(F.lit("outside"), "accession").agg(F.count("*").cast("long"))])


@add("""
    SELECT 'ORD' || o_orderkey AS accession, CASE left(o_orderpriority, 1) WHEN '1' THEN 'gone' WHEN '2' THEN 'gone' WHEN '3' THEN 'served' WHEN '4' THEN 'served' ELSE 'failed' END AS state,
        CASE left(o_orderpriority, 1) WHEN '1' THEN 2 WHEN '2' THEN 2 WHEN '3' THEN 1 WHEN '4' THEN 1 ELSE 2 END::BIGINT AS asked, CASE left(o_orderpriority, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 1 WHEN '4' THEN 2 END::INTEGER AS settled
    FROM orders WHERE o_orderstatus <> 'O'
""")
def confirmed_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates asked in rounds, one of them replayed: what settled each, in which round, and what failed only."""
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'").select(_text("ORD{o_orderkey}").alias("accession"), F.substring("o_orderpriority", 1, 1).alias("p"))
    state = rounds.Confirmations(spark, work_path(spark, "asked"))

    def ask(number: int, asked: DataFrame, said: dict[str, str]) -> None:
        answer = F.create_map(*(F.lit(x) for pair in said.items() for x in pair))[F.col("p")]
        state.record(number, asked.select("accession", answer.alias("state")).filter("state is not null"))

    ask(1, rows, {"1": "gone", "2": "failed", "3": "served"})
    second = rows.join(state.pending(rows), "accession", "left_semi")
    for _ in range(2):  # killed after it was written, and done again
        ask(2, rows.filter("p in ('2', '4', '5')"), {"2": "gone", "4": "served", "5": "failed"})
    third = rows.filter("p = '1'").unionByName(second.filter("p = '5'"))
    ask(3, third, {"1": "served", "5": "failed"})
    return state.states(rows)


@add("""
    WITH RECURSIVE n AS (SELECT o_orderkey AS k, o_orderkey - 1 AS b, o_orderstatus = 'F' AS names, o_orderpriority NOT LIKE '1%' AS ok, o_orderpriority NOT LIKE '2%' AS again FROM orders),
    a AS (SELECT o_orderkey AS k FROM orders WHERE o_totalprice > 300000 UNION SELECT n.b FROM a JOIN n ON n.k = a.k WHERE n.names AND n.ok),
    late AS (SELECT n.k, n.b, n.names FROM n JOIN a USING (k) WHERE NOT n.ok AND n.again AND n.k < (SELECT max(o_orderkey) / 2 FROM orders)),
    c AS (SELECT b AS k FROM late WHERE names AND b NOT IN (FROM a) UNION SELECT n.b FROM c JOIN n ON n.k = c.k WHERE n.names AND n.ok AND n.b NOT IN (FROM a)),
    seen AS (SELECT k FROM a UNION SELECT k FROM c)
    SELECT 'GSE' || seen.k AS key, coalesce(CASE WHEN seen.k IN (SELECT k FROM late) THEN true ELSE n.ok END, false) AS held FROM seen LEFT JOIN n USING (k)
""")
def breadth_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series reached over the parts that texts name, where fetches fail: a retry of all that failed, and what its texts name in turn."""
    rows = table(spark, sf_dir, "orders")
    half = rows.agg(F.max("o_orderkey").alias("m")).first()["m"] / 2
    line = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("!Series_relation = SuperSeries of: GSE"), (F.col("o_orderkey") - 1).cast("string"))).otherwise("!Series_title = t")
    site = rows.select(_text("GSE{o_orderkey}").alias("key"), "o_orderkey", F.col("o_orderpriority").startswith("1").alias("slow"), F.concat(_text("^SERIES = GSE{o_orderkey}\n"), line).alias("text"))

    def fetch(keys: DataFrame, attempt: int) -> DataFrame:
        there = F.when(~F.col("slow") | (F.lit(attempt == 1) & (F.col("o_orderkey") < half)), F.col("text"))
        return site.join(rounds.short(keys), "key").select("key", there.alias("raw_text"))

    roots = rows.filter("o_totalprice > 300000").select(_text("GSE{o_orderkey}").alias("key"))
    return rounds.breadth_with_retry(roots, fetch, lambda texts: texts.select(F.explode(packages.subseries(F.col("raw_text"))).alias("next"))).select("key", "held")


@add("""
    SELECT 'orders' AS name, count(*)::BIGINT AS rows, 'sound' AS state FROM orders UNION ALL SELECT 'customers', count(*)::BIGINT, 'sound' FROM customer
    UNION ALL SELECT 'orders', count(*)::BIGINT, 'not in the seal' FROM orders UNION ALL SELECT 'customers', 0, 'missing' UNION ALL SELECT 'customers', 0, 'not in the seal'
""")
def sealed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables sealed by rows, bytes and checksum of each file; a file added, and a table written anew, are found."""
    root = work_path(spark, "sealed")
    paths = {"orders": f"{root}/orders", "customers": f"{root}/customers"}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name").coalesce(1)
    orders.write.parquet(paths["orders"])
    customers.write.parquet(paths["customers"])
    seals.seal(spark, paths).write.parquet(f"{root}/seal")
    sealed = spark.read.parquet(f"{root}/seal")
    first = seals.broken_seals(spark, sealed, paths).count()
    sound = seals.inputs_of(sealed).select(F.col("table").alias("name"), "rows", F.when(F.lit(first == 0), "sound").otherwise("broken").alias("state"))
    orders.coalesce(1).write.mode("append").parquet(paths["orders"])
    customers.withColumn("c_name", F.lit("x")).write.mode("overwrite").parquet(paths["customers"])
    broken = seals.broken_seals(spark, sealed, paths).groupBy(F.col("table").alias("name"), F.col("fault").alias("state")).agg(F.count("*").alias("n"))
    added = spark.read.parquet(paths["orders"]).count() - orders.count()
    return sound.unionByName(broken.select("name", F.when(F.col("name") == "orders", F.lit(added)).otherwise(0).cast("long").alias("rows"), "state"))


@add("""
    SELECT 'SRX' || l_orderkey AS accession, string_agg(DISTINCT 'SRR' || l_orderkey || '0' || l_linenumber, ',' ORDER BY 'SRR' || l_orderkey || '0' || l_linenumber) AS runs, true AS there
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY l_orderkey
""")
def marked_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages that hold a run marked as not public, with those runs, and their texts fetched last."""
    marked = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select(_text("SRR{l_orderkey}0{l_linenumber}").alias("run"))
    found = refresh.with_marked_runs(_packages(spark, sf_dir), marked)
    return found.select("accession", F.array_join("runs", ",").alias("runs"), F.col("raw_text").startswith("<EXPERIMENT_PACKAGE>").alias("there"))


@add("""
    SELECT 'SRR' || l_orderkey || '0' || l_linenumber AS accession, CASE WHEN min(l_quantity) > 25 THEN min(l_quantity)::BIGINT || '+' || round_even(min(l_quantity) + 0.5, 0)::BIGINT ELSE '' END AS structure, (min(l_quantity) > 25)::BIGINT * 2 AS n_reads FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_linenumber
""")
def run_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of packages with the lengths of their reads by index, rounded half to even."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").repartition(_tasks(spark), "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").cast("double").alias("q"))
    reads = F.when(F.col("q") > 25, F.concat(F.lit('<Statistics><Read index="1" average="'), (F.col("q") + 0.5).cast("string"), F.lit('"/><Read average="7"/><Read index="0" average="'), F.col("q").cast("string"), F.lit('"/></Statistics>'))).otherwise("")
    runs = lines.groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.concat(_text('<RUN accession="SRR{l_orderkey}0{l_linenumber}">'), reads, F.lit("</RUN>"))), "").alias("runs"))
    known = runs.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")).repartition(_tasks(spark), "l_orderkey"), "l_orderkey", "left_semi")
    texts = known.select(_text("SRX{l_orderkey}").alias("accession"), F.concat(F.lit("<P>"), "runs", F.lit("</P>")).alias("raw_text"))
    return parts.run_blocks(texts).select("accession", "structure", F.size("lengths").cast("long").alias("n_reads"))


@add("""
    WITH k AS (SELECT * FROM orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.97 FROM orders))
    SELECT 'GSM' || lpad(o_orderkey::VARCHAR, 12, '0') AS accession, o_orderstatus AS status, 'text ' || o_custkey AS raw_text FROM k
""")
def range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a key list, found by ranges of keys in a table sorted by key."""
    key = F.concat(F.lit("GSM"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(key.alias("accession"), F.lit("GEO Sample").alias("type"), F.col("o_orderstatus").alias("status"), *(F.lit(None).cast(t).alias(c) for c, t in (("submitted", "date"), ("updated", "date"), ("published", "date"))), F.lit(None).cast(schema.FIELDS).alias("fields"), _text("text {o_custkey}").alias("raw_text"), F.lit("").alias("content_hash"), F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    versions = Versions(spark, work_path(spark, "ranges"))
    versions.write("v", {schema.RECORDS: rows})
    versions.publish("v")
    most = orders.agg(F.max("o_totalprice").alias("m"))
    wanted = orders.join(F.broadcast(most), F.col("o_totalprice") > F.col("m") * 0.97).select(key.alias("k"))
    return Store(spark, versions.root, "v").open_many([r.k for r in wanted.collect()]).select("accession", "status", "raw_text")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paper, raw_text): each part as a paper with a figure in two sizes, a supplement named twice, a table's image and an inline one."""
    raw = _text(
        '<article xmlns:xlink="x"><fig id="f"><label>Figure {p_partkey}</label><caption><p>{p_name}, H<sub>2</sub>O</p></caption><graphic xlink:href="f{p_partkey}"/></fig><p>see <inline-graphic xlink:href="a/i{p_partkey}.gif"/></p>',
        '<supplementary-material><label>S1</label><caption><title>Size  {p_size}</title></caption><media xlink:href="s{p_partkey}.xlsx"/></supplementary-material><supplementary-material xlink:href="s{p_partkey}.xlsx"><label>S2</label></supplementary-material>',
        '<table-wrap><label>Table 1</label><alternatives><graphic xlink:href="t{p_partkey}.jpg"/></alternatives></table-wrap></article>',
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").repartition(_tasks(spark), "p_partkey").select(_text("P{p_partkey}").alias("paper"), "p_partkey", "p_size", F.when(F.col("p_size") > 48, F.substring_index(raw, "</article>", 1)).otherwise(raw).alias("raw_text"))


@add("""
    SELECT 'P' || p_partkey AS paper, unnest(['supplement', 'figure', 'figure', 'inline']) AS kind, unnest(['s' || p_partkey || '.xlsx', 'f' || p_partkey, 't' || p_partkey || '.jpg', 'i' || p_partkey || '.gif']) AS href,
        unnest(['S1; S2', 'Figure ' || p_partkey, 'Table 1', NULL]) AS label, unnest(['Size ' || p_size, p_name || ', H2O', NULL, NULL]) AS caption FROM part WHERE p_size <= 48
""")
def paper_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplements, figures and inline images that papers name, with labels and captions; a text cut off names none."""
    return paper_files.named_files(_articles(spark, sf_dir))


@add("""
    WITH p AS (SELECT p_partkey AS k, p_size <= 48 AS whole FROM part)
    SELECT 'P' || k AS paper, 's' || k || '.xlsx' AS name, 'supplement' AS kind, CASE WHEN whole THEN 'S1; S2' END AS label FROM p UNION ALL SELECT 'P' || k, 'f' || k || '.jpg', 'figure', 'Figure ' || k FROM p WHERE whole
    UNION ALL SELECT 'P' || k, 't' || k || '.jpg', 'figure', 'Table 1' FROM p WHERE whole UNION ALL SELECT 'P' || k, 'other.zip', 'supplement', NULL FROM p
""")
def paper_chosen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files to keep: supplements, the largest image of each figure, neither inline nor unsafe ones."""
    articles = _articles(spark, sf_dir)
    names = F.array(*(F.struct(n.alias("name"), F.lit(size).cast("long").alias("size")) for n, size in ((_text("s{p_partkey}.xlsx"), 5), (_text("f{p_partkey}.gif"), 1), (_text("f{p_partkey}.jpg"), 9), (_text("t{p_partkey}.jpg"), 2), (_text("i{p_partkey}.gif"), 3), (F.lit("other.zip"), 4), (F.lit("a/b.zip"), 4), (F.lit(".x"), 4))))
    listing = articles.select("paper", F.explode(names).alias("f")).select("paper", "f.name", "f.size")
    return paper_files.chosen_files(listing, paper_files.named_files(articles)).select("paper", "name", "kind", "label")


@add("""
    SELECT o_orderkey, 200000000 + o_orderkey AS series, CASE WHEN o_custkey > 0 THEN 'GSM' || o_custkey END AS sample, 'papers/' || CASE WHEN length((o_orderkey * 7)::VARCHAR) > 3 THEN left((o_orderkey * 7)::VARCHAR, length((o_orderkey * 7)::VARCHAR) - 3) ELSE '' END || 'nnn/' || (o_orderkey * 7) AS folder,
        'papers/doi/10.1000%2Fa%28' || o_custkey || '%29' AS doi_folder, o_orderstatus || ' is ' || o_custkey || ' is' AS abstract FROM orders
""")
def ids_and_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric ids of series and samples both ways, folders of papers by number and by name, and an abstract from places of words."""
    index = F.map_from_arrays(F.array(F.lit("is"), F.col("o_orderstatus"), _text("{o_custkey}")), F.array(F.array(F.lit(1), F.lit(3)), F.array(F.lit(0)), F.array(F.lit(2))))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        keys.uid_of(_text("GSE{o_orderkey}")).alias("series"),
        keys.accession_of_uid(F.col("o_custkey") + F.lit(300_000_000)).alias("sample"),
        keys.paper_folder((F.col("o_orderkey") * 7).cast("string")).alias("folder"),
        keys.paper_folder(_text("10.1000/a({o_custkey})")).alias("doi_folder"),
        tx.text_from_places(index).alias("abstract"),
    )
