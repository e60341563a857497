"""Queries on nodes and links: lookups, walks, closures, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.keys import bucket_of, kind_of, number_of, prefix_of
from tessera.operators import graph, order, refresh

from .base import HOLDINGS_SQL, LINKS_SQL, Catalogue, holdings, links, node, table

CATALOGUE = Catalogue()
add = CATALOGUE.add


@add(f"SELECT type, count(*)::BIGINT AS n, min(accession) AS example FROM ({HOLDINGS_SQL}) GROUP BY type")
def nodes_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group count with the least example."""
    return holdings(spark, sf_dir).groupBy("type").agg(F.count("*").cast("long").alias("n"), F.min("accession").alias("example"))


@add(f"SELECT f AS \"from\", t AS \"to\", r AS relation FROM ({LINKS_SQL})")
def edges_by_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct links in the order of their near end."""
    return links(spark, sf_dir).select("from", "to", "relation").distinct().orderBy("from", "to", "relation")


@add(f"SELECT t AS \"to\", count(*)::BIGINT AS n_from, count(DISTINCT r)::BIGINT AS n_relations FROM ({LINKS_SQL}) GROUP BY t")
def edges_by_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links seen from their far end."""
    return links(spark, sf_dir).select("from", "to", "relation").distinct().groupBy("to").agg(F.count("*").cast("long").alias("n_from"), F.countDistinct("relation").alias("n_relations"))


@add("""
    SELECT 'CUS' || o_custkey AS key, 'ORD' || o_orderkey AS other, 'reverse' AS direction FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION SELECT 'ORD' || o_orderkey, 'CUS' || o_custkey, 'forward' FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def follow_one_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One relation both ways for a key list."""
    edge = links(spark, sf_dir, ("customer",))
    orders = table(spark, sf_dir, "orders")
    builders = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    back = graph.follow(edge, builders.select(node("CUS", "c_custkey").alias("key")), "customer", reverse=True)
    out = graph.follow(edge, orders.filter("o_orderpriority = '1-URGENT'").select(node("ORD", "o_orderkey").alias("key")), "customer")
    return back.withColumn("direction", F.lit("reverse")).union(out.withColumn("direction", F.lit("forward")))


@add(f"""
    WITH l AS ({LINKS_SQL}), k AS (SELECT 'NAT' || n_nationkey AS key FROM nation WHERE n_regionkey = 1)
    SELECT DISTINCT f AS "from", t AS "to", r AS relation FROM l WHERE f IN (SELECT key FROM k) OR t IN (SELECT key FROM k)
""")
def links_both_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with a wanted key at either end, each once."""
    keys = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(node("NAT", "n_nationkey").alias("key"))
    return graph.both_ends(links(spark, sf_dir), keys)


@add("""
    SELECT c_nationkey::BIGINT AS nation, l_partkey AS part, count(*)::BIGINT AS n_paths FROM customer
    JOIN orders ON o_custkey = c_custkey JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey
    GROUP BY ALL
""")
def two_hop_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer to part over orders, filtered on the far side before the join."""
    hop = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = hop.join(orders, hop.l_orderkey == orders.o_orderkey).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("c_nationkey").cast("long").alias("nation"), F.col("l_partkey").alias("part")).agg(F.count("*").cast("long").alias("n_paths"))


@add("""
    SELECT p_partkey AS part FROM part WHERE NOT EXISTS (
        SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        WHERE l_partkey = p_partkey AND c_mktsegment = 'BUILDING')
""")
def no_two_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that no customer of a segment has ordered: an anti join on two hops."""
    buyers = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    ordered = table(spark, sf_dir, "orders").join(buyers, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    bought = table(spark, sf_dir, "lineitem").join(ordered, "l_orderkey", "left_semi").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").join(bought, "p_partkey", "left_anti").select(F.col("p_partkey").alias("part"))


#: Down from a region to the parts that its customers have ordered.
DOWN = [("REG", "region", True), ("NAT", "nation", True), ("CUS", "customer", True), ("ORD", "part", False)]


@add(f"""
    WITH RECURSIVE l AS ({LINKS_SQL}),
    h AS (SELECT t AS a, f AS b FROM l WHERE (t LIKE 'REG%' AND r = 'region') OR (t LIKE 'NAT%' AND r = 'nation') OR (t LIKE 'CUS%' AND r = 'customer')
          UNION SELECT f, t FROM l WHERE f LIKE 'ORD%' AND r = 'part'),
    w AS (SELECT 'REG' || r_regionkey AS root, 'REG' || r_regionkey AS node FROM region UNION SELECT w.root, h.b FROM w JOIN h ON h.a = w.node)
    SELECT root, left(node, 3) AS kind, count(*)::BIGINT AS n FROM w GROUP BY ALL
""")
def walk_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed walk from several roots, each node once for each root."""
    roots = table(spark, sf_dir, "region").select(node("REG", "r_regionkey").alias("key"))
    found = graph.walk(links(spark, sf_dir, ("region", "nation", "customer", "part")), roots, DOWN)
    return found.groupBy("root", F.substring("node", 1, 3).alias("kind")).agg(F.count("*").cast("long").alias("n"))


_CLOSURE_SQL = f"""
    WITH RECURSIVE l AS ({LINKS_SQL}),
    w AS (SELECT 'ORD' || o_orderkey AS key FROM orders WHERE o_totalprice > 450000
          UNION SELECT l.t FROM w JOIN l ON l.f = w.key WHERE l.t NOT IN (SELECT 'PRT' || p_partkey FROM part WHERE p_size < 6))
"""


def _closed(spark: SparkSession, sf_dir: str, edge: DataFrame) -> DataFrame:
    roots = table(spark, sf_dir, "orders").filter("o_totalprice > 450000").select(node("ORD", "o_orderkey").alias("key"))
    barred = table(spark, sf_dir, "part").filter("p_size < 6").select(node("PRT", "p_partkey").alias("key"))
    return graph.closure(edge, roots, ["customer", "nation", "region", "part", "supplier"], barred=barred)


@add(_CLOSURE_SQL + "SELECT key FROM w")
def closure_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward closure that never enters barred nodes."""
    return _closed(spark, sf_dir, links(spark, sf_dir))


@add(_CLOSURE_SQL + """
    SELECT DISTINCT CASE WHEN f IN (SELECT key FROM w) THEN f ELSE t END AS member, CASE WHEN f IN (SELECT key FROM w) THEN t ELSE f END AS other, r AS relation
    FROM l WHERE (f IN (SELECT key FROM w)) <> (t IN (SELECT key FROM w)) AND r IN ('part', 'region')
""")
def unlisted_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with exactly one end in a subset."""
    edge = links(spark, sf_dir)
    return graph.one_ended(edge.filter("relation in ('part', 'region')"), _closed(spark, sf_dir, edge))


@add("""
    WITH k AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_totalprice > 480000),
    RECURSIVE_UP AS (SELECT 'CUS' || key AS key FROM k UNION SELECT 'NAT' || c_nationkey FROM k JOIN customer ON c_custkey = key UNION SELECT 'REG' || n_regionkey FROM k JOIN customer ON c_custkey = key JOIN nation ON n_nationkey = c_nationkey)
    SELECT key FROM RECURSIVE_UP
""")
def kept_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept keys and every parent over them, until nothing changes."""
    kept = table(spark, sf_dir, "orders").filter("o_totalprice > 480000").select(node("CUS", "o_custkey").alias("key")).distinct()
    tree = links(spark, sf_dir, ("nation", "region")).select(F.col("from").alias("child"), F.col("to").alias("parent"))
    return graph.kept_parents(tree, kept)


@add("""
    WITH w AS (SELECT o_orderkey + 200 AS key FROM orders UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderstatus = 'P')
    SELECT key, CASE WHEN key IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN 'held' WHEN key IN (SELECT o_orderkey FROM orders) THEN 'not mirrored' ELSE 'not found' END AS state FROM w
""")
def absent_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted keys as held, not mirrored or not found."""
    orders = table(spark, sf_dir, "orders")
    wanted = orders.select((F.col("o_orderkey") + 200).alias("key")).union(orders.filter("o_orderstatus = 'P'").select((-F.col("o_orderkey")).alias("key")))
    known = orders.select(F.col("o_orderkey").alias("key"))
    return refresh.absent_class(wanted, orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key")), known, "key")


@add("""
    SELECT substr(c_name, 1, 8) AS prefix, c_name AS key, row_number() OVER (PARTITION BY regexp_extract(c_name, '^([A-Za-z]+)', 1) ORDER BY length(c_name), c_name) - 1 AS place FROM customer
""")
def natural_order_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural order: prefix, length, text."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_name").alias("key"))
    return order.natural_rank(keys, "key").select(F.substring("key", 1, 8).alias("prefix"), "key", "place")


@add("""
    SELECT 'ORD' || CASE WHEN length(o_orderkey::VARCHAR) > 3 THEN left(o_orderkey::VARCHAR, length(o_orderkey::VARCHAR) - 3) ELSE '' END || 'nnn' AS bucket, count(*)::BIGINT AS n, min(o_orderkey)::BIGINT AS least, max(o_orderkey)::BIGINT AS most
    FROM orders GROUP BY 1
""")
def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by bucket of 1,000."""
    keys = table(spark, sf_dir, "orders").select(node("ORD", "o_orderkey").alias("key"))
    return keys.groupBy(bucket_of(F.col("key"), 1000).alias("bucket")).agg(F.count("*").cast("long").alias("n"), F.min(number_of(F.col("key"))).alias("least"), F.max(number_of(F.col("key"))).alias("most"))


@add("""
    WITH a AS (SELECT CASE l_linenumber % 5 WHEN 0 THEN 'GSE' WHEN 1 THEN 'GSM' WHEN 2 THEN 'SRX' WHEN 3 THEN 'SRR' ELSE 'XYZ' END || l_partkey AS accession FROM lineitem)
    SELECT CASE left(accession, 3) WHEN 'GSE' THEN 'Series' WHEN 'GSM' THEN 'Sample' WHEN 'SRX' THEN 'Experiment' WHEN 'SRR' THEN 'Run' END AS kind, left(accession, 3) AS prefix, count(*)::BIGINT AS n FROM a GROUP BY ALL
""")
def accession_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record kinds by full match of the key."""
    # Prefixes made up for this query.
    made = F.element_at(F.array(*map(F.lit, ("GSE", "GSM", "SRX", "SRR", "XYZ"))), (F.col("l_linenumber") % 5 + 1).cast("int"))
    keys = table(spark, sf_dir, "lineitem").select(F.concat(made, F.col("l_partkey").cast("string")).alias("accession"))
    return keys.groupBy(kind_of(F.col("accession")).alias("kind"), prefix_of(F.col("accession")).alias("prefix")).agg(F.count("*").cast("long").alias("n"))


@add("""
    SELECT 'both' AS part, count(*)::BIGINT AS n FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT 'only F', count(*)::BIGINT FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT 'only P', count(*)::BIGINT FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def key_set_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference and intersection of two key sets in one pass over the table."""
    each = table(spark, sf_dir, "orders").filter("o_orderstatus in ('F', 'P')").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("f"), F.bool_or(F.col("o_orderstatus") == "P").alias("p"))
    part = F.when(F.col("f") & F.col("p"), "both").when(F.col("f"), "only F").otherwise("only P")
    names = spark.createDataFrame([("both",), ("only F",), ("only P",)], "part string")
    counts = each.groupBy(part.alias("part")).agg(F.count("*").cast("long").alias("n"))
    return names.join(counts, "part", "left").select("part", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
