"""Queries on joins, aggregates and kept copies over the declared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions import fields
from tessera.functions.keys import hash_share, human_size, in_sample
from tessera.operators import copies, order, papers

from .base import Catalogue, table

CATALOGUE = Catalogue()
add = CATALOGUE.add
_LINE = ["l_orderkey", "l_linenumber"]


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as copies of (order, line); one in seven has no date."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("dated", F.when(F.col("l_partkey") % 7 > 0, F.to_date("l_shipdate")))


_RANK_SQL = """
    WITH d AS (SELECT *, CASE WHEN l_partkey % 7 > 0 THEN l_shipdate::DATE END AS dated FROM lineitem),
    a AS (SELECT *, count(*) FILTER (WHERE dated IS NULL) OVER (PARTITION BY l_orderkey, l_linenumber) = 0 AS every FROM d),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE WHEN every THEN dated END DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_tax, l_discount, l_shipdate) AS copy FROM a)
"""
_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount", "l_shipdate"]


@add(_RANK_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, dated FROM r WHERE copy = 1")
def kept_copy_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest copy where all copies are dated, else the first by key order."""
    rows = _dated(spark, sf_dir)
    return copies.kept(rows, _LINE, F.col("dated"), [F.col(c) for c in _ORDER]).select(*_LINE, "l_partkey", "l_suppkey", "dated")


@add("""
    SELECT l_orderkey, l_linenumber, min({'a': l_partkey, 'b': l_suppkey, 'c': l_quantity}).a AS l_partkey, min({'a': l_partkey, 'b': l_suppkey, 'c': l_quantity}).b AS l_suppkey,
           min({'a': l_partkey, 'b': l_suppkey, 'c': l_quantity}).c AS l_quantity FROM lineitem GROUP BY ALL
""")
def kept_copy_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole row that comes first by a lexicographic key."""
    return copies.least(table(spark, sf_dir, "lineitem"), _LINE, ["l_partkey", "l_suppkey", "l_quantity"], ["l_partkey", "l_suppkey", "l_quantity"])


@add(_RANK_SQL + """
    , k AS (SELECT * FROM r WHERE copy = 1), o AS (SELECT * FROM r WHERE copy > 1),
    n AS (SELECT o.l_orderkey, o.l_linenumber, unnest(list_filter([CASE WHEN o.l_partkey IS DISTINCT FROM k.l_partkey THEN 'l_partkey' END, CASE WHEN o.l_returnflag IS DISTINCT FROM k.l_returnflag THEN 'l_returnflag' END,
              CASE WHEN o.dated IS DISTINCT FROM k.dated THEN 'dated' END], lambda x: x IS NOT NULL)) AS name FROM o JOIN k USING (l_orderkey, l_linenumber))
    SELECT l_orderkey, l_linenumber, string_agg(DISTINCT name, '; ' ORDER BY name) AS differs FROM n GROUP BY ALL
""")
def differing_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the columns in which other copies differ from the kept one."""
    ranked = copies.rank_copies(_dated(spark, sf_dir), _LINE, F.col("dated"), [F.col(c) for c in _ORDER])
    return copies.differing(ranked, _LINE, ["l_partkey", "l_returnflag", "dated"]).withColumn("differs", F.array_join("differs", "; "))


@add("SELECT l_orderkey, count(*)::BIGINT AS n_values FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) GROUP BY 1 HAVING count(*) > 1")
def repeated_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with more than one distinct value."""
    return copies.repeated_values(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")


@add("""
    SELECT key, max(day) AS day FROM (SELECT o_custkey AS key, o_orderdate::DATE AS day, o_orderstatus = 'O' AS live FROM orders
        UNION ALL SELECT c_custkey, DATE '1994-12-31', true FROM customer UNION ALL SELECT l_orderkey, l_shipdate::DATE, l_linestatus = 'F' FROM lineitem) WHERE live GROUP BY key
""")
def known_union_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest date of each key over three sources, two of them filtered to live rows before the union."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("key"), F.to_date("o_orderdate").alias("day"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.lit("1994-12-31").cast("date").alias("day"))
    lines = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("key"), F.to_date("l_shipdate").alias("day"))
    return orders.union(customers).union(lines).groupBy("key").agg(F.max("day").alias("day"))


@add("""
    WITH f AS (SELECT l_partkey AS part, min({'d': l_shipdate, 'o': l_orderkey, 'q': l_quantity}) AS s FROM lineitem WHERE l_quantity > 30 GROUP BY 1)
    SELECT p_partkey AS part, p_name AS name, s.o AS first_order, s.q AS quantity FROM part LEFT JOIN f ON part = p_partkey WHERE p_size > 10
    UNION ALL SELECT part, NULL, s.o, s.q FROM f WHERE part NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
""")
def first_facts_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with their earliest facts, and the facts without a name: two disjoint branches."""
    facts = copies.least(table(spark, sf_dir, "lineitem").filter("l_quantity > 30"), ["l_partkey"], ["l_shipdate", "l_orderkey", "l_quantity"], ["l_orderkey", "l_quantity"])
    facts = facts.select(F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("first_order"), F.col("l_quantity").alias("quantity"))
    names = table(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("part"), F.col("p_name").alias("name"))
    named = names.join(facts, "part", "left").select("part", "name", "first_order", "quantity")
    rest = facts.join(names.select("part"), "part", "left_anti").select("part", F.lit(None).cast("string").alias("name"), "first_order", "quantity")
    return named.unionByName(rest)


@add("""
    WITH t AS (SELECT l_orderkey, min({'d': l_shipdate, 'f': l_returnflag, 'q': l_quantity}) AS s FROM lineitem WHERE l_quantity > 25 GROUP BY 1)
    SELECT o_orderkey, o_orderstatus, s.d::DATE AS day, s.f AS flag FROM orders LEFT JOIN t ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'
""")
def typed_columns_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with typed columns of a pre-aggregated, semi-filtered dimension."""
    orders = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderstatus")
    wanted = table(spark, sf_dir, "lineitem").filter("l_quantity > 25").join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    first = copies.least(wanted, ["l_orderkey"], ["l_shipdate", "l_returnflag", "l_quantity"], ["l_shipdate", "l_returnflag"])
    return orders.join(first, orders.o_orderkey == first.l_orderkey, "left").select("o_orderkey", "o_orderstatus", F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("flag"))


@add("SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1")
def agg_list_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list in a stated order for each key."""
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("s"))
    return lists.select("l_orderkey", F.array_join(F.transform("s", lambda s: s["l_partkey"].cast("string")), ",").alias("parts"))


@add("SELECT p_brand, string_agg(DISTINCT p_type, '; ' ORDER BY p_type) AS types FROM part GROUP BY 1")
def agg_string_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values joined in order."""
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), "; ").alias("types"))


@add("""
    SELECT l_returnflag, count(*)::BIGINT AS n, (count(*) FILTER (WHERE l_quantity > 40))::BIGINT AS large, count(DISTINCT l_suppkey)::BIGINT AS suppliers,
           min(l_partkey) FILTER (WHERE l_quantity > 40) AS least, bool_and(l_tax < 0.09) AS low_tax, bool_or(l_discount = 0) AS any_full FROM lineitem GROUP BY 1
""")
def filter_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered, distinct and boolean aggregates in one pass."""
    large = F.col("l_quantity") > 40
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").cast("long").alias("n"),
        F.count_if(large).cast("long").alias("large"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.min(F.when(large, F.col("l_partkey"))).alias("least"),
        F.bool_and(F.col("l_tax") < 0.09).alias("low_tax"),
        F.bool_or(F.col("l_discount") == 0).alias("any_full"),
    )


@add("SELECT k::BIGINT AS k, (SELECT quantile_disc(c_name, k / 8.0) FROM customer) AS cut FROM range(1, 8) t(k)".replace("(SELECT quantile_disc(c_name, k / 8.0) FROM customer)", "(SELECT list(c_name ORDER BY c_name)[ceil(k * count(*) / 8.0)::BIGINT] FROM customer)"))
def quantile_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact discrete quantiles of a text key."""
    return order.quantiles(table(spark, sf_dir, "customer"), "c_name", 8)


_SAMPLE_SQL = "('0x' || substr(md5('round:' || o_orderkey), 1, 15))::BIGINT"


@add(f"SELECT o_orderkey, {_SAMPLE_SQL} < (0.01 * 2::DOUBLE ^ 60)::BIGINT AS in_small FROM orders WHERE {_SAMPLE_SQL} < (0.1 * 2::DOUBLE ^ 60)::BIGINT")
def nested_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded hash sample: one percent lies inside ten percent."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").filter(in_sample(key, 0.1)).select("o_orderkey", in_sample(key, 0.01).alias("in_small"))


@add(f"SELECT o_orderkey, {_SAMPLE_SQL} AS share FROM orders ORDER BY share, o_orderkey LIMIT 20")
def hash_order_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first n keys by hash: the same at every size of cluster."""
    return table(spark, sf_dir, "orders").select("o_orderkey", hash_share(F.col("o_orderkey").cast("string"), "round:").alias("share")).orderBy("share", "o_orderkey").limit(20)


_FIELDS_SQL = """
    WITH f AS (SELECT c_custkey, list_filter([{'name': 'segment', 'value': c_mktsegment}, {'name': 'nation', 'value': c_nationkey::VARCHAR}, {'name': 'tag', 'value': CASE WHEN c_custkey % 2 = 0 THEN 'even' END},
        {'name': 'tag', 'value': CASE WHEN c_custkey % 3 = 0 THEN 'third' END}], lambda x: x.value IS NOT NULL) AS fields FROM customer)
"""


def _with_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [("segment", F.col("c_mktsegment")), ("nation", F.col("c_nationkey").cast("string")), ("tag", F.when(F.col("c_custkey") % 2 == 0, "even")), ("tag", F.when(F.col("c_custkey") % 3 == 0, "third"))]
    each = F.array(*(F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs))
    return table(spark, sf_dir, "customer").select("c_custkey", F.filter(each, lambda f: f["value"].isNotNull()).alias("fields"))


@add(_FIELDS_SQL + """
    SELECT c_custkey, array_to_string(list_transform(list_filter(fields, lambda x: x.name = 'tag'), lambda x: x.value), ',') AS tags,
           list_filter(fields, lambda x: x.name = 'tag')[1].value AS first_tag, list_filter(fields, lambda x: x.name = 'segment')[1].value AS segment FROM f
""")
def fields_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named fields as list columns in source order, and the first value of a name."""
    rows = _with_fields(spark, sf_dir)
    tags, segment = fields.pivot(F.col("fields"), ["tag", "segment"])
    return rows.select("c_custkey", F.array_join(tags, ",").alias("tags"), fields.first_of(F.col("fields"), "tag").alias("first_tag"), F.get(segment, 0).alias("segment"))


@add(_FIELDS_SQL + "SELECT x.name, x.value, count(*)::BIGINT AS n FROM (SELECT unnest(fields) AS x FROM f) WHERE x.name <> 'nation' GROUP BY ALL")
def fields_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by each of their fields."""
    each = _with_fields(spark, sf_dir).select(F.explode("fields").alias("f")).select("f.*").filter("name <> 'nation'")
    return each.groupBy("name", "value").agg(F.count("*").cast("long").alias("n"))


@add("""
    WITH t AS (SELECT c_custkey AS key, ['A' || (c_custkey // 2), 'B' || c_custkey] AS alias FROM customer),
    w AS (SELECT 'B' || c_custkey AS wanted FROM customer WHERE c_mktsegment = 'BUILDING' UNION SELECT 'A' || c_custkey FROM customer WHERE c_acctbal > 5000 UNION SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal < 0)
    SELECT wanted, coalesce((SELECT max(key) FROM t WHERE key::VARCHAR = wanted), min(u.key))::VARCHAR AS key FROM w LEFT JOIN (SELECT key, unnest(alias) AS a FROM t) u ON u.a = wanted
    GROUP BY wanted HAVING count(u.key) > 0 OR wanted IN (SELECT key::VARCHAR FROM t)
""")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by themselves or by an alias, as two equi-joins."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("n"), "c_mktsegment", "c_acctbal")
    rows = c.select(F.lpad(F.col("n").cast("string"), 12, "0").alias("key"), F.array(F.concat(F.lit("A"), F.floor(F.col("n") / 2).cast("string")), F.concat(F.lit("B"), F.col("n").cast("string"))).alias("alias"))
    wanted = c.filter("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("B"), F.col("n").cast("string")).alias("wanted"))
    wanted = wanted.union(c.filter("c_acctbal > 5000").select(F.concat(F.lit("A"), F.col("n").cast("string"))))
    wanted = wanted.union(c.filter("c_acctbal < 0").select(F.lpad(F.col("n").cast("string"), 12, "0")))
    plain = lambda x: F.when(x.startswith("0"), x.cast("long").cast("string")).otherwise(x)
    return papers.alias_lookup(wanted, rows, "key", "alias").select(plain(F.col("wanted")).alias("wanted"), F.col("key").cast("long").cast("string").alias("key"))


@add("""
    WITH m AS (SELECT user_id, user_id // 4 AS to_id FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 4 = 1),
    e AS (SELECT e.user_id AS was, coalesce(to_id, e.user_id) AS user_id, to_id IS NOT NULL AS moved, ts::DATE AS day, event_type, event_id FROM events e LEFT JOIN m USING (user_id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY moved, event_id) AS n FROM e)
    SELECT user_id, day, event_type, event_id FROM r WHERE n = 1
""")
def rekey_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows moved to their canonical key; of rows that then collide the one that was there stays."""
    events = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_type", "event_id")
    moves = events.filter("user_id % 4 = 1").select(F.col("user_id").alias("old"), F.floor(F.col("user_id") / 4).alias("new")).distinct()
    return papers.rekeyed(events, moves, "user_id", ["user_id", "day", "event_type"], ["event_id"])


@add("""
    SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type <> 'view' THEN ts::DATE END DESC NULLS LAST, ts::DATE DESC NULLS LAST, event_id) AS place FROM events
""")
def rank_new_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest first on two levels, missing dates last."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") != "view", F.to_date("ts")).alias("added"), F.to_date("ts").alias("published"))
    return papers.ranked_new_first(rows, ["user_id"], "added", "published", "event_id").select("user_id", "event_id", "place")


@add("""
    WITH c AS (SELECT source, (count(*) FILTER (WHERE lang = 'en'))::DOUBLE AS h, count(*)::DOUBLE AS n FROM documents GROUP BY 1)
    SELECT source, round((h / n + 1.9207294103470494 / n - 1.959963984540054 * sqrt(h / n * (1 - h / n) / n + 0.9603647051735247 / (n * n))) / (1 + 3.841458820694124 / n), 6) AS low,
           round((h / n + 1.9207294103470494 / n + 1.959963984540054 * sqrt(h / n * (1 - h / n) / n + 0.9603647051735247 / (n * n))) / (1 + 3.841458820694124 / n), 6) AS high FROM c
""")
def wilson_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % interval of a proportion by group."""
    n = table(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("h"), F.count("*").alias("n"))
    low, high = papers.wilson(F.col("h"), F.col("n"))
    return n.select("source", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@add("""
    SELECT source, sum(n_chars)::BIGINT AS size, CASE WHEN sum(n_chars) < 1024 THEN sum(n_chars) || ' B' WHEN sum(n_chars) < 1048576 THEN printf('%.1f', sum(n_chars) / 1024.0) || ' KiB' ELSE printf('%.1f', sum(n_chars) / 1048576.0) || ' MiB' END AS shown FROM documents GROUP BY 1
""")
def folder_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes by group, for people to read."""
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").cast("long").alias("size"))
    return sizes.select("source", "size", human_size(F.col("size")).alias("shown"))


@add("""
    SELECT o_custkey, max(o_orderdate::DATE) AS day, max_by(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS newest FROM orders GROUP BY 1
""")
def newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of each id, the higher key on a tie."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("day"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("newest"))
