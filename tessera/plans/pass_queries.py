"""Queries on what a refresh pass decides: inventories, accounts, attempts in order, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.keys import number_of, prefix_of
from tessera.operators import order, refresh

from .base import Catalogue, node, table

CATALOGUE = Catalogue()
add = CATALOGUE.add


@add("""
    SELECT key, CASE WHEN key IN (SELECT c_custkey FROM customer WHERE c_acctbal > 8000) THEN 'rich' WHEN key IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN 'large' ELSE 'segment' END AS reason
    FROM (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 8000 UNION SELECT o_custkey FROM orders WHERE o_totalprice > 450000 UNION SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def ordered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of several sources in order; the first that names a key wins."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_acctbal", "c_mktsegment")
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("key"))
    return refresh.change_list([("rich", c.filter("c_acctbal > 8000")), ("large", large), ("segment", c.filter("c_mktsegment = 'BUILDING'"))], "key")


@add("""
    WITH i AS (SELECT l_orderkey AS id, max(l_shipdate)::DATE AS version FROM lineitem WHERE l_linenumber > 2 GROUP BY 1),
    f AS (SELECT l_orderkey AS id, max(l_shipdate)::DATE AS version FROM lineitem WHERE l_linenumber > 3 AND l_returnflag <> 'N' GROUP BY 1)
    SELECT o_orderkey AS id, CASE WHEN i.id IS NULL THEN 'absent' WHEN f.id IS NULL OR f.version <> i.version THEN 'changed' ELSE 'unchanged' END AS state
    FROM orders LEFT JOIN i ON i.id = o_orderkey LEFT JOIN f ON f.id = o_orderkey
""")
def inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked ids against the inventory and what was fetched last."""
    lines = table(spark, sf_dir, "lineitem")
    version = F.to_date(F.max("l_shipdate"))
    inventory = lines.filter("l_linenumber > 2").groupBy(F.col("l_orderkey").alias("id")).agg(version.alias("now"))
    fetched = lines.filter("l_linenumber > 3 and l_returnflag <> 'N'").groupBy(F.col("l_orderkey").alias("id")).agg(version.alias("was"))
    state = F.when(F.col("now").isNull(), "absent").when(F.col("was").eqNullSafe(F.col("now")), "unchanged").otherwise("changed")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).join(inventory, "id", "left").join(fetched, "id", "left").select("id", state.alias("state"))


@add("SELECT p_brand, p_name, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_size DESC, p_partkey) AS n FROM part) WHERE n = 1")
def largest_per_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest of each name, the first key of a tie."""
    best = F.max_by(F.struct("p_partkey", "p_size"), F.struct("p_size", F.negative("p_partkey")))
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(best.alias("b")).select("p_brand", "p_name", "b.p_partkey", "b.p_size")


@add("""
    SELECT l_orderkey, l_partkey, l_returnflag FROM (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem)
    WHERE l_returnflag = 'A' OR (l_returnflag = 'R' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'))
""")
def conditional_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a second sort count only where the record has none of the first."""
    rows = table(spark, sf_dir, "lineitem").filter("l_returnflag in ('A', 'R')").select("l_orderkey", "l_partkey", "l_returnflag").distinct()
    first = rows.filter("l_returnflag = 'A'")
    return first.union(rows.filter("l_returnflag = 'R'").join(first.select("l_orderkey"), "l_orderkey", "left_anti"))


@add("""
    SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
      AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)
""")
def unanswered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids that no reply accounts for, neither by themselves nor by one of their parts."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    answered = orders.filter("o_orderstatus = 'F'").select("id").union(table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select("l_orderkey"))
    return orders.select("id").join(answered, "id", "left_anti")


@add("""
    WITH u AS (SELECT 'SUP' || s_suppkey AS accession, 'public' AS status FROM supplier WHERE s_acctbal > 0 UNION SELECT 'SUP' || l_suppkey, 'public' FROM lineitem WHERE l_quantity > 49 UNION SELECT 'CUS' || o_custkey, 'listed' FROM orders WHERE o_totalprice > 490000)
    SELECT accession, status, row_number() OVER (PARTITION BY left(accession, 3) ORDER BY length(accession), accession) - 1 AS place FROM u
""")
def natural_order_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys of several sources with their place in natural order."""
    a = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(node("SUP", "s_suppkey").alias("accession"), F.lit("public").alias("status"))
    b = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(node("SUP", "l_suppkey"), F.lit("public"))
    c = table(spark, sf_dir, "orders").filter("o_totalprice > 490000").select(node("CUS", "o_custkey"), F.lit("listed"))
    return order.natural_rank(a.union(b).union(c).distinct(), "accession").select("accession", "status", "place")


@add("""
    SELECT user_id % 5 AS account, (count(*) FILTER (WHERE event_type = 'purchase'))::BIGINT AS spent, greatest(20 - count(*) FILTER (WHERE event_type = 'purchase'), 0)::BIGINT AS quota_left,
           bool_or(event_type = 'error' AND value > 45) AS stopped FROM events WHERE ts::DATE = DATE '2024-01-10' GROUP BY 1
""")
def day_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one day's attempts leave of each account's quota."""
    day = table(spark, sf_dir, "events").filter("ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'")
    spent = F.count_if(F.col("event_type") == "purchase").cast("long")
    stopped = F.bool_or((F.col("event_type") == "error") & (F.col("value") > 45))
    return day.groupBy((F.col("user_id") % 5).alias("account")).agg(spent.alias("spent"), F.greatest(F.lit(20) - spent, F.lit(0)).cast("long").alias("quota_left"), stopped.alias("stopped"))


@add("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-28') ")
def monthly_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that have not been looked up in the running period."""
    events = table(spark, sf_dir, "events")
    seen = events.filter("event_type = 'signup' and ts >= timestamp '2024-01-28'").select("user_id")
    return events.select("user_id").distinct().join(seen, "user_id", "left_anti")


@add("""
    WITH s AS (SELECT user_id, min(event_id) FILTER (WHERE event_type = 'purchase' AND value > 20) AS won FROM events GROUP BY 1)
    SELECT e.user_id, s.won, count(*) FILTER (WHERE s.won IS NULL OR e.event_id <= s.won)::BIGINT AS tried FROM events e JOIN s USING (user_id) GROUP BY ALL
""")
def first_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links tried in order until the first success, and how many that takes."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    won = events.groupBy("user_id").agg(F.min(F.when((F.col("event_type") == "purchase") & (F.col("value") > 20), F.col("event_id"))).alias("won"))
    both = events.join(won, "user_id")
    return both.groupBy("user_id", "won").agg(F.count_if(F.col("won").isNull() | (F.col("event_id") <= F.col("won"))).cast("long").alias("tried"))


@add("SELECT l_orderkey % 100 AS page, count(*)::BIGINT AS listed, count(DISTINCT l_orderkey * 10 + l_linenumber)::BIGINT AS ids, count(*) = count(DISTINCT l_orderkey * 10 + l_linenumber) AS stable FROM lineitem GROUP BY 1")
def stable_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing is stable if it counts as many rows as distinct ids."""
    ids = F.countDistinct(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    pages = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 100).alias("page")).agg(F.count("*").cast("long").alias("listed"), ids.alias("ids"))
    return pages.withColumn("stable", F.col("listed") == F.col("ids"))


@add("SELECT o_orderstatus, strftime(min(o_orderdate), '%Y-%m-%d') || ' to ' || strftime(max(o_orderdate), '%Y-%m-%d') AS span FROM orders GROUP BY 1")
def date_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last date of a group as text."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.concat(day(F.min("o_orderdate")), F.lit(" to "), day(F.max("o_orderdate"))).alias("span"))


@add("""
    SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS sources, min(CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 ELSE 9 END) AS nearest
    FROM events WHERE value > 30 GROUP BY 1
""")
def sources_and_nearest_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that state a key, and the nearest tier in a fixed order."""
    kind = F.col("event_type")
    tier = F.when(kind == "purchase", 1).when(kind == "signup", 2).when(kind == "view", 3).otherwise(9)
    return table(spark, sf_dir, "events").filter("value > 30").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("sources"), F.min(tier).alias("nearest"))


@add("SELECT l_partkey, min(l_suppkey) AS supplier FROM lineitem WHERE l_partkey < 200 AND l_quantity > 45 GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small numbers that only one source states."""
    rows = table(spark, sf_dir, "lineitem").filter("l_partkey < 200 and l_quantity > 45")
    return rows.groupBy("l_partkey").agg(F.min("l_suppkey").alias("supplier"), F.countDistinct("l_returnflag").alias("n")).filter("n = 1").select("l_partkey", "supplier")


@add("""
    SELECT (count(*) FILTER (WHERE starts_with(p_name, 'small')))::BIGINT AS prefix, (count(*) FILTER (WHERE p_type LIKE 'ECO%'))::BIGINT AS pattern, (count(*) FILTER (WHERE contains(lower(p_brand), 'brand#2')))::BIGINT AS inside,
           (count(*) FILTER (WHERE regexp_matches(p_name, 'r.n')))::BIGINT AS search, (count(*) FILTER (WHERE regexp_full_match(p_brand, 'Brand#[0-9]')))::BIGINT AS whole, (count(*) FILTER (WHERE p_name >= 'm' AND p_name < 'r'))::BIGINT AS between_keys,
           (count(*) FILTER (WHERE nullif(p_size, 1) IS DISTINCT FROM p_size))::BIGINT AS nulled FROM part
""")
def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix, pattern, substring, search, full match, key range and null-safe predicates in one scan."""
    n = F.col("p_name")
    tests = {
        "prefix": n.startswith("small"),
        "pattern": F.col("p_type").like("ECO%"),
        "inside": F.lower("p_brand").contains("brand#2"),
        "search": n.rlike("r.n"),
        "whole": F.col("p_brand").rlike("^Brand#[0-9]$"),
        "between_keys": (n >= "m") & (n < "r"),
        "nulled": ~F.nullif(F.col("p_size"), F.lit(1)).eqNullSafe(F.col("p_size")),
    }
    return table(spark, sf_dir, "part").agg(*(F.count_if(t).cast("long").alias(k) for k, t in tests.items()))


@add("SELECT left(key, 3) AS prefix, max(regexp_extract(key, '([0-9]+)$', 1)::BIGINT) AS most, count(*)::BIGINT AS n, sum(length(key))::BIGINT AS chars FROM (SELECT 'ORD' || o_orderkey AS key FROM orders UNION ALL SELECT 'PRT' || p_partkey FROM part) GROUP BY 1")
def key_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing numbers of keys by prefix."""
    keys = table(spark, sf_dir, "orders").select(node("ORD", "o_orderkey").alias("key")).union(table(spark, sf_dir, "part").select(node("PRT", "p_partkey")))
    return keys.groupBy(prefix_of(F.col("key")).alias("prefix")).agg(F.max(number_of(F.col("key"))).alias("most"), F.count("*").cast("long").alias("n"), F.sum(F.length("key")).cast("long").alias("chars"))
