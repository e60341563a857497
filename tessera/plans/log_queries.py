"""Queries on the keyed log, change detection and rule-based status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators import log, papers, refresh, verify

from .base import Catalogue, table

CATALOGUE = Catalogue()
add = CATALOGUE.add


@add("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def log_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row of each key by write order."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return log.newest(rows, ["user_id"], ["event_id"])


@add("SELECT user_id, event_id, value FROM (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS t, arg_max(value, event_id) AS value FROM events GROUP BY user_id) WHERE t <> 'error'")
def log_tombstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row of each key, without the keys whose newest row deletes them."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value", "event_type")
    return log.newest(rows, ["user_id"], ["event_id"], removed=F.col("event_type") == "error").drop("event_type")


def _halved(events: DataFrame) -> DataFrame:
    """events with `late`, true for the second half of the write order; the last id is one row beside the scan, so the plan stays lazy."""
    last = events.agg((F.max("event_id") / 2).alias("half"))
    return events.crossJoin(F.broadcast(last)).withColumn("late", F.col("event_id") >= F.col("half"))


@add("""
    WITH h AS (SELECT user_id, event_type AS kind, value, event_id, event_id >= (SELECT max(event_id) / 2 FROM events) AS late FROM events),
    b AS (SELECT user_id, kind, arg_max(value, event_id) AS value FROM h WHERE NOT late GROUP BY ALL),
    d AS (SELECT user_id, kind, arg_max(value, event_id) AS value FROM h WHERE late GROUP BY ALL)
    SELECT user_id, kind, CASE WHEN d.user_id IS NOT NULL THEN d.value ELSE b.value END AS value
    FROM b FULL JOIN d USING (user_id, kind) WHERE NOT (d.user_id IS NOT NULL AND d.value < 5)
""")
def log_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base overlaid by a delta with deletes: reading the layers gives what packing them gives."""
    events = table(spark, sf_dir, "events")
    rows = _halved(events).select("user_id", F.col("event_type").alias("kind"), "value", "event_id", "late")
    base, delta = (log.newest(rows.filter(c), ["user_id", "kind"], ["event_id"]).drop("late") for c in ("not late", "late"))
    delta = delta.withColumn("gone", F.col("value") < 5)
    return log.merged(base.withColumn("gone", F.lit(False)), delta, key=["user_id", "kind"], removed="gone").select("user_id", "kind", "value")


@add("""
    WITH x AS (SELECT user_id, max(event_id) FILTER (WHERE event_type = 'view') AS a, max(event_id) FILTER (WHERE event_type = 'error') AS r FROM events GROUP BY 1)
    SELECT user_id, a IS NOT NULL AND (r IS NULL OR a > r) AS asked FROM x
""")
def log_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys asked for since their last removal."""
    op = F.when(F.col("event_type") == "view", log.ASKED).when(F.col("event_type") == "error", log.REMOVE).otherwise(log.PUT)
    return log.asked_since_removal(table(spark, sf_dir, "events").select("user_id", op.alias("op"), "event_id"), "user_id", "op", "event_id")


@add("""
    WITH h AS (SELECT *, event_id >= (SELECT max(event_id) / 2 FROM events) AS late FROM events WHERE event_type <> 'view'),
    o AS (SELECT user_id, arg_max(event_type, event_id) AS v FROM h WHERE NOT late AND value > 20 GROUP BY 1),
    n AS (SELECT user_id, arg_max(event_type, event_id) AS v FROM h WHERE late AND value > 10 GROUP BY 1)
    SELECT user_id % 10 AS bucket, (count(*) FILTER (WHERE o.user_id IS NULL))::BIGINT AS added,
           (count(*) FILTER (WHERE o.user_id IS NOT NULL AND n.user_id IS NOT NULL AND o.v IS DISTINCT FROM n.v))::BIGINT AS replaced,
           (count(*) FILTER (WHERE n.user_id IS NULL))::BIGINT AS removed
    FROM o FULL JOIN n USING (user_id) GROUP BY 1
""")
def pack_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys added, replaced and removed by a compaction, by bucket."""
    events = table(spark, sf_dir, "events")
    rows = _halved(events).filter("event_type <> 'view'").select("user_id", "event_id", "event_type", "value", "late")
    old = log.newest(rows.filter(~F.col("late") & (F.col("value") > 20)), ["user_id"], ["event_id"])
    new = log.newest(rows.filter(F.col("late") & (F.col("value") > 10)), ["user_id"], ["event_id"])
    return log.change_tally(old, new, "user_id", "event_type", F.col("user_id") % 10)


@add("""
    SELECT user_id, event_type, day, event_id, value FROM (
        SELECT user_id, event_type, ts::DATE AS day, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts::DATE DESC, event_id DESC) AS n FROM events) WHERE n = 1
""")
def latest_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest attempt by day, the later row of a tie."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "value")
    return papers.latest(rows, ["user_id", "event_type"], ["day", "event_id"])


_FACTS_SQL = """
    WITH f AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS bought, count(*) FILTER (WHERE event_type = 'error') AS errors,
                      max(ts::DATE) FILTER (WHERE event_type = 'signup') AS signed FROM events GROUP BY 1),
    s AS (SELECT user_id,
        CASE WHEN bought >= 16 THEN 'held' WHEN errors >= 16 THEN 'failed' WHEN signed >= DATE '2024-01-29' THEN 'waiting' WHEN signed IS NULL THEN 'unknown' ELSE 'open' END AS status,
        CASE WHEN bought >= 16 THEN 'purchases' WHEN errors >= 16 THEN 'errors' WHEN signed >= DATE '2024-01-29' THEN 'fresh' WHEN signed IS NULL THEN 'no signup' ELSE 'none' END AS reason FROM f)
"""


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    facts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(kind == "purchase").alias("bought"), F.count_if(kind == "error").alias("errors"), F.max(F.when(kind == "signup", F.to_date("ts"))).alias("signed"))
    rules = [
        (F.col("bought") >= 16, "held", "purchases"),
        (F.col("errors") >= 16, "failed", "errors"),
        (F.col("signed") >= F.lit("2024-01-29").cast("date"), "waiting", "fresh"),
        (F.col("signed").isNull(), "unknown", "no signup"),
    ]
    return facts.select("user_id", *papers.ladder(rules, ("open", "none")))


@add(_FACTS_SQL + "SELECT user_id, status, reason FROM s")
def status_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and reason of the first rule that holds."""
    return _statuses(spark, sf_dir)


@add(_FACTS_SQL + """
    , v AS (SELECT * FROM (VALUES ('held', 'purchases'), ('failed', 'errors'), ('waiting', 'fresh'), ('unknown', 'no signup'), ('open', 'none'), ('open', 'never')) AS v(status, reason))
    SELECT v.status, v.reason, count(s.user_id)::BIGINT AS n FROM v LEFT JOIN s ON s.status = v.status AND s.reason = v.reason GROUP BY 1, 2
""")
def counts_by_status_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by status and reason, also those that do not occur."""
    every = spark.createDataFrame([("held", "purchases"), ("failed", "errors"), ("waiting", "fresh"), ("unknown", "no signup"), ("open", "none"), ("open", "never")], "status string, reason string")
    return papers.counted(_statuses(spark, sf_dir), ["status", "reason"], every)


_GAPS_SQL = """
    WITH h AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
    g AS (SELECT o_orderkey AS key, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'P' THEN 'pending' ELSE 'unexplained' END AS reason FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM h))
"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    held = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("key"))
    reasons = orders.filter("o_orderstatus in ('F', 'P')").select("key", F.when(F.col("o_orderstatus") == "F", "finished").otherwise("pending").alias("reason"))
    return refresh.coverage(orders, held, reasons, "key")


@add(_GAPS_SQL + "SELECT reason, count(*)::BIGINT AS n, min(key) AS example FROM g GROUP BY 1")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target keys that are not held, by recorded reason."""
    return _gaps(spark, sf_dir).groupBy("reason").agg(F.count("*").cast("long").alias("n"), F.min("key").alias("example"))


@add(_GAPS_SQL + "SELECT key, reason FROM g WHERE reason = 'unexplained' ORDER BY 1, 2 LIMIT 50")
def top_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty unexplained gaps."""
    return _gaps(spark, sf_dir).filter("reason = 'unexplained'").orderBy("key", "reason").limit(50)


@add("""
    WITH m AS (SELECT max(ts) AS last FROM events),
    u AS (SELECT DISTINCT user_id FROM events, m WHERE ts >= last - INTERVAL 3 DAY AND event_type = 'signup'),
    f AS (SELECT user_id FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_type = 'error') > 12),
    n AS (SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 40))
    SELECT user_id, CASE WHEN user_id IN (SELECT * FROM u) THEN 'updated' WHEN user_id IN (SELECT * FROM n) THEN 'unheld' ELSE 'failed' END AS reason
    FROM (SELECT * FROM u UNION SELECT * FROM n UNION SELECT * FROM f)
""")
def change_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updated, unheld and failed keys, each under its first reason; updates look back three days."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("ts").alias("last"))
    updated = refresh.updated_since(events.filter("event_type = 'signup'").crossJoin(F.broadcast(last)), "ts", F.col("last"))
    unheld = events.join(events.filter("event_type = 'purchase' and value > 40").select("user_id"), "user_id", "left_anti")
    failed = events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("n")).filter("n > 12")
    return refresh.change_list([("updated", updated), ("unheld", unheld), ("failed", failed)], "user_id")


@add("""
    WITH p AS (SELECT user_id, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1),
    n AS (SELECT user_id, min(value) AS value FROM events WHERE event_type = 'click' AND value > 25 GROUP BY 1),
    l AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')
    SELECT user_id, CASE WHEN n.user_id IS NOT NULL THEN n.value ELSE p.value END AS value FROM p FULL JOIN n USING (user_id) WHERE user_id IN (SELECT user_id FROM l)
""")
def snapshot_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh rows in place of previous ones, keys that are no longer listed dropped."""
    events = table(spark, sf_dir, "events")
    previous = events.filter("event_type = 'view'").groupBy("user_id").agg(F.max("value").alias("value"))
    fresh = events.filter("event_type = 'click' and value > 25").groupBy("user_id").agg(F.min("value").alias("value"))
    listed = events.filter("event_type = 'purchase'")
    lost = previous.join(listed, "user_id", "left_anti").count()
    if lost:  # one less than what is lost is too few
        try:
            refresh.patched(previous, fresh, listed, "user_id", least=lost - 1, share=0)
            raise AssertionError("the guard let too many go")
        except refresh.TooManyLost:
            pass
    return refresh.patched(previous, fresh, listed, "user_id", least=lost, share=0)


@add("""
    WITH a AS (SELECT p_partkey AS key, p_size, p_brand FROM part WHERE p_size > 2),
    b AS (SELECT p_partkey AS key, CASE WHEN p_type LIKE 'ECO%' THEN p_size + 1 ELSE p_size END AS p_size, p_brand FROM part WHERE p_size < 48)
    SELECT key, CASE WHEN a.key IS NULL THEN 'delete' ELSE 'send' END AS action FROM a FULL JOIN b USING (key)
    WHERE a.key IS NULL OR b.key IS NULL OR a.p_size <> b.p_size OR a.p_brand <> b.p_brand
""")
def copy_diff_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to send and to delete, refused if the deletes pass their limit."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_size", "p_brand", "p_type")
    local = part.filter("p_size > 2")
    remote = part.filter("p_size < 48").withColumn("p_size", F.when(F.col("p_type").startswith("ECO"), F.col("p_size") + 1).otherwise(F.col("p_size")))
    diff = refresh.copy_diff(local, remote, "key", ["p_size", "p_brand"])
    deletes = diff.filter("action = 'delete'").count()
    if deletes > 1:  # of a copy no larger than what goes, and accepted for one less
        try:
            refresh.guarded(diff, deletes, accepted=deletes - 1)
            raise AssertionError("the guard let too many go")
        except refresh.TooManyLost:
            pass
    return refresh.guarded(diff, remote.count(), accepted=deletes)


@add("""
    WITH h AS (SELECT user_id, max(ts::DATE) AS seen FROM events WHERE event_type = 'view' GROUP BY 1),
    l AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-28' AND event_type = 'view')
    SELECT user_id, seen, CASE WHEN user_id IN (SELECT user_id FROM l) THEN NULL ELSE DATE '2024-01-31' END AS gone FROM h
""")
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stay; what the source lists no more gets a date."""
    views = table(spark, sf_dir, "events").filter("event_type = 'view'")
    held = views.groupBy("user_id").agg(F.max(F.to_date("ts")).alias("seen")).withColumn("gone", F.lit(None).cast("date"))
    return refresh.soft_deleted(held, views.filter("ts >= timestamp '2024-01-28'"), "user_id", F.lit("2024-01-31").cast("date"))


@add("""
    WITH b AS (SELECT 'B' || o_custkey AS build, max(o_orderdate) AS made FROM orders GROUP BY 1),
    r AS (SELECT 'B' || o_custkey AS build, max(o_orderdate) AS last_read FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    k AS (SELECT build FROM b ORDER BY made DESC, build DESC LIMIT 3)
    SELECT build, made, last_read FROM b LEFT JOIN r USING (build)
    WHERE build NOT IN (SELECT build FROM k) AND made < TIMESTAMP '2001-06-02' - INTERVAL 24 HOUR AND (last_read IS NULL OR last_read < TIMESTAMP '2001-06-02' - INTERVAL 24 HOUR)
""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that may go: not among the newest, past the grace time, unread within it."""
    orders = table(spark, sf_dir, "orders").withColumn("build", F.concat(F.lit("B"), F.col("o_custkey").cast("string")))
    builds = orders.groupBy("build").agg(F.max("o_orderdate").alias("made"))
    readers = orders.filter("o_orderstatus = 'F'").select("build", F.col("o_orderdate").alias("at"))
    return refresh.to_retire(builds, readers, F.lit("2001-06-02 00:00:00").cast("timestamp_ntz" if dict(builds.dtypes)["made"] == "timestamp_ntz" else "timestamp"), keep=3)


@add("""
    WITH a AS (SELECT p_partkey AS key, p_size, p_brand, p_type FROM part WHERE p_size > 1),
    b AS (SELECT p_partkey AS key, CASE WHEN p_type LIKE 'ECO%' THEN p_size + 1 ELSE p_size END AS p_size, CASE WHEN p_size = 30 THEN NULL ELSE p_brand END AS p_brand, p_type FROM part WHERE p_size < 50),
    j AS (SELECT key, a.key IS NULL OR b.key IS NULL AS w, a.p_size IS DISTINCT FROM b.p_size AS s, a.p_brand IS DISTINCT FROM b.p_brand AS r FROM a FULL JOIN b USING (key)),
    c AS (SELECT key, '(row)' AS "column" FROM j WHERE w UNION ALL SELECT key, 'p_size' FROM j WHERE NOT w AND s UNION ALL SELECT key, 'p_brand' FROM j WHERE NOT w AND r)
    SELECT "column", count(*)::BIGINT AS cells, min(key) AS first FROM c GROUP BY 1
""".replace("a.key IS NULL OR b.key IS NULL", "a.p_type IS NULL OR b.p_type IS NULL"))
def build_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions cell by cell, with the first difference of each column."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), "p_size", "p_brand", "p_type")
    changed = part.filter("p_size < 50").withColumn("p_brand", F.when(F.col("p_size") != 30, F.col("p_brand"))).withColumn("p_size", F.when(F.col("p_type").startswith("ECO"), F.col("p_size") + 1).otherwise(F.col("p_size")))
    return verify.differing_cells(part.filter("p_size > 1"), changed, ["key"]).withColumn("first", F.col("first.key"))


@add("""
    SELECT lang, count(*)::BIGINT AS rows, (count(*) FILTER (WHERE doc_id % 50 = 3))::BIGINT AS wrong FROM documents GROUP BY lang
""")
def integrity_hash_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text hashed again and held against its stored hash (one in fifty is stored wrong here)."""
    docs = table(spark, sf_dir, "documents").withColumn("stored", F.when(F.col("doc_id") % 50 == 3, F.lit("0")).otherwise(F.sha2("text", 256)))
    return docs.groupBy("lang").agg(F.count("*").cast("long").alias("rows"), F.count_if(~F.sha2("text", 256).eqNullSafe(F.col("stored"))).cast("long").alias("wrong"))


@add("""
    WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer),
    q AS (SELECT *, rank - 1 AS k FROM r)
    SELECT c_custkey, rank::BIGINT AS rank, CASE
        WHEN k < 30 THEN ['a', 'b', 'c'][(k % 3 + 1)::INT] WHEN k < 30 + 30 THEN ['b', 'c'][((k - 30) % 2 + 1)::INT] WHEN k < 60 + 15 THEN 'c' END AS account
    FROM q WHERE k < 75
""")
def quota_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked rows dealt round-robin to accounts with quota left."""
    # the rows that quotas can pay for are few: a top-k, then their ranks
    top = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(75)
    from pyspark.sql import Window

    ranked = top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("c_acctbal").desc(), "c_custkey")).cast("long"))
    return refresh.dealt_quota(ranked, [("a", 10), ("b", 25), ("c", 40)], "rank").select("c_custkey", "rank", "account")


@add("""
    WITH r AS (SELECT l_orderkey AS parent, l_linenumber AS run, l_returnflag <> 'R' AS pub FROM lineitem),
    c AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus <> 'O'),
    g AS (SELECT parent, bool_or(NOT pub) AS non_public, parent NOT IN (SELECT o_orderkey FROM c) AS unreached, coalesce(string_agg(DISTINCT run::VARCHAR, ',' ORDER BY run::VARCHAR) FILTER (WHERE NOT pub), '') AS runs FROM r GROUP BY parent)
    SELECT * FROM g WHERE non_public OR unreached
""")
def removal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents that hold a non-public run or that nothing reaches."""
    runs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").cast("string").alias("run"), (F.col("l_returnflag") != "R").alias("pub"))
    reached = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("parent"))
    return refresh.removal_candidates(runs, "parent", F.col("pub"), reached).withColumn("runs", F.array_join("runs", ","))
