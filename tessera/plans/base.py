"""Input tables as nodes and links, and the collection that queries register in."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name, each with the SQL of the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def wrap(query: Query) -> Query:
            if query.__name__ in self.queries:
                raise ValueError(f"two queries are named {query.__name__}")
            self.queries[query.__name__] = query
            if sql is not None:
                self.sql[query.__name__] = sql
            return query

        return wrap


def together(*parts: Catalogue) -> tuple[dict[str, Query], dict[str, str]]:
    """The queries and the SQL of all parts; a name that two of them use raises."""
    queries: dict[str, Query] = {}
    for part in parts:
        if twice := queries.keys() & part.queries.keys():
            raise ValueError(f"two queries are named {sorted(twice)}")
        queries |= part.queries
    return queries, {name: sql for part in parts for name, sql in part.sql.items()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def node(prefix: str, column: str):
    """Node id of a key column."""
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


#: (table, from prefix, from column, to prefix, to column, relation)
LINKS = (
    ("orders", "ORD", "o_orderkey", "CUS", "o_custkey", "customer"),
    ("customer", "CUS", "c_custkey", "NAT", "c_nationkey", "nation"),
    ("supplier", "SUP", "s_suppkey", "NAT", "s_nationkey", "nation"),
    ("nation", "NAT", "n_nationkey", "REG", "n_regionkey", "region"),
    ("lineitem", "ORD", "l_orderkey", "PRT", "l_partkey", "part"),
    ("lineitem", "ORD", "l_orderkey", "SUP", "l_suppkey", "supplier"),
)
#: (table, prefix, column, kind)
NODES = (
    ("orders", "ORD", "o_orderkey", "order"),
    ("customer", "CUS", "c_custkey", "customer"),
    ("supplier", "SUP", "s_suppkey", "supplier"),
    ("part", "PRT", "p_partkey", "part"),
    ("nation", "NAT", "n_nationkey", "nation"),
    ("region", "REG", "r_regionkey", "region"),
)


def links(spark: SparkSession, sf_dir: str, relations: tuple[str, ...] | None = None) -> DataFrame:
    """Links (from, to, relation, and the kinds of both ends as constants), as often as the tables state them; a filter on relation or kind leaves the other tables unread."""
    parts = [
        table(spark, sf_dir, t).select(node(fp, fc).alias("from"), node(tp, tc).alias("to"), F.lit(r).alias("relation"), F.lit(fp).alias("from_kind"), F.lit(tp).alias("to_kind"))
        for t, fp, fc, tp, tc, r in LINKS
        if relations is None or r in relations
    ]
    return reduce(DataFrame.union, parts)


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes (accession, type)."""
    return reduce(DataFrame.union, [table(spark, sf_dir, t).select(node(p, c).alias("accession"), F.lit(k).alias("type")) for t, p, c, k in NODES])


LINKS_SQL = " UNION ".join(f"SELECT '{fp}' || {fc} AS f, '{tp}' || {tc} AS t, '{r}' AS r FROM {tb}" for tb, fp, fc, tp, tc, r in LINKS)
HOLDINGS_SQL = " UNION ALL ".join(f"SELECT '{p}' || {c} AS accession, '{k}' AS type FROM {t}" for t, p, c, k in NODES)
