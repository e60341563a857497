"""Work in rounds that may be killed and replayed: confirmation of removals, and breadth with a retry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.sources.scratch import cut

# What a source says of a key that was asked for.
GONE, SERVED, FAILED = "gone", "served", "failed"


class Confirmations:
    """Answers to what was asked, by round, under a path; the state of a key follows from its answers.

    A round's folder is written whole or, if the round is done again, in place of the one before, so a replay
    counts once. The first answer that settles a key (gone or served) stays whatever later rounds say; a
    key with failures only is asked again.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, number: int, answers: DataFrame) -> None:
        """Write the answers (accession, state) of a round."""
        known = F.col("state").isin(GONE, SERVED, FAILED)
        said = F.raise_error(F.concat(F.lit("no state: "), F.coalesce("state", F.lit("null"))))
        rows = answers.select("accession", F.when(known, F.col("state")).otherwise(said).alias("state"))
        rows.write.mode("overwrite").parquet(f"{self.path}/round={number}")

    def answers(self) -> DataFrame:
        try:
            return self.spark.read.schema("accession string, state string, round int").parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], "accession string, state string, round int")

    def states(self, candidates: DataFrame) -> DataFrame:
        """(accession, state, asked, settled): where each candidate stands, in how many rounds it was asked, and the round that settled it; never asked ones are open.

        Answers of one round that disagree count as served if one of them is: nothing is removed that a source still serves.
        """
        settles = F.when(F.col("state").isin(GONE, SERVED), F.struct("round", (F.col("state") == GONE).alias("gone")))
        each = self.answers().groupBy("accession").agg(F.min(settles).alias("first"), F.count_distinct("round").alias("asked"))
        state = F.when(F.col("asked").isNull(), "open").when(F.col("first").isNull(), FAILED).when(F.col("first.gone"), GONE).otherwise(SERVED)
        return candidates.select("accession").distinct().join(each, "accession", "left").select("accession", state.alias("state"), F.coalesce("asked", F.lit(0).cast("long")).alias("asked"), F.col("first.round").alias("settled"))

    def pending(self, candidates: DataFrame) -> DataFrame:
        """(accession): candidates to ask in the next round."""
        return self.states(candidates).filter(F.col("state").isin("open", FAILED)).select("accession")

    def removals(self, candidates: DataFrame) -> DataFrame:
        """(accession): candidates that are confirmed gone."""
        return self.states(candidates).filter(F.col("state") == GONE).select("accession")


Fetch = Callable[[DataFrame, int], DataFrame]

#: Keys of a round up to this many go to all tasks; more are joined by a shuffle.
FEW_KEYS = 100_000


def short(keys: DataFrame) -> DataFrame:
    """keys, marked to go to all tasks if they are few. They are counted for that."""
    return F.broadcast(keys) if keys.limit(FEW_KEYS + 1).count() <= FEW_KEYS else keys


def _states(seen: DataFrame, got: DataFrame) -> DataFrame:
    """(key, round, held) of seen (key, round), held where got has the key.

    Rows of both are summed up by key: a join would be pushed below the union of the rounds and go over all of got once for each of them.
    """
    rows = seen.select("key", "round", F.lit(False).alias("held")).union(got.select("key", F.lit(None).cast("int"), F.lit(True)))
    return rows.groupBy("key").agg(F.max("round").alias("round"), F.max("held").alias("held")).filter("round is not null")


def breadth_with_retry(roots: DataFrame, fetch: Fetch, named: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, round, held): what is reached from the roots over what fetched texts name, with one retry of what failed.

    fetch(keys, attempt) gives (key, raw_text), null or no row for a failure; named(texts) gives (next). Rounds run until they name
    nothing new; then all keys without a text are asked once more, and what those texts name is followed
    in turn, without another retry. Only a round's new rows are written; earlier rounds stay as they are, and
    of those a short round reads the keys, but shuffles none.
    """
    seen = cut(roots.select("key").distinct().withColumn("round", F.lit(0)))
    frontier, got, depth, retried, attempt = seen.select("key"), None, 0, False, 0
    while True:
        answers = cut(fetch(frontier, attempt).select("key", "raw_text"))
        texts = answers.filter("raw_text is not null")
        got = texts.select("key") if got is None else got.union(texts.select("key"))
        depth, attempt = depth + 1, 0
        stated = cut(named(texts).select(F.col("next").alias("key")).distinct())
        few = stated.limit(FEW_KEYS + 1).count() <= FEW_KEYS
        known = seen.select("key").join(F.broadcast(stated), "key", "left_semi") if few else seen.select("key")
        new = cut(stated.join(known, "key", "left_anti").withColumn("round", F.lit(depth)))
        if not new.isEmpty():
            seen, frontier = seen.union(new), new.select("key")
            continue
        if retried:
            return _states(seen, got)
        failed = cut(_states(seen, got).filter("not held").select("key"))
        if failed.isEmpty():
            return _states(seen, got)
        retried, attempt, frontier = True, 1, failed
