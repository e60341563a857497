"""Incremental work: change lists, snapshot patches, diffs with a guard, soft deletes, coverage, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class TooManyLost(ValueError):
    """A patch or diff would drop more than its guard allows."""


def change_list(parts: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """(key, reason): keys of all parts, each under the first reason that names it."""
    out = None
    for rank, (reason, df) in enumerate(parts):
        rows = df.select(key, F.lit(rank).alias("_rank"), F.lit(reason).alias("reason"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy(key).agg(F.min_by("reason", "_rank").alias("reason"))


def updated_since(df: DataFrame, when: str, last: Column, days: int = 3) -> DataFrame:
    """Rows changed since `days` before the last success, so that late updates are found."""
    return df.filter(F.col(when) >= last - F.expr(f"INTERVAL {days} DAYS"))


def patched(previous: DataFrame, fresh: DataFrame, listed: DataFrame, key: str, *, share: float = 0.01, least: int = 1000, check: bool = True) -> DataFrame:
    """Previous rows with fresh ones in their place, without the keys that are no longer listed.

    Listed keys without a fresh row keep their previous one. Raises TooManyLost if more than
    max(least, share of previous) keys would drop; only the two counts reach the driver.
    """
    kept = previous.join(fresh.select(key), key, "left_anti")
    out = kept.unionByName(fresh).join(listed.select(key).distinct(), key, "left_semi").select(*previous.columns)
    if check:
        before, lost = previous.count(), previous.join(listed.select(key), key, "left_anti").count()
        if lost > max(least, share * before):
            raise TooManyLost(f"{lost} of {before} keys are no longer listed")
    return out


def copy_diff(local: DataFrame, remote: DataFrame, key: str, signature: list[str]) -> DataFrame:
    """(key, action): what to send (new or changed) and to delete (not here any more)."""
    a = local.select(key, F.struct(*signature).alias("_a"))
    b = remote.select(key, F.struct(*signature).alias("_b"))
    both = a.join(b, key, "full")
    action = F.when(F.col("_a").isNull(), "delete").when(F.col("_b").isNull() | (F.col("_a") != F.col("_b")), "send")
    return both.select(key, action.alias("action")).filter("action is not null")


def delete_limit(n: int, accepted: int = 0, share: float = 0.05) -> int:
    """Deletes that a diff may hold: one, the share, or what was accepted by hand, whichever is most."""
    return max(1, int(share * n), accepted)


def guarded(diff: DataFrame, n_remote: int, accepted: int = 0) -> DataFrame:
    """The diff, or TooManyLost if it deletes more than the limit."""
    deletes = diff.filter("action = 'delete'").count()
    if deletes > delete_limit(n_remote, accepted):
        raise TooManyLost(f"{deletes} deletes of {n_remote}")
    return diff


def soft_deleted(held: DataFrame, listed: DataFrame, key: str, today: Column, gone: str = "gone") -> DataFrame:
    """Held rows with `gone` set to today where the source lists the key no more, and cleared where it does again."""
    seen = listed.select(key).distinct().withColumn("_seen", F.lit(True))
    return held.join(seen, key, "left").withColumn(gone, F.when(F.col("_seen").isNull(), F.coalesce(F.col(gone), today))).select(*held.columns)


def coverage(target: DataFrame, held: DataFrame, reasons: DataFrame, key: str, unknown: str = "unexplained") -> DataFrame:
    """(key, reason) of target keys that are not held; reasons has key and reason."""
    missing = target.select(key).distinct().join(held.select(key), key, "left_anti")
    first = reasons.groupBy(key).agg(F.min("reason").alias("reason"))
    return missing.join(first, key, "left").select(key, F.coalesce("reason", F.lit(unknown)).alias("reason"))


def absent_class(wanted: DataFrame, held: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, state): held, not mirrored (a snapshot lists it) or not found."""
    h = held.select(key).distinct().withColumn("_h", F.lit(True))
    k = known.select(key).distinct().withColumn("_k", F.lit(True))
    state = F.when(F.col("_h"), "held").when(F.col("_k"), "not mirrored").otherwise("not found")
    return wanted.select(key).join(h, key, "left").join(k, key, "left").select(key, state.alias("state"))


def removal_candidates(runs: DataFrame, parent: str, public: Column, reached: DataFrame) -> DataFrame:
    """(parent, non_public, unreached, runs): parents that nothing reaches or that hold a non-public run."""
    found = runs.groupBy(parent).agg(F.bool_or(~public).alias("non_public"), F.array_sort(F.collect_set(F.when(~public, F.col("run")))).alias("runs"))
    marked = found.join(reached.select(parent).distinct().withColumn("_r", F.lit(True)), parent, "left").withColumn("unreached", F.col("_r").isNull())
    return marked.filter("non_public or unreached").select(parent, "non_public", "unreached", "runs")


def with_marked_runs(packages: DataFrame, marked: DataFrame) -> DataFrame:
    """(accession, runs, raw_text) of packages that hold a marked run (column run): its runs in order, and the text.

    Run keys are taken from the texts and joined without them; the texts of those packages that are left are
    fetched last, so no text of another package is shuffled.
    """
    from tessera.functions.text import attribute

    tags = F.regexp_extract_all("raw_text", F.lit(r"(<RUN\s[^>]*>)"), F.lit(1))
    keys = packages.select("accession", F.explode(F.array_distinct(F.transform(tags, lambda t: attribute(t, "accession")))).alias("run")).filter("run is not null")
    found = keys.join(marked.select("run").distinct(), "run", "left_semi").groupBy("accession").agg(F.array_sort(F.collect_set("run")).alias("runs"))
    return packages.select("accession", "raw_text").join(found, "accession").select("accession", "runs", "raw_text")


def to_retire(builds: DataFrame, readers: DataFrame, now: Column, grace_hours: int = 24, keep: int = 1) -> DataFrame:
    """Builds (build, made) to delete: not among the newest `keep`, past the grace time, and not read within it."""
    last = readers.groupBy("build").agg(F.max("at").alias("last_read"))
    newest = builds.orderBy(F.col("made").desc(), F.col("build").desc()).limit(keep).select("build")
    limit = now - F.expr(f"INTERVAL {grace_hours} HOURS")
    old = builds.join(newest, "build", "left_anti").join(last, "build", "left")
    return old.filter((F.col("made") < limit) & (F.col("last_read").isNull() | (F.col("last_read") < limit))).select("build", "made", "last_read")


def dealt_quota(ranked: DataFrame, accounts: list[tuple[str, int]], rank: str) -> DataFrame:
    """ranked rows (rank 1, 2, ...) with the account that pays: round-robin over accounts with quota left; rows beyond all quotas drop out.

    Round r gives one row to every account whose quota is at least r, in account order, so the
    row of a rank follows from running sums over the few accounts and needs no loop over rows.
    """
    levels = sorted({q for _, q in accounts if q > 0})
    rows, start, below = [], 0, 0
    for level in levels:
        open_now = sorted(a for a, q in accounts if q >= level)
        rows.append((start, start + len(open_now) * (level - below), open_now))
        start, below = rows[-1][1], level
    col = F.lit(None).cast("string")
    at = F.col(rank) - 1
    for lo, hi, open_now in reversed(rows):
        col = F.when((at >= lo) & (at < hi), F.get(F.array(*map(F.lit, open_now)), F.pmod(at - lo, F.lit(len(open_now))).cast("int"))).otherwise(col)
    return ranked.withColumn("account", col).filter("account is not null")
