"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are dealt into shards of bounded size by a hash; every shard is packed on its own,
longest piece first, of equal ones the earlier row. A piece goes to the open bin that it fills best;
if none takes it, every permitted size is filled on trial with the pieces that are still to come,
and the size is opened whose contents then cost least per token; at the end each bin shrinks to the
smallest permitted length that its contents need.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

CAPACITIES = (256, 512, 1024, 2048, 4096)
#: Cost of a sequence beyond its tokens: a fixed part, and attention that grows with the square of the length.
FIXED_COST, SQUARE_COST = 32.0, 1 / 16384
#: Pieces in a shard, about; what one task packs.
SHARD_PIECES = 20_000


def cost(capacity: int) -> float:
    """Cost of a bin: tokens, fixed part and attention."""
    return capacity + FIXED_COST + SQUARE_COST * capacity * capacity


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def best_fit(lengths: Sequence[int], capacities: Sequence[int]) -> list[tuple[int, int, int]]:
    """(bin, offset, capacity) of each piece; lengths are 1..max(capacities). Of sizes that cost the same the smaller one is opened."""
    sizes = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda k: (-lengths[k], k))
    falling = [-lengths[k] for k in order]
    free: list[tuple[int, int]] = []  # (room, bin), open bins by room
    used: list[int] = []
    at: list[tuple[int, int]] = [(0, 0)] * len(lengths)

    def trial(room: int, after: int) -> int:
        """Tokens that pieces still to come put into so much room, the longest that fits each time."""
        rest, i = room, after
        while rest and (i := bisect_left(falling, -rest, i)) < len(falling):
            rest += falling[i]
            i += 1
        return room - rest

    for place, k in enumerate(order):
        need = lengths[k]
        i = bisect_left(free, (need, -1))
        if i < len(free):
            room, b = free.pop(i)
        else:
            b = len(used)
            used.append(0)
            best = (float("inf"), 0)
            for c in sizes:
                if c >= need:
                    held = need + trial(c - need, place + 1)
                    best = min(best, (cost(next(s for s in sizes if s >= held)) / held, c))
            room = best[1]
        at[k] = (b, used[b])
        used[b] += need
        if room > need:
            insort(free, (room - need, b))
    final = [next(c for c in sizes if c >= u) for u in used]
    return [(b, o, final[b]) for b, o in at]


def total_cost(packed: list[tuple[int, int, int]]) -> float:
    """Cost of all bins of a packing."""
    return sum(cost(c) for _, c in {(b, c) for b, _, c in packed})


def pack(docs: DataFrame, *, id_col: str = "doc_id", length: Column | None = None, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bin_id, bin_offset, capacity.

    A document longer than the largest capacity is cut into pieces of that size and a rest; nothing
    is dropped or cut off. A document without tokens (null or empty text) is one piece of length 0
    with null bin_id, bin_offset and capacity. length: tokens of a row, the words of `text` by
    default; null and negative lengths count as 0. Repeated rows are packed each for itself.
    """
    most = max(capacities)
    size = F.greatest(F.coalesce(length if length is not None else word_count(F.col("text")), F.lit(0)), F.lit(0)).cast("long")
    lengths = written(docs.select(F.col(id_col).alias("doc_id"), size.alias("n")), "lengths")
    # a full piece is a bin of its own; the rests are packed
    cuts = lengths.withColumn("k", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most) - 1, F.lit(0)))))
    pieces = cuts.select("doc_id", F.col("k").cast("long").alias("piece"), (F.col("k") * most).cast("long").alias("start"), F.least(F.col("n") - F.col("k") * most, F.lit(most)).cast("long").alias("n_tokens"))
    # the number of a row in the written table is the same in every attempt, and differs between repeated rows
    pieces = pieces.withColumn("row", F.monotonically_increasing_id())
    shards = int(lengths.count() // SHARD_PIECES) + 1
    own = F.when(F.col("n_tokens") == most, F.concat(F.lit("f"), F.col("row").cast("string")))
    alone = pieces.filter((F.col("n_tokens") == most) | (F.col("n_tokens") == 0)).select("doc_id", "piece", "start", "n_tokens", own.alias("bin_id"), F.when(F.col("n_tokens") > 0, F.lit(0).cast("long")).alias("bin_offset"), F.when(F.col("n_tokens") > 0, F.lit(most)).cast("long").alias("capacity"))
    rests = pieces.filter((F.col("n_tokens") < most) & (F.col("n_tokens") > 0)).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    sizes = tuple(capacities)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", kind="stable")
        got = best_fit(frame["n_tokens"].tolist(), sizes)
        shard = int(frame["shard"].iloc[0])
        return frame.assign(bin_id=[f"s{shard}-{b}" for b, _, _ in got], bin_offset=[o for _, o, _ in got], capacity=[c for _, _, c in got])[["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_offset", "capacity"]]

    kind = docs.schema[id_col].dataType.simpleString()
    packed = rests.groupBy("shard").applyInPandas(run, f"doc_id {kind}, piece long, start long, n_tokens long, bin_id string, bin_offset long, capacity long")
    return packed.unionByName(alone)
