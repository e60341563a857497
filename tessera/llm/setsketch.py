"""Near-duplicate groups by SetSketch registers.

A document's set of distinct word shingles is summed up in registers that hold exponentially
spaced truncated minima. Equal registers in a band make two documents candidates, the joint
likelihood of the register comparison estimates their similarity, and survivors are confirmed
on their full sets.

Groups of any size stay linear: documents with equal sets are one representative, and a bucket
proposes links to its most central member first. What then still shares a bucket across
components is joined exactly, on the rarest shingles of each set: two sets that are similar
enough must share one of those, so no pairs are formed on what a whole group has in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import written
from .components import components, hot_keys, looked_up
from .textnum import SPACED, mix, pieces, shingle_sets, utf8, words

#: A link at 75 % is missed by all bands with probability (1 - 0.75**ROWS)**BANDS, about 5e-6.
ROWS, BANDS = 5, 45
#: Registers; prime, so that any stride visits each register once.
M = 227
#: Rounds in which each document is compared with one more leader.
STARS = 2
#: Base and rate of the truncated minima; registers are 0..65535.
BASE, RATE = 1.001, 20.0
#: Estimates this far below the threshold are six standard errors off.
SLACK = 6.0


def registers(sets: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """SetSketch registers (texts x M, uint16) of the sets between the borders.

    Element e reaches its registers in a pseudo-random order at increasing points x_1 < x_2 < ...,
    sums of exponentials with rates RATE*(M-j); a register keeps the smallest point. A text stops
    when no further point can lower any of its registers.
    """
    n = len(borders) - 1
    sizes = np.diff(borders)
    least = np.full((n, M), np.inf)
    flat = least.ravel()
    owner = np.repeat(np.arange(n), sizes)
    h = mix(sets)
    at = (h % np.uint64(M)).astype(np.int64)
    stride = (mix(h + np.uint64(1)) % np.uint64(M - 1)).astype(np.int64) + 1
    x = np.zeros(len(h))
    for j in range(M):
        if not len(h):
            break
        u = ((mix(h + np.uint64(2 + j)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(u) / (RATE * (M - j))
        np.minimum.at(flat, owner * M + at, x)
        at = at + stride
        at[at >= M] -= M
        if j % (1 if j < 16 else 8) == 0:
            live = x < least.max(axis=1)[owner]
            h, at, stride, x, owner = h[live], at[live], stride[live], x[live], owner[live]
    with np.errstate(divide="ignore", invalid="ignore"):
        k = np.floor(1.0 - np.log(least) / np.log(BASE))
    return np.where(np.isfinite(k), np.clip(k + 20_000, 0, 65535), 0).astype(np.uint16)


def jaccard_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from register comparisons (pairs x M each) and set sizes."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - up - down
    u, v = na / (na + nb), nb / (na + nb)
    most = np.minimum(u / v, v / u)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    prob = lambda t: -np.log1p(-t * (BASE - 1) / BASE) / np.log(BASE)
    for share in np.linspace(0.0, 1.0, 101):
        j = most * share
        p, q = prob(np.maximum(u - v * j, 0)), prob(np.maximum(v - u * j, 0))
        like = up * np.log(np.maximum(p, 1e-12)) + down * np.log(np.maximum(q, 1e-12)) + equal * np.log(np.maximum(1 - p - q, 1e-12))
        better = like > best
        best, at = np.where(better, like, best), np.where(better, j, at)
    return at


def _text_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offsets = utf8(column)
    for i, j in pieces(offsets):
        yield (i, j, *shingle_sets(words(raw, offsets[i : j + 1], SPACED), size))


def _features(size: int):
    def run(batches):
        for batch in batches:
            counts, one, two, regs = [], [], [], []
            for _, _, sets, borders in _text_sets(batch.column("text"), size):
                n = np.diff(borders)
                counts.append(n)
                for out, h in ((one, mix(sets)), (two, mix(sets ^ np.uint64(0x5851F42D4C957F2D)))):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)))
                    out.append((total[borders[1:]] - total[borders[:-1]]).view(np.int64))
                # registers in runs of bounded size
                for s in range(0, len(n), 512):
                    part = borders[s : s + 513]
                    r = registers(sets[part[0] : part[-1]], part - part[0])
                    regs.extend(x.tobytes() if c else None for x, c in zip(r, n[s : s + 512].tolist(), strict=True))
            join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(join(counts), pa.int64()), pa.array(join(one), pa.int64()), pa.array(join(two), pa.int64()), pa.array(regs, pa.binary())], names=["id", "n_shingles", "s1", "s2", "regs"])

    return run


def _regs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), M)


def _band_keys(batches):
    for batch in batches:
        for s in range(0, len(batch), 4096):
            part = batch.slice(s, 4096)
            r = _regs(part.column("regs"))[:, : ROWS * BANDS].astype(np.uint64).reshape(len(part), BANDS, ROWS)
            h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(part), BANDS)).copy()
            for k in range(ROWS):
                h = mix(h * np.uint64(0x2545F4914F6CDD1D) + r[:, :, k])
            ids = np.repeat(part.column("id").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(h.reshape(-1).view(np.int64)), pa.array(ids)], names=["key", "id"])


def _likely(share: float):
    def run(batches):
        for batch in batches:
            for s in range(0, len(batch), 4096):
                part = batch.slice(s, 4096)
                na, nb = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
                close = jaccard_estimate(_regs(part.column("ra")), _regs(part.column("rb")), na, nb) >= share - SLACK * (share * (1 - share) / M) ** 0.5
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(close))

    return run


def _confirmed(size: int, percent: int):
    def run(batches):
        for batch in batches:
            for s in range(0, len(batch), 256):
                part = batch.slice(s, 256)
                keep, last, known = [], None, None
                texts = part.column("ta").to_pylist()
                for i, j, sets, borders in _text_sets(part.column("tb"), size):
                    for row in range(i, j):
                        if last is None or texts[row] != last:
                            last = texts[row]
                            known = next(_text_sets(pa.array([last], pa.string()), size))[2]
                        other = sets[borders[row - i] : borders[row - i + 1]]
                        both = len(np.intersect1d(known, other, assume_unique=True))
                        keep.append(100 * both >= percent * (len(known) + len(other) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shingle_rows(size: int):
    def run(batches):
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            for i, j, sets, borders in _text_sets(batch.column("text"), size):
                n = np.diff(borders)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[i:j], n)), pa.array(np.repeat(labels[i:j], n)), pa.array(np.repeat(n, n)), pa.array(sets.view(np.int64))], names=["id", "label", "n", "token"])

    return run


def _prefix_pairs(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of docs (id, label, text) of different labels that can be similar enough.

    The shingles of each set stand in one order, rarest first. If the first common shingle of two
    sets is at place p of n in one of them, they share at most n - p + 1, which bounds the size m
    of the other: m <= (n - p + 1) * (100 + percent) / percent - n. Only places whose bound some
    other holder of the shingle meets, and shingles held across labels, take part in the join.
    """
    rows = docs.mapInArrow(_shingle_rows(size), "id long, label long, n long, token long")
    rows = written(rows, "shingles")
    often = rows.groupBy("token").agg(F.count("*").alias("f"))
    placed = rows.join(often, "token").withColumn("p", F.row_number().over(Window.partitionBy("id").orderBy("f", "token")))
    placed = placed.withColumn("most", F.expr(f"(n - p + 1) * {100 + percent} div {percent} - n")).filter(f"f > 1 and 100 * most >= {percent} * n").select("id", "label", "n", "token", "most")
    placed = written(placed, "prefixes")
    for _ in range(2):  # the second time without what the first has dropped
        held = placed.groupBy("token").agg(F.min("n").alias("least"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("token", "least")
        placed = placed.join(held, "token").filter("most >= least").select("id", "label", "n", "token", "most")
    placed = written(placed, "prefixes")
    one, two = (placed.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "label", "n", "most"))) for s in "ab")
    fits = "id_a < id_b and label_a <> label_b and n_a <= most_b and n_b <= most_a"
    return one.join(two, "token").filter(fits).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets
    (A-Z lower-cased, words split at spaces and \\t..\\r). component_id is the smallest id that
    links reach. A null or wordless text has an empty set, is linked with nothing and is its own
    component. A document with a null id has a null component_id and is kept. Repeated ids share
    their links. Other columns of docs are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    feats = written(base.mapInArrow(_features(size), "id long, n_shingles long, s1 long, s2 long, regs binary"), "features")
    sized = feats.filter("n_shingles > 0 and id is not null")
    same = ["n_shingles", "s1", "s2"]
    classes = sized.groupBy(*same).agg(F.min("id").alias("rep"))
    sketches = written(sized.select("id", "n_shingles", "regs").join(classes.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"]), "sketches")
    bands = sketches.mapInArrow(_band_keys, "key long, id long")
    full = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = written(bands.join(full, "key"), "buckets")
    weight = buckets.groupBy("id").agg(F.sum("n").alias("w"))
    leads = buckets.join(weight, "id").groupBy("key").agg(F.max_by("id", F.struct("w", F.negative("id"))).alias("lead"))
    met = written(buckets.join(leads, "key").filter("id <> lead").groupBy("id", "lead").count(), "met")
    texts = written(base.join(buckets.select("id").distinct(), "id", "left_semi"), "texts")

    def linked(pairs: DataFrame) -> DataFrame:
        near = pairs
        for end in ("b", "a"):
            near = near.join(sketches.select(F.col("id").alias(end), F.col("n_shingles").alias(f"n{end}"), F.col("regs").alias(f"r{end}")), end)
        ratio = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")
        near = near.filter(ratio).select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(percent / 100), "a long, b long")
        for end in ("b", "a"):
            near = near.join(texts.select(F.col("id").alias(end), F.col("text").alias(f"t{end}")), end)
        return written(near.select("a", "b", "ta", "tb").mapInArrow(_confirmed(size, percent), "a long, b long"), "links")

    def labelled(labels: DataFrame, side: DataFrame, col: str, out: str, spread: str | None = None) -> DataFrame:
        """side with the label of its column col; spread, another column, splits the rows of a frequent value."""
        if spread:
            got = looked_up(side, col, spread, labels.select(F.col("id").alias("key"), F.col("label").alias("value")), out, hot_keys(side, col, side.count()))
        else:
            got = side.join(labels.select(F.col("id").alias(col), F.col("label").alias(out)), col, "left")
        return got.withColumn(out, F.coalesce(out, col))

    # each document against the leaders it meets in most buckets
    links, tested, labels = [], None, None
    for _ in range(STARS):
        left = met
        if labels is not None:
            left = labelled(labels, labelled(labels, met, "lead", "ll", "id"), "id", "li").filter("li <> ll")
            left = left.join(tested.select(F.col("a").alias("lead"), F.col("b").alias("id")), ["id", "lead"], "left_anti")
        best = F.max_by("lead", F.struct("count", F.negative("lead")))
        pairs = written(left.groupBy("id").agg(best.alias("lead")).select(F.col("lead").alias("a"), F.col("id").alias("b")), "tested")
        if pairs.isEmpty():
            break
        tested = pairs if tested is None else tested.union(pairs)
        links.append(linked(pairs))
        labels = components(reduce(DataFrame.union, links))
    # then, exactly, all that share a bucket across components
    if tested is not None:
        parts = labelled(labels, buckets.select("key", "id"), "id", "label")
        mixed = parts.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
        open_docs = written(parts.join(mixed, "key", "left_semi").select("id", "label").distinct(), "open")
        if not open_docs.isEmpty():
            pairs = _prefix_pairs(texts.join(open_docs, "id"), size, percent)
            both = tested.union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
            links.append(linked(pairs.join(both, ["a", "b"], "left_anti")))
            labels = components(reduce(DataFrame.union, links))
    else:
        labels = classes.select(F.col("rep").alias("id"), F.col("rep").alias("label")).limit(0)
    owners = labelled(labels, classes, "rep", "label").select(F.struct(*same).alias("key"), F.col("label").alias("value"))
    rows = feats.select("id", "n_shingles", F.struct(*same).alias("of"))
    out = looked_up(rows, "of", "id", owners, "label", hot_keys(rows, "of", rows.count()))
    own = F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("label", "id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
