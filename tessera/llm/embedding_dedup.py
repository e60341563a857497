"""Near-duplicate embeddings by a forest of random-projection trees.

Equal vectors of one label are one class. Each tree splits the classes of a label by random projections
in two stages. The upper levels cut at sampled medians, without overlap, until a cell fits in a task:
they deal the classes to tasks, one row for each class and tree. Within a cell the tree goes on,
now with overlap: the classes nearest to a cut go to both sides. Vectors are compared within
leaves, near the threshold in double precision. A pair that meets in several leaves counts in the first
of them, which both members' lists of leaves tell, so links are summed by class and no table of
pairs is ever made; a leaf sends on only a spanning forest of what it links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import checkpointed, written
from .components import components, hot_keys, looked_up

THRESHOLD = 0.93
#: Vectors of a leaf that is not dense, at most; classes of a cell, about (twice as many at most); and cells of a tree at most, which bounds the broadcast cuts (cells grow beyond).
LEAF, CELL, CELLS = 256, 8192, 1 << 20
#: A node is dense, and one leaf whatever its size, if of so many of its vectors this share of pairs is linked.
DENSE_SAMPLE, DENSE = 256, 0.01
#: A cut lies between these shares of a node's vectors, where the fewest are near it.
CUT_FROM, CUT_TO = 0.3, 0.7
#: Rows of a leaf that are compared with all others at a time.
_BLOCK = 512
#: Share of a node's classes that go to both sides, by their distance from its cut.
OVERLAP = 0.1
#: Classes of a cell that are sampled to find its next cuts (about), and fewest for one cut.
SAMPLE, FEWEST = 4096, 16
#: Trees, at least, and the share of pairs at the threshold that should meet in one of them.
TREES, MEETING = 4, 0.95
#: How often two vectors at the threshold stay together at a cut without and with overlap: 1 - angle / pi, and by simulation.
_STAY, _STAY_OVERLAP = 1 - math.acos(THRESHOLD) / math.pi, 0.95
#: Cosines of single precision are nearer to the true ones than this.
_ROUNDING = 1e-4
#: Levels of cuts by sample, at most.
_LEVELS = 60


@dataclass
class Cuts:
    """The upper levels of all trees: thresholds by (space, tree), nodes numbered as in a heap, sorted."""

    nodes: dict[tuple[str, int], np.ndarray] = field(default_factory=dict)
    at: dict[tuple[str, int], np.ndarray] = field(default_factory=dict)

    def extend(self, found: list[tuple[str, int, int, float]]) -> None:
        by: dict[tuple[str, int], list[tuple[int, float]]] = {}
        for space, tree, node, cut in found:
            by.setdefault((space, tree), []).append((node, cut))
        for key, more in by.items():
            old = list(zip(self.nodes.get(key, ()), self.at.get(key, ()), strict=True))
            both = sorted([*old, *more])
            self.nodes[key], self.at[key] = np.array([n for n, _ in both], np.int64), np.array([c for _, c in both])

    def cell(self, space: str, tree: int, unit: np.ndarray) -> np.ndarray:
        """The node below the last cut, of each vector."""
        node = np.ones(len(unit), np.int64)
        nodes, at = self.nodes.get((space, tree)), self.at.get((space, tree))
        if nodes is None:
            return node
        open_rows, level = np.arange(len(unit)), 0
        while len(open_rows):
            k = np.minimum(np.searchsorted(nodes, node[open_rows]), len(nodes) - 1)
            cut = nodes[k] == node[open_rows]
            open_rows, k = open_rows[cut], k[cut]
            side = unit[open_rows] @ direction(f"{tree}/{level}", unit.shape[1]) > at[k]
            node[open_rows] = 2 * node[open_rows] + side
            level += 1
        return node


def direction(name: str, size: int) -> np.ndarray:
    """A random direction that depends on its name only, so that a lost task is done again alike."""
    return np.random.default_rng(_number(name)).standard_normal(size)


def _number(name: str) -> int:
    """A positive number of 63 bits for a name."""
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big") >> 1


def _quiet(along: np.ndarray) -> float:
    """Where to cut: of the middle values the one near which the fewest values lie, so that dense groups stay whole.

    Near is half of what two unit vectors at the threshold differ by along a direction of standard normal entries.
    """
    values = np.sort(along)
    n, width = len(values), math.sqrt(2 - 2 * THRESHOLD) / 2
    at = np.unique(values[int(n * CUT_FROM) : max(int(n * CUT_TO), int(n * CUT_FROM) + 1)])
    near = np.searchsorted(values, at + width, "right") - np.searchsorted(values, at - width, "left")
    off = np.abs(np.searchsorted(values, at, "right") / n - 0.5)
    return float(at[np.argmin(near + 0.05 * n * off)])


def trees_for(largest: int, cell: int, leaf: int) -> int:
    """Trees with which MEETING of the pairs at the threshold share a leaf, for the largest space."""
    upper = max(0, math.ceil(math.log2(max(largest, 1) / cell)))
    lower = max(0, math.ceil(math.log2(max(min(largest, cell), 1) / leaf)))
    together = min(_STAY**upper * _STAY_OVERLAP**lower, 0.999)
    return max(TREES, math.ceil(math.log(1 - MEETING) / math.log(1 - together)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as doubles, scaled by powers of two so that no square leaves the range of a double; that keeps every digit."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    _, exponent = np.frexp(np.abs(x).max(1))
    return np.ldexp(x, -exponent[:, None])


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_space(batch: pa.RecordBatch):
    """(space, row numbers, unit vectors) of a batch."""
    spaces = batch.column("space").dictionary_encode()
    codes = spaces.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
        if len(rows):
            yield spaces.dictionary[int(codes[rows[0]])].as_py(), rows, _units(_matrix(batch.column("vec").take(pa.array(rows))))


def _cell_counts(classes: DataFrame, cuts: Broadcast, trees: int) -> DataFrame:
    """(space, tree, node, n) of the cells, counted in each task before they are shuffled."""

    def go(batches):
        counts: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for space, _, unit in _by_space(batch):
                for tree in range(trees):
                    for node, n in zip(*np.unique(cuts.value.cell(space, tree, unit), return_counts=True), strict=True):
                        key = space, tree, int(node)
                        counts[key] = counts.get(key, 0) + int(n)
            if len(counts) > 100_000:
                yield _batch(counts)
                counts = {}
        if counts:
            yield _batch(counts)

    def _batch(counts):
        s, t, c = zip(*counts, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(s, pa.string()), pa.array(t, pa.int32()), pa.array(c, pa.int64()), pa.array(counts.values(), pa.int64())], names=["space", "tree", "node", "n"])

    each = classes.select("space", "vec").mapInArrow(go, "space string, tree int, node long, n long")
    return each.groupBy("space", "tree", "node").agg(F.sum("n").alias("n"))


def _next_cuts(classes: DataFrame, cuts: Broadcast, wide: dict[tuple[str, int, int], int], cell: int, sample: int) -> list[tuple[str, int, int, float]]:
    """Cuts of the cells in wide (their sizes), by about sample classes of each, as many levels as those bear."""
    shared = classes.sparkSession.sparkContext.broadcast(wide)
    trees = sorted({t for _, t, _ in wide})

    def drawn(batches):
        for batch in batches:
            cid = batch.column("cid").to_numpy()
            for space, rows, unit in _by_space(batch):
                for tree in trees:
                    nodes = cuts.value.cell(space, tree, unit)
                    kinds, back = np.unique(nodes, return_inverse=True)
                    rate = np.array([min(1.0, sample / shared.value[space, tree, int(n)]) if (space, tree, int(n)) in shared.value else 0.0 for n in kinds])
                    mixed = (cid[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree + 1)) * np.uint64(0xBF58476D1CE4E5B9)
                    take = (mixed >> np.uint64(11)).astype(float) / 2.0**53 < rate[back]
                    if take.any():
                        n = int(take.sum())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([space] * n, pa.string()), pa.array([tree] * n, pa.int32()), pa.array(nodes[take]), batch.column("vec").take(pa.array(rows[take]))], names=["space", "tree", "node", "vec"]
                        )

    def cut(key, table):
        space, tree, node = (k.as_py() for k in key)
        unit = _units(_matrix(table.column("vec").combine_chunks()))
        found, todo = [], [(node, np.arange(len(unit)), shared.value[space, tree, node])]
        while todo:
            node, rows, size = todo.pop()
            level = node.bit_length() - 1
            if size <= cell or len(rows) < FEWEST or level >= _LEVELS:
                continue
            along = unit[rows] @ direction(f"{tree}/{level}", unit.shape[1])
            at = _quiet(along)
            right = along > at
            if right.all() or not right.any():
                continue
            found.append((space, tree, node, at))
            todo += [(2 * node, rows[~right], size * float(1 - right.mean())), (2 * node + 1, rows[right], size * float(right.mean()))]
        s, t, n, c = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.table({"space": pa.array(s, pa.string()), "tree": pa.array(t, pa.int32()), "node": pa.array(n, pa.int64()), "cut": pa.array(c, pa.float64())})

    kind = StructType([*StructType.fromDDL("space string, tree int, node long"), classes.schema["vec"]])
    picked = classes.select("space", "cid", "vec").mapInArrow(drawn, kind)
    rows = picked.groupBy("space", "tree", "node").applyInArrow(cut, "space string, tree int, node long, cut double").collect()
    return [tuple(r) for r in rows]


def upper_levels(classes: DataFrame, largest: int, trees: int, cell: int, sample: int = SAMPLE) -> Cuts:
    """Cuts until no cell of any tree has more than twice cell classes, as far as cuts part them.

    Every round counts all cells in one pass over the classes and cuts the large ones by several levels.
    What reaches the driver are sizes and cuts of cells, at most trees * classes / cell of them.
    """
    found, context = Cuts(), classes.sparkSession.sparkContext
    if largest <= 2 * cell:
        return found
    for _ in range(_LEVELS):
        cuts = context.broadcast(found)
        wide = {(r["space"], r["tree"], r["node"]): r["n"] for r in _cell_counts(classes, cuts, trees).filter(F.col("n") > 2 * cell).collect()}
        more = _next_cuts(classes, cuts, wide, cell, sample) if wide else []
        if not more:
            break
        found.extend(more)
    return found


def _dense(unit: np.ndarray, name: str) -> bool:
    """Whether so many of the vectors are near each other that a cut would part many links."""
    rng = np.random.default_rng(_number(name))
    some = unit[rng.choice(len(unit), min(len(unit), DENSE_SAMPLE), replace=False)]
    linked = int((some @ some.T >= THRESHOLD).sum()) - len(some)
    return linked > DENSE * len(some) * (len(some) - 1)


def _leaves(unit: np.ndarray, name: str, leaf: int) -> list[tuple[str, np.ndarray]]:
    """Leaves of one cell: parts by rank along random directions, with overlap, until leaf vectors are left or what is left is dense."""
    done, todo = [], [("", np.arange(len(unit)))]
    while todo:
        path, rows = todo.pop()
        if len(rows) <= leaf or _dense(unit[rows], f"{name}/{path}"):
            done.append((path, rows))
            continue
        along = unit[rows] @ direction(f"{name}/{path}", unit.shape[1])
        order, extra = np.argsort(along, kind="stable"), OVERLAP / 2 * len(rows)
        cut = min(max(int((along <= _quiet(along)).sum()), len(rows) * CUT_FROM), len(rows) * CUT_TO)
        todo += [(path + "0", np.sort(rows[order[: math.ceil(cut + extra)]])), (path + "1", np.sort(rows[order[math.floor(cut - extra) :]]))]
    return sorted(done, key=lambda d: d[0])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row number that each of n rows reaches by links a, b."""
    least = np.arange(n)
    while True:
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, least[a])
        new = new[new]
        if np.array_equal(new, least):
            return least
        least = new


def linked_pairs(x: np.ndarray, unit32: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, first below second, whose cosine is threshold or more, some rows at a time; all are verified in double precision."""
    norm = np.linalg.norm(x, axis=1)
    for start in range(0, len(x), _BLOCK):
        a, b = np.nonzero(np.triu(unit32[start : start + _BLOCK] @ unit32[start:].T >= threshold - _ROUNDING, 1))
        a, b = a + start, b + start
        if len(a):
            keep = np.empty(len(a), bool)
            for s in range(0, len(a), 50_000):
                i, j = a[s : s + 50_000], b[s : s + 50_000]
                keep[s : s + 50_000] = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= threshold
            if keep.any():
                yield a[keep], b[keep]


def _met(leaves: np.ndarray) -> bool:
    """Whether all rows have been in one leaf already."""
    return any((leaves == number).any(1).all() for number in leaves[0] if number)


def _first_meeting(leaves: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b have no leaf in common, by a matrix of leaf numbers (0: none)."""
    if not leaves.any():
        return np.ones(len(a), bool)
    met = np.zeros(len(a), bool)
    for s in range(0, len(a), 50_000):
        part = slice(s, s + 50_000)
        right = leaves[b[part]]
        for column in leaves.T:
            left = column[a[part]]
            met[part] |= ((right == left[:, None]) & (left[:, None] != 0)).any(1)
    return ~met


def _search(table: pa.Table, tree: int, leaf: int, cuts: Cuts, threshold: float) -> pa.Table:
    """One cell of one tree: its classes with links, leaves and roots of this tree added, and their cells in the next."""
    table = table.take(np.argsort(table.column("cid").to_numpy(), kind="stable")).combine_chunks()
    space, cell, n = table.column("space")[0].as_py(), table.column("cell")[0].as_py(), len(table)
    vec = table.column("vec").combine_chunks()
    if vec.null_count == n:  # a space of one leaf, which the first tree has compared whole
        return table
    x = _matrix(vec)
    unit = _units(x)
    unit32, w, cid = unit.astype(np.float32), table.column("n").to_numpy(), table.column("cid").to_numpy()
    lists = table.column("leaves").to_pylist()
    links, stars = np.zeros(n, np.int64), []
    before = np.zeros((n, max(map(len, lists)) + 1), np.int64)
    filled = np.array([len(v) for v in lists])
    for k, v in enumerate(lists):
        before[k, : len(v)] = v
    done = _leaves(unit, f"{tree}/{space}/{cell}", leaf)
    for path, rows in done:
        known = before[rows]
        for a, b in linked_pairs(x[rows], unit32[rows], threshold) if not _met(known) else ():
            new = _first_meeting(known, a, b)
            a, b = a[new], b[new]
            if len(a):
                links[rows] += np.bincount(a, w[rows[b]], len(rows)).astype(np.int64) + np.bincount(b, w[rows[a]], len(rows)).astype(np.int64)
                root = _roots(len(rows), a, b)
                far = np.flatnonzero(root != np.arange(len(rows)))
                stars.append(np.stack([rows[far], rows[root[far]]]))
        if filled[rows].max() == before.shape[1]:
            before = np.pad(before, ((0, 0), (0, 4)))
        before[rows, filled[rows]] = _number(f"{tree}/{cell}/{path}")
        filled[rows] += 1
    roots = table.column("roots").to_pylist()
    if stars:
        a, b = np.concatenate(stars, axis=1)
        for k, r in enumerate(_roots(n, a, b).tolist()):
            if r != k:
                roots[k] = [*roots[k], int(cid[r])]
    whole = len(done) == 1 and cell == 1
    return pa.table(
        {
            "space": table.column("space"),
            "cell": pa.array(np.ones(n, np.int64) if whole else cuts.cell(space, tree + 1, unit)),
            "cid": table.column("cid"),
            "n": table.column("n"),
            "vec": pa.nulls(n, vec.type) if whole else vec,
            "leaves": pa.array([v[:m].tolist() for v, m in zip(before, filled, strict=True)], pa.list_(pa.int64())),
            "links": pa.array(links + table.column("links").to_numpy()),
            "roots": pa.array(roots, pa.list_(pa.int64())),
        }
    )


def forest_links(classes: DataFrame, leaf: int = LEAF, cell: int = CELL, trees: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(cid, links, roots) of every class (space, cid, n, vec): rows in directly linked other classes, and one linked class of lower number for each cell with one.

    The number of trees follows the size of the largest space. Each tree deals every class to one
    cell; a space that fits in one leaf is compared once, and later trees pass its classes on without vectors.
    """
    sizes = classes.groupBy("space").count().agg(F.max("count"), F.sum("count")).first()
    largest, total = sizes[0] or 0, sizes[1] or 0
    cell = max(cell, total // CELLS)
    trees = trees or trees_for(largest, cell, leaf)
    found = upper_levels(classes, largest, trees, cell)
    cuts = classes.sparkSession.sparkContext.broadcast(found)

    def first(batches):
        for batch in batches:
            cells = np.ones(len(batch), np.int64)
            if cuts.value.nodes:
                for space, rows, unit in _by_space(batch):
                    cells[rows] = cuts.value.cell(space, 0, unit)
            empty = pa.array([[]] * len(batch), pa.list_(pa.int64()))
            columns = {"space": batch.column("space"), "cell": pa.array(cells), "cid": batch.column("cid"), "n": batch.column("n"), "vec": batch.column("vec"), "leaves": empty, "links": pa.array(np.zeros(len(batch), np.int64)), "roots": empty}
            yield pa.RecordBatch.from_pydict(columns)

    schema = StructType([*StructType.fromDDL("space string, cell long, cid long, n long"), classes.schema["vec"], *StructType.fromDDL("leaves array<long>, links long, roots array<long>")])
    rows = classes.select("space", "cid", "n", "vec").mapInArrow(first, schema)

    def search(tree: int):
        return lambda table: _search(table, tree, leaf, cuts.value, threshold)

    for tree in range(trees):
        rows = rows.groupBy("space", "cell").applyInArrow(search(tree), schema)
    return rows.select("cid", "links", "roots")


def linkable(vector: Column) -> Column:
    """Whether a vector is there, holds finite numbers only and is not zero."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda c: c != 0), F.lit(False))


def near_duplicates(df: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", leaf: int = LEAF, cell: int = CELL, trees: int | None = None) -> DataFrame:
    """(key, n_links, component_id, kept) of every row of df: rows linked directly, and the least key reachable by links.

    Rows are linked if their labels are equal and not null and the cosine of their vectors is 0.93 or more,
    as far as the forest brings them together. Null, empty and zero vectors and those with null or non-finite
    entries are linked with nothing, nor are vectors of different lengths. Repeated rows are linked
    with each other; rows that share a key but not a vector are linked each for itself. The least key is
    taken of those that are not null; a row with a null key is kept if its component has no other
    key. Other columns play no part, whatever their names; an empty table gives no rows.
    """
    v = F.col(vector)
    space = F.concat_ws(":", F.size(v).cast("string"), F.col(label).cast("string"))
    rows = df.select(F.col(key).alias("id"), F.when(linkable(v) & F.col(label).isNotNull(), space).alias("space"), F.when(linkable(v), F.transform(v, lambda c: c + F.lit(0).cast(df.schema[vector].dataType.elementType))).alias("vec"))
    valid = rows.filter("space is not null")
    digest = F.concat_ws(" ", "space", F.hex(F.xxhash64("vec")), F.hex(F.xxhash64(F.lit(7), "vec")))
    classes = written(valid.groupBy("space", "vec").agg(F.count("*").alias("n"), F.min("id").alias("low")).select("space", "vec", "n", "low", digest.alias("key"), F.monotonically_increasing_id().alias("cid")), "vectors")
    found = written(forest_links(classes, leaf, cell, trees), "links")
    label_of = components(found.select(F.explode("roots").alias("a"), F.col("cid").alias("b")))
    each = classes.select("cid", "key", "n", "low").join(found.select("cid", "links"), "cid").join(label_of.select(F.col("id").alias("cid"), F.col("label").alias("comp")), "cid", "left")
    each = checkpointed(each.select("key", "low", (F.col("links") + F.col("n") - 1).alias("n_links"), F.coalesce("comp", "cid").alias("comp"), F.col("comp").isNotNull().alias("joined")))
    least = each.filter("joined").groupBy(F.col("comp").alias("key")).agg(F.min("low").alias("value"))
    joined, total = each.filter("joined"), each.count()
    joined = looked_up(joined, "comp", "key", least, "component_id", hot_keys(joined, "comp", total))
    facts = joined.select("key", F.struct("n_links", "component_id").alias("value")).unionByName(each.filter("not joined").select("key", F.struct("n_links", F.col("low").alias("component_id")).alias("value")))
    keyed = valid.select("id", digest.alias("key"))
    rest = rows.filter("space is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    known = looked_up(keyed, "key", "id", facts, "fact", hot_keys(keyed, "key", total)).select("id", "fact.n_links", "fact.component_id")
    return known.unionByName(rest).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
