"""Embedding near-duplicates and whitening against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import embedding_dedup as e, whitening as w
from tessera.llm.queries import op12_embedding_near_duplicates, op13_embedding_whitening

from .cases import DIR

SCHEMA = "vec_id long, embedding array<float>, label int, cell long, n string, links string, component_id string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, label, 1, "n", "l", "c", "x") for k, v, label in rows], SCHEMA)


def brute(rows):
    """Counter of (vec_id, n_links, component_id, kept) over all pairs."""
    x = [None if v is None or label is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v) else np.float32(v).astype(float) for _, v, label in rows]
    links, least, pairs = [0] * len(rows), list(range(len(rows))), []
    groups = {}
    for i, v in enumerate(x):
        if v is not None:
            groups.setdefault((rows[i][2], len(v)), []).append(i)
    for ids in groups.values():
        y = np.stack([x[i] * 2.0 ** -np.frexp(np.abs(x[i]).max())[1] for i in ids])
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(y @ y.T >= 0.93, 1))):
            pairs.append((ids[b], ids[a]))
            links[ids[a]] += 1
            links[ids[b]] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            m = min(least[i], least[j])
            changed |= least[i] != m or least[j] != m
            least[i] = least[j] = m
    low = {}
    for k, r in enumerate(rows):
        low[least[k]] = min((i for i in (low.get(least[k]), r[0]) if i is not None), default=None)
    return Counter((r[0], links[k], low[least[k]], r[0] == low[least[k]]) for k, r in enumerate(rows))


def clustered(seed, n, labels=2, dim=16, copies=0.3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        label = int(rng.integers(labels))
        near = [r for r in rows[-200:] if r[2] == label]
        if near and rng.random() < copies:
            v = np.array(near[int(rng.integers(len(near)))][1])
            v = v + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.1, 0.3]) * np.linalg.norm(v) / np.sqrt(dim)
        else:
            v = rng.standard_normal(dim)
        rows.append((k, [float(c) for c in np.float32(v)], label))
    return rows


def test_small_spaces_are_compared_whole(spark):
    rows = clustered(1, 300)
    assert Counter(map(tuple, e.near_duplicates(frame(spark, rows)).collect())) == brute(rows)


def test_awkward_vectors(spark):
    rows = clustered(2, 60)
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 16, 0), (1003, [nan] * 16, 1), (1004, [inf] + [0.0] * 15, 1), (1005, [None] + [1.0] * 15, 0), (1006, rows[0][1], None), (1007, rows[0][1][:8], rows[0][2]), (None, rows[0][1], rows[0][2]), (None, [9.0] * 3, 5)]
    rows += [rows[3], rows[3], (3, rows[4][1], rows[4][2]), (1008, [1e-38 * c for c in rows[0][1]], rows[0][2]), (1009, [1e30 * c for c in rows[0][1]], rows[0][2]), (1010, [0.0, -1.0], 3), (1011, [-0.0, -2.0], 3)]
    assert Counter(map(tuple, e.near_duplicates(frame(spark, rows)).collect())) == brute(rows)
    assert e.near_duplicates(frame(spark, [])).count() == 0
    assert e.near_duplicates(frame(spark, [(1, None, None)])).collect() == [(1, 0, 1, True)]


def recall(spark, rows, **how):
    """Links found of all; no link but true ones, every pair once."""
    got = {r[0]: r for r in e.near_duplicates(frame(spark, rows), **how).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert len(got) == len(rows) and all(got[k][1] <= want[k][1] and got[k][2] >= want[k][2] for k in want)
    return sum(r[1] for r in got.values()) / sum(r[1] for r in want.values())


def test_recall_of_deep_trees(spark):
    rows = clustered(3, 2500, labels=1, dim=24)
    assert recall(spark, rows, leaf=16, cell=64) >= 0.9
    assert recall(spark, rows, leaf=32, cell=10_000) >= 0.9
    assert recall(spark, rows, leaf=16, cell=10_000, trees=1) < recall(spark, rows, leaf=16, cell=10_000, trees=6)


def test_dense_group_counts_every_pair_once(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(k, [float(c) for c in np.float32(centre + rng.standard_normal(16) * 0.02)], 0) for k in range(500)] + clustered(6, 50, labels=1)
    rows = [(k, v, label) for k, (_, v, label) in enumerate(rows)]
    got = {r[0]: r[1] for r in e.near_duplicates(frame(spark, rows), leaf=40, cell=150, trees=12).collect()}
    assert max(got.values()) <= 499 + 0 and np.mean([got[k] for k in range(500)]) > 0.9 * 499


def test_cells_bound_what_a_task_holds(spark):
    rows = clustered(7, 3000, labels=1, dim=8)
    classes = spark.createDataFrame([("s", k, 1, v) for k, v, _ in rows], "space string, cid long, n long, vec array<float>")
    cuts = e.upper_levels(classes, 3000, 2, 50, sample=128)
    unit = e._units(np.array([v for _, v, _ in rows], float))
    for tree in (0, 1):
        _, sizes = np.unique(cuts.cell("s", tree, unit), return_counts=True)
        assert sizes.sum() == 3000 and sizes.max() <= 100
    assert not np.array_equal(cuts.cell("s", 0, unit), cuts.cell("s", 1, unit))


def test_more_trees_for_more_vectors():
    assert e.trees_for(100, 2048, 256) == e.TREES and e.trees_for(10**8, 2048, 256) > e.trees_for(10**5, 2048, 256)


def test_query_on_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert Counter(map(tuple, op12_embedding_near_duplicates(spark, DIR).collect())) == brute(rows)


def plain(rows, components=8):
    rows = [(k, [int(np.floor(np.float64(np.float32(c)) * 1024)) + 100_000 for c in v]) for k, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    n = len(rows)
    sums = [sum(c) for c in zip(*(x for _, x in rows))]
    y = np.array([[n * a - s for a, s in zip(x, sums)] for _, x in rows], object)
    deviation = [int(sum(c * c for c in r)) for r in y]
    centred = y.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, [k for k, _ in rows], deviation, centred, values[::-1][:components], vectors[:, ::-1][:, :components]


def check_whitened(got, rows, components=8):
    n, keys, deviation, centred, values, vectors = plain(rows, components)
    white = centred @ vectors / np.sqrt(values)
    assert len(got) == n * len(values) and {r["n"] for r in got} == {n}
    at = {k: i for i, k in enumerate(keys)}
    signs = {}
    for r in got:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[i]
        assert abs(r["explained"] / (values[c] / np.mean((centred**2).sum(1))) - 1) < 1e-9
        assert abs(abs(r["whitened"]) - abs(white[i, c])) < 1e-6 and r["identity_error"] < 1e-9
        if abs(white[i, c]) > 1e-3:
            assert signs.setdefault(c, np.sign(r["whitened"] * white[i, c])) == np.sign(r["whitened"] * white[i, c])


def test_whitening_equals_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = op13_embedding_whitening(spark, DIR)
    check_whitened(out.collect(), rows)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}


def test_whitening_of_awkward_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [float(c) for c in np.float32(rng.standard_normal(5) * [1, 2, 3, 4, 9])], 0) for k in range(40)]
    bad = [(50, None, 0), (51, [float("nan")] * 5, 0), (52, [None] * 5, 0), (53, [float("inf")] * 5, 0), (54, [1.0] * 4, 0), (55, [], 0)]
    got = w.whitened(frame(spark, rows + bad)).collect()
    check_whitened(got, rows)
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5}
    assert w.whitened(frame(spark, rows + [(None, rows[0][1], 1), rows[1]])).count() == 42 * 5
    assert w.whitened(frame(spark, [])).count() == 0 and w.whitened(frame(spark, bad[:4])).count() == 0
    assert "identity_error" in w.whitened(frame(spark, [])).columns


@pytest.mark.parametrize("vectors", [[[1.0, 2.0, 3.0]], [[1.0, 2.0, 3.0]] * 4])
def test_whitening_without_variance(spark, vectors):
    got = w.whitened(frame(spark, [(k, v, 0) for k, v in enumerate(vectors)])).collect()
    assert len(got) == 3 * len(vectors) and {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in got} == {(0.0, 0.0, 0.0, 0)}


def test_whitening_of_fewer_rows_than_components_and_large_entries(spark):
    rng = np.random.default_rng(9)
    got = w.whitened(frame(spark, [(k, [float(c) for c in rng.standard_normal(6)], 0) for k in range(3)])).collect()
    assert len(got) == 18 and all((r["whitened"] == 0) == (r["component"] > 2) and r["identity_error"] < 1e-9 for r in got)
    big = [(k, [float(c) for c in np.float32(rng.standard_normal(3) * 1e9)], 0) for k in range(20)]
    assert {r["deviation"] for r in w.whitened(frame(spark, big)).collect()} == {None}
    df = spark.createDataFrame([(k, [float(c) for c in rng.standard_normal(4)]) for k in range(9)], "vec_id string, embedding array<double>").withColumn("key", F.lit(1)).withColumn("w", F.lit(1))
    assert w.whitened(df).count() == 36
