import random
import re

import numpy as np
import pytest

from tessera.llm import setsketch
from tessera.llm.components import components
from tests.llm.cases import documents, sentence, texts

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UPPER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """component_id by id for (id, text) rows, all pairs compared."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_edge_cases_match_brute_force(spark):
    docs = documents(spark)
    got = setsketch.near_duplicates(docs)
    want = brute(list(enumerate(texts())))
    rows = got.collect()
    assert len(rows) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_large_groups_of_near_copies(spark):
    rng = random.Random(5)
    base = sentence(rng, 120).split()
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(40)}"
        rows.append((k, " ".join(w)))
    shared = sentence(rng, 40)
    rows += [(1000 + k, sentence(rng, 30) + " " + shared) for k in range(60)]
    rows += [(2000 + k, rows[3][1]) for k in range(50)]
    rng.shuffle(rows)
    check(spark, rows)


def test_no_documents_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert setsketch.near_duplicates(empty).collect() == []
    some = spark.createDataFrame([(None, "a b c d e f"), (None, None), (1, "a b c d e f")], "doc_id long, text string")
    rows = {(r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(some).collect()}
    assert rows == {(None, None, True), (1, 1, True)}


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for share in (0.1, 0.5, 0.75, 0.95):
        n = 600
        both = int(2 * n * share / (1 + share))
        a, b = np.sort(pool[:n]), np.sort(pool[n - both : 2 * n - both])
        regs = [setsketch.registers(s, np.array([0, len(s)])) for s in (a, b)]
        got = setsketch.jaccard_estimate(regs[0], regs[1], np.array([float(n)]), np.array([float(n)]))[0]
        assert abs(got - share) < 0.13


def test_registers_merge():
    rng = np.random.default_rng(4)
    a, b = np.sort(rng.integers(0, 2**63, 50, dtype=np.uint64)), np.sort(rng.integers(0, 2**63, 70, dtype=np.uint64))
    both = np.union1d(a, b)
    one, two, union = (setsketch.registers(s, np.array([0, len(s)]))[0] for s in (a, b, both))
    assert (np.maximum(one, two) == union).all()


@pytest.mark.parametrize("chain", [2, 9])
def test_components_of_chains(spark, chain):
    edges = [(10 * c + k, 10 * c + k + 1) for c in range(3) for k in range(chain)] + [(5, 5)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}
