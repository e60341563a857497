import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import packing, rollups
from tessera.llm.queries import op2_word_counts
from tests.llm.cases import documents, texts


def test_best_fit_fills_and_fits():
    rng = random.Random(1)
    for _ in range(30):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(0, 200))]
        got = packing.best_fit(lengths, (20, 50, 100))
        bins = {}
        for n, (b, o, c) in zip(lengths, got, strict=True):
            bins.setdefault(b, []).append((o, n, c))
        for parts in bins.values():
            at = 0
            for o, n, c in sorted(parts):
                assert o == at
                at += n
            assert len({c for _, _, c in parts}) == 1
            cap = parts[0][2]
            assert cap == min(c for c in (20, 50, 100) if c >= at)


def test_every_token_is_packed_once(spark):
    docs = documents(spark)
    out = packing.pack(docs, capacities=(16, 64, 256))
    n = sum(len((t or "").split()) for t in texts()) + len(texts()[-1].split())
    rows = out.collect()
    assert sum(r.n_tokens for r in rows) == n
    assert {r.doc_id for r in rows} == set(range(len(texts())))
    assert all((r.bin_id is None) == (r.n_tokens == 0) for r in rows)
    bins = out.filter("bin_id is not null").groupBy("bin_id").agg(F.sum("n_tokens").alias("u"), F.max("capacity").alias("c"), F.countDistinct("capacity").alias("k"))
    assert bins.filter("u > c or k > 1").count() == 0
    assert packing.pack(docs.limit(0)).count() == 0


def counts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, tokenizer string, n_tokens long, n_chars long")


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_chars) for r in rollup.totals().collect()}


def test_deltas_add_up_and_batches_count_once(spark, tmp_path):
    a = counts(spark, [(1, "s", "en", "v1", 5, 20), (2, "s", None, "v1", 7, 30), (3, None, "en", "v1", 0, 0), (3, None, "en", "v1", 0, 0)])
    rollup = rollups.TokenRollup(spark, str(tmp_path / "r"))
    assert totals(rollup) == {}
    assert rollup.commit("b1", rollups.inserts(a))
    assert not rollup.commit("b1", rollups.inserts(a))
    assert totals(rollup) == {("s", "en", "v1"): (1, 5, 20), ("s", None, "v1"): (1, 7, 30), (None, "en", "v1"): (2, 0, 0)}
    b = counts(spark, [(1, "s", "en", "v2", 6, 20), (2, "s", None, "v1", 7, 30), (4, "t", "en", "v1", 1, 2)])
    assert rollup.commit("b2", rollups.revisions(a, b))
    want = {("s", "en", "v2"): (1, 6, 20), ("s", None, "v1"): (1, 7, 30), ("t", "en", "v1"): (1, 1, 2)}
    assert totals(rollup) == want
    assert rollup.compact()
    assert totals(rollup) == want
    assert rollup.compact() is None
    assert not rollup.commit("b2", rollups.inserts(a))
    assert rollup.commit("b3", rollups.deletes(b))
    assert totals(rollup) == {}


def test_an_attempt_that_broke_off_is_overwritten(spark, tmp_path):
    a = counts(spark, [(1, "s", "en", "v1", 5, 20)])
    rollup = rollups.TokenRollup(spark, str(tmp_path / "r"))
    rollups.inserts(a).groupBy("source", "lang", "tokenizer").sum().write.parquet(str(tmp_path / "r/deltas/b1/broken"))
    assert totals(rollup) == {}
    assert rollup.commit("b1", rollups.inserts(a))
    assert totals(rollup) == {("s", "en", "v1"): (1, 5, 20)}


def test_token_counts_match_the_tokenizer(spark):
    tiktoken = pytest.importorskip("tiktoken")
    try:
        vocabulary = {k: open(p, "rb").read() for k, p in rollups.TOKENIZERS.items()}
    except OSError:
        pytest.skip("no vocabulary files here")
    assert tiktoken
    got = {(r.doc_id, r.tokenizer): r.n_tokens for r in rollups.token_counts(documents(spark), rollups.TOKENIZERS).collect()}
    for name, data in vocabulary.items():
        e = rollups._encoding(name, data)
        assert all(got[k, name] == len(e.encode_ordinary(t or "")) for k, t in enumerate(texts()))
    assert all(e.decode(e.encode_ordinary(t or "")) == (t or "") for t in texts())


def test_distinct_documents_without_ids_and_with_repeated_ones(spark, tmp_path):
    """Of equal texts one document stays, whatever its id; rows of other texts all stay."""
    rows = [
        (1, "a b", "s", "en", "x"), (1, "a b", "s", "en", "x"), (2, "a b", "t", "de", "x"), (None, "a b", "s", "fr", "x"), (None, "c", "s", None, "x"), (None, "c", "r", None, "x"),
        (3, "d e f", "s", "en", "x"), (3, "g", "s", "en", "x"), (None, None, None, None, "x"), (None, "", "s", None, "x"), (4, "", "u", None, "x"),
    ]
    (tmp_path / "sf").mkdir()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, hash string")
    docs.repartition(3).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens, r.n_chars) for r in op2_word_counts(spark, str(tmp_path / "sf")).collect()}
    assert got == {("s", "en"): (3, 6, 9), ("r", "und"): (1, 1, 1), ("u", "und"): (1, 0, 0)}


def test_a_batch_committed_during_a_compaction_is_not_lost(spark, tmp_path, monkeypatch):
    row = lambda k: counts(spark, [(k, "s", "en", "v1", k, 1)])
    rollup = rollups.TokenRollup(spark, str(tmp_path / "r"))
    rollup.commit("b1", rollups.inserts(row(1)))
    rollup.commit("b2", rollups.inserts(row(10)))
    write = rollups.TokenRollup._write

    def late(self, batch, changes, covers):
        monkeypatch.setattr(rollups.TokenRollup, "_write", write)
        rollup.commit("b3", rollups.inserts(row(100)))
        rollup.compact()
        write(self, batch, changes, covers)

    monkeypatch.setattr(rollups.TokenRollup, "_write", late)
    assert rollup.compact()
    assert totals(rollup) == {("s", "en", "v1"): (3, 111, 3)}
    assert rollup.commit("b4", rollups.deletes(row(10))) and rollup.compact()
    assert totals(rollup) == {("s", "en", "v1"): (2, 101, 2)}


def test_two_writers_of_one_batch_count_once(spark, tmp_path, monkeypatch):
    a = counts(spark, [(1, "s", "en", "v1", 5, 20)])
    one, two = (rollups.TokenRollup(spark, str(tmp_path / "r")) for _ in range(2))
    monkeypatch.setattr(rollups.TokenRollup, "committed", lambda self: set())  # both look before either has written
    assert one.commit("b", rollups.inserts(a)) and two.commit("b", rollups.inserts(a))
    assert totals(one) == {("s", "en", "v1"): (1, 5, 20)}


def test_vocabulary_through_spark(spark, tmp_path):
    (tmp_path / "v").write_bytes(b"QQ== 0")
    assert rollups._content(spark, f"file://{tmp_path}/v") == rollups._content(spark, str(tmp_path / "v")) == b"QQ== 0"


def least_cost(lengths, sizes):
    """Least cost of any packing, by dynamic programming over subsets."""
    n = len(lengths)
    total = [sum(x for k, x in enumerate(lengths) if m >> k & 1) for m in range(1 << n)]
    price = [next((packing.cost(c) for c in sorted(sizes) if c >= t), None) for t in total]
    best = [0.0] + [float("inf")] * ((1 << n) - 1)
    for m in range(1, 1 << n):
        low, sub = m & -m, m
        while sub:
            if sub & low and price[sub] is not None:
                best[m] = min(best[m], best[m ^ sub] + price[sub])
            sub = (sub - 1) & m
    return best[-1]


def test_cost_is_near_the_least():
    rng = random.Random(6)
    found = least = 0.0
    for _ in range(60):
        sizes = (256, 512, 1024)
        lengths = [rng.choice((rng.randint(1, 1024), rng.randint(1, 300))) for _ in range(rng.randint(1, 9))]
        got, want = packing.total_cost(packing.best_fit(lengths, sizes)), least_cost(lengths, sizes)
        assert want - 1e-6 <= got <= 1.35 * want
        found, least = found + got, least + want
    assert found <= 1.04 * least


def test_several_lengths_cost_less_than_any_one():
    rng = random.Random(7)
    draws = {"short": lambda: rng.randint(1, 200), "middling": lambda: rng.randint(150, 700), "long": lambda: min(4095, int(rng.paretovariate(0.8) * 60)), "alike": lambda: 600, "sparse": lambda: rng.choice((200, 1500, 3000))}
    for name, draw in draws.items():
        lengths = [draw() for _ in range(4000)]
        joint = packing.total_cost(packing.best_fit(lengths, packing.CAPACITIES))
        fixed = {c: packing.total_cost(packing.best_fit(lengths, (c,))) for c in packing.CAPACITIES if c >= max(lengths)}
        assert joint <= 1.001 * min(fixed.values()), (name, joint, fixed)
    assert {c for _, _, c in packing.best_fit([200] * 3 + [250], packing.CAPACITIES)} <= {256, 512, 1024}
    assert packing.best_fit([200], packing.CAPACITIES) == [(0, 0, 256)]
