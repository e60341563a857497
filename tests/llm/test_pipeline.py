import random

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.cases import DOCS, sentence


def test_each_stage_takes_effect(spark, tmp_path):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(300):
        good = k % 4 > 0
        rows.append(sentence(rng, rng.randint(30, 60)) if good else " ".join(w.upper() + "$$!" for w in sentence(rng, rng.randint(30, 60)).split()))
        labels.append((k, int(good), 0))
    item = sentence(rng, 25)
    rows += [rows[1], rows[2] + " more", "x y z " + item + " end", "write to me.too@mail.example.com " + sentence(rng, 40), None, ""]
    data = [(k, t, "en", "s", len(t or ""), "a", "b", "c", "d", "e") for k, t in enumerate(rows)]
    spark.createDataFrame(data, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    good = {k for k in range(300) if k % 4}
    assert len(good - left["quality"]) <= 5 and len(left["quality"] & (set(range(300)) - good)) <= 5
    assert left["near_duplicates"] == left["quality"] - {300, 301}
    assert left["decontamination"] == left["near_duplicates"] - {302}
    assert left["personal_data"] == left["decontamination"]
    assert "[EMAIL]" in docs.filter("doc_id = 303").first().text
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == left["personal_data"]
    assert packed.agg(F.sum("n_tokens")).first()[0] == sum(len((r.text or "").split()) for r in docs.collect())


def test_repeated_rows_and_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None), (None, "q")], "doc_id long, text string")
    got = sorted(corpus_pipeline.without_near_duplicates(spark, docs, "").collect(), key=str)
    assert [(r.doc_id, r.text) for r in got] == [(1, "a b c d e f"), (3, None), (None, "q")]
    assert corpus_pipeline.without_near_duplicates(spark, docs.limit(0), "").count() == 0
