import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import langid, quality
from tests.llm.cases import documents, sentence


def labelled(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(240):
        good = k % 3 > 0
        rows.append(sentence(rng, rng.randint(20, 60)) if good else " ".join(w.upper() + "$$!" for w in sentence(rng, rng.randint(20, 60)).split()))
        labels.append((k, int(good)))
    rows += [None, "", "x"]
    labels += [(0, 1), (None, 0), (1, None)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), rows


def test_quality_separates_held_out_labels(spark):
    docs, labels, rows = labelled(spark)
    model = quality.fit(docs, labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in quality.scored(docs, model, carry=["doc_id"]).select("row.doc_id", "score").collect()}
    assert len(got) == len(rows)
    assert all(0 <= s <= 1 for s in got.values())
    held = [k for k in range(240) if k % 5 == 0]
    assert sum((got[k] >= 0.5) == (k % 3 > 0) for k in held) / len(held) > 0.95


def test_a_line_under_both_labels_decides_nothing(spark):
    docs, labels, rows = labelled(spark)
    line = sentence(random.Random(5), 12)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("\n" + line))).otherwise(F.col("text")))
    model = quality.fit(docs, labels, F.lit(True))
    assert model.good and model.bad
    assert line.encode() not in model.good and line.encode() not in model.bad


def test_calibration_reaches_its_optimum():
    rng = np.random.default_rng(1)
    for n in (200, 5000):
        a, b = rng.normal(0.05, 0.01, n), rng.normal(6, 1, n)
        x = np.stack([np.ones(n), a, a * b, 0.3 + a, (0.3 + a) ** 2, b], axis=1)
        y = (rng.random(n) < 1 / (1 + np.exp(-(400 * (a - 0.04))))).astype(float)
        w = quality._logistic(x, y)
        p = 1 / (1 + np.exp(-(x @ w)))
        assert abs((p - y).sum()) < 0.5
        assert abs(((p - y) * a).sum()) < 0.05 and abs(((p - y) * b).sum()) < 2


def test_quality_of_no_labels_and_no_documents(spark):
    docs, labels, _ = labelled(spark)
    model = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.scored(docs, model).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_scores_keep_rows_and_columns(spark):
    docs, labels, _ = labelled(spark)
    out = quality.scored(docs, quality.fit(docs, labels, F.lit(True)))
    assert out.select("row.*").columns == docs.columns
    assert out.select("row.*").exceptAll(docs).count() == 0


def longest_match_parse(text, sample):
    """Phrases of the text in pieces, by plain substring search."""
    count = 0
    for s in range(0, len(text), langid.PIECE):
        piece, i = text[s : s + langid.PIECE], 0
        while i < len(piece):
            j = i + 1
            while j < len(piece) and piece[i : j + 1] in sample:
                j += 1
            i, count = j, count + 1
    return count


def test_phrases_match_plain_search():
    rng = random.Random(7)
    samples = {"a": sentence(rng, 200), "b": sentence(random.Random(8), 200).replace("a", "z")}
    model = langid.build(samples)
    texts = [langid.squeezed(sentence(rng, n)) for n in (1, 5, 90, 300)] + ["zzz ab zq"]
    got = langid.phrases(texts, model)
    want = [[longest_match_parse(t, langid.squeezed(samples[k])) for k in model.names] for t in texts]
    assert (got == np.array(want)).all()


def test_languages(spark):
    rng = random.Random(9)
    words = {"aa": "der die das und nicht ist ein mit".split(), "bb": "the of and to in is that it".split()}
    rows = [" ".join(rng.choice(words[k]) for _ in range(30)) for k in ("aa", "bb") * 20]
    docs = documents(spark, [*rows, None, "", "123 ²!", "  "]).withColumn("lang", F.when(F.col("doc_id") < 40, F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")))
    model = langid.build(langid.sample(docs, F.col("doc_id") % 4 != 2))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model, carry=["doc_id"]).select("row.doc_id", "lang_pred", "score").collect()}
    assert all(got[k][0] == ("aa", "bb")[k % 2] for k in range(40))
    assert {got[k] for k in range(40, 44)} == {("und", 0.0)}
    none = langid.build(langid.sample(docs, F.lit(False)))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def scripts(rng):
    """Sample words of languages in several scripts, some sharing theirs."""
    pick = lambda lo, hi, n: ["".join(chr(rng.randint(lo, hi)) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    han = pick(0x4E00, 0x5200, 500)
    return {
        "ar": pick(0x0627, 0x063A, 300), "el": pick(0x03B1, 0x03C9, 300), "en": "the of and to in is that it was for".split(), "ja": pick(0x3041, 0x3096, 300) + han[:200],
        "ko": pick(0xAC00, 0xB200, 500), "ru": pick(0x0430, 0x044F, 300), "uk": pick(0x0430, 0x045F, 300), "zh": han[200:],
    }


def test_every_letter_of_the_samples_can_match():
    rng = random.Random(11)
    words = scripts(rng)
    text = lambda k, n: langid.squeezed(" ".join(rng.choice(words[k]) for _ in range(n)))
    samples = {k: text(k, 900) for k in words}
    model = langid.build(samples)
    texts = [text(k, n) for k in words for n in (1, 40, 300)] + [text("zh", 30) + " " + text("en", 30), "\U0001e900\U0001e901 abc"]
    want = [[longest_match_parse(t, samples[k]) for k in model.names] for t in texts]
    assert (langid.phrases(texts, model) == np.array(want)).all()


def test_many_scripts_side_by_side(spark):
    rng = random.Random(12)
    words = scripts(rng)
    rows = [" ".join(rng.choice(words[k]) for _ in range(60)) for k in words for _ in range(12)]
    names = [k for k in words for _ in range(12)]
    docs = spark.createDataFrame([(k, t, names[k]) for k, t in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.build(langid.sample(docs, F.col("doc_id") % 4 != 2))
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model, carry=["doc_id"]).select("row.doc_id", "lang_pred").collect()}
    assert [got[k] for k in range(len(rows))] == names
