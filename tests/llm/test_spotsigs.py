import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import spotsigs
from tests.llm.cases import documents, sentence, texts

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def signatures(text):
    text = text or ""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(_UPPER))
    if len(text) >= spotsigs.UNSPACED * max(len(w), 1):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", text.translate(_UPPER))
    chains = []
    for i, x in enumerate(w):
        if x in spotsigs.ANCHORS:
            after = [y for y in w[i + 1 : i + 1 + spotsigs.REACH] if y not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(after) == spotsigs.CHAIN:
                chains.append(f"{x}:{' '.join(after)}")
    if not chains or len(chains) * spotsigs.SPARSE < len(w):
        chains = [f"{w[i]}:{w[i + 1]} {w[i + 2]}" for i in range(len(w) - 2)] or [text]
    return sorted({hashlib.md5(c.encode()).hexdigest()[:8] for c in chains})


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


@pytest.mark.parametrize("blocks", [2, 7, 300])
def test_edited_texts_match_brute_force(spark, blocks):
    rows = [(k, t) for k, t in enumerate(texts())]
    docs = documents(spark).dropDuplicates(["doc_id"]).repartition(5)
    got = {r.doc_id: r for r in spotsigs.edited_likeness(docs, blocks=blocks).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t = t or ""
        nxt = rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, b, c = signatures(t), signatures(edited), signatures(nxt)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (" ".join(a), " ".join(b))
        assert r.near_edited == pytest.approx(jaccard(a, b)) and r.near_next == pytest.approx(jaccard(a, c))


def test_one_row_repeated_rows_null_ids_and_none(spark):
    kind = "doc_id long, text string, fingerprint string"
    one = spotsigs.edited_likeness(spark.createDataFrame([(7, "the cat sat on the mat today", "x")], kind)).collect()
    assert [r.near_next for r in one] == [1.0]
    some = spark.createDataFrame([(None, "a b c d", ""), (1, "p q r", ""), (1, "p q r", ""), (None, None, "")], kind)
    rows = spotsigs.edited_likeness(some).collect()
    assert len(rows) == 4 and sum(r.doc_id is None for r in rows) == 2
    assert spotsigs.edited_likeness(some.limit(0)).count() == 0


def test_similar_pairs_match_brute_force(spark):
    import random

    rng = random.Random(4)
    base = [sentence(rng, 60) for _ in range(6)]
    rows = []
    for t in base:
        w = t.split()
        for _ in range(6):
            v = list(w)
            for _ in range(rng.randint(0, 4)):
                v[rng.randrange(len(v))] = sentence(rng, 1)
            rows.append(" ".join(v[: rng.randint(45, 60)]))
    prints = spotsigs.with_fingerprint(spark.createDataFrame(list(enumerate(rows)), "id long, text string"), "text", "fingerprint")
    first = {}
    for k, t in enumerate(rows):
        first.setdefault(" ".join(signatures(t)), k)
    sets = {k: s.split() for s, k in first.items()}
    for threshold in (0.5, 0.75):
        want = {(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= threshold}
        got = {(r.a, r.b): r.likeness for r in spotsigs.similar_pairs(prints.select("id", "fingerprint"), threshold).collect()}
        assert set(got) == want
        assert all(v == pytest.approx(jaccard(sets[a], sets[b])) for (a, b), v in got.items())


def test_the_plan_has_no_python(spark):
    plan = spotsigs.edited_likeness(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert F.col("x") is not None


def test_other_languages_are_told_by_all_their_words(spark):
    russian = "мама мыла раму и пела песню о весне пока дети спали в доме у реки где росли старые ивы " * 4
    other = "кошка спит на окне и видит сон про рыбу что живёт в пруду за старой мельницей на краю села " * 4
    quote = " as the saying of the wise men goes "
    chinese, changed = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕高歌"
    rows = [russian + quote, other + quote, russian.replace("весне", "зиме") + quote, chinese, changed, "天地"]
    prints = spotsigs.with_fingerprint(spark.createDataFrame(list(enumerate(rows)), "id long, text string"), "text", "fingerprint")
    got = {r.id: r.fingerprint.split() for r in prints.collect()}
    assert [got[k] for k in range(6)] == [signatures(t) for t in rows]
    assert jaccard(got[0], got[1]) < 0.2 and jaccard(got[0], got[2]) > 0.5 and jaccard(got[3], got[4]) > 0.6


def test_similar_documents(spark):
    docs = documents(spark, [*texts(), texts()[9]])
    got = [(r.doc_id, r.class_id, r.n_links) for r in spotsigs.similar_documents(docs).collect()]
    assert len(got) == docs.count()
    rows = [*texts(), texts()[9]]
    sets = [signatures(t) for t in rows]
    first = [min(k for k, s in enumerate(sets) if s == mine) for mine in sets]
    links = [sum(jaccard(mine, sets[k]) >= 0.75 for k in set(first) if sets[k] != mine) for mine in sets]
    assert set(got) == {(k, first[k], links[k]) for k in range(len(rows))}
    some = spark.createDataFrame([(None, "a b c d")], "doc_id long, text string")
    assert [tuple(r) for r in spotsigs.similar_documents(some).collect()] == [(None, None, 0)]
    assert spotsigs.similar_documents(some.limit(0)).count() == 0
