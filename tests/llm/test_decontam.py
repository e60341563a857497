import hashlib
import random
import re

import pytest

from tessera.llm import decontam
from tests.llm.cases import documents, texts

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_UPPER))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add("null" if name is None else str(name))
    out = {}
    for i, text in docs:
        w = words(text)
        hit, found = [0] * len(w), set()
        for s in range(len(w)):
            for n in {len(k) for k in windows}:
                k = tuple(w[s : s + n])
                if len(k) == n and k in windows:
                    found |= windows[k]
                    hit[s : s + n] = [1] * n
        out[i] = (len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0)
    return out


def items_of(rows):
    long = rows[9]
    return [(1, " ".join(long.split()[3:18])), (20, "One, TWO"), (3, None), (4, ""), (5, "größer"), (6, " ".join(rows[10].split()[:10])), (None, " ".join(rows[11].split()[5:17])), (7, "a b c d e f"), (1, "four")]


@pytest.mark.parametrize("block", [decontam.BLOCK_CHARS, 60])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    rows = texts()
    items = items_of(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(documents(spark), bench).collect()
    want = brute(list(enumerate(rows)), items)
    assert len(got) == len(rows) + 1
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want


def test_longest_matches_and_removal(spark):
    rng = random.Random(2)
    item = [f"w{rng.randrange(50)}" for _ in range(30)]
    text = " ".join(["x"] * 7 + item[4:22] + ["y"])
    docs = documents(spark, [text, "clean text"])
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    found = {r.row.doc_id: r.matches for r in decontam.find_matches(docs, bench).collect()}
    assert [(m.item, m.start, m.end) for m in found[0]] == [("9", 7, 25)]
    left = decontam.decontaminated(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {1}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark)
    assert {r.contaminated for r in decontam.contamination(docs, none).collect()} == {False}
    assert decontam.contamination(documents(spark, []), none).count() == 0


def longest(doc, items):
    """Longest matches of doc words that hold a whole window, none inside another, by plain search."""
    out, reach = [], 0
    for p in range(len(doc)):
        best = 0
        for item in items:
            for s in range(len(item)):
                n = 0
                while p + n < len(doc) and s + n < len(item) and doc[p + n] == item[s + n]:
                    n += 1
                best = max(best, n)
        if best >= 10 and p + best > reach:
            out.append((p, p + best))
            reach = p + best
    return out


def test_longest_matches_by_plain_search(spark):
    rng = random.Random(8)
    items = [[f"w{rng.randrange(9)}" for _ in range(rng.randint(12, 40))] for _ in range(6)]
    items.append(items[0][3:20])
    rows = []
    for _ in range(40):
        text = []
        for _ in range(rng.randint(0, 4)):
            item = rng.choice(items)
            a = rng.randrange(len(item) - 5)
            text += item[a : a + rng.randint(5, 30)] + ["x"] * rng.randint(0, 2)
        rows.append(text)
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(rows)], "doc_id long, text string")
    found = {r.row.doc_id: r.matches for r in decontam.find_matches(docs, bench).collect()}
    for k, text in enumerate(rows):
        assert [(m.start, m.end) for m in sorted(found[k], key=lambda m: m.start)] == longest(text, items), k
        for m in found[k]:
            part = " ".join(text[m.start : m.end])
            assert f" {part} " in " " + " ".join(items[int(m.item)]) + " "


def test_repeated_words_take_no_product(spark):
    import tracemalloc

    import pyarrow as pa

    items = [(str(k), "a " * 1000) for k in range(50)]
    test = decontam.test_suffixes(items, 10)
    assert len(test.low) == 1 and len(test.item) == 50
    tracemalloc.start()
    counts, hits = decontam._hits_of(pa.array(["a " * 20_000, "b " + "a " * 9, "a " * 10]), test, 10)
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()
    assert counts.tolist() == [20_000, 10, 10] and set(hits) == {0, 2}
    assert hits[0][0] == [(0, 20_000)] and len(hits[0][1]) == 50
    rng = random.Random(3)
    body = " ".join(f"w{rng.randrange(10**6)}" for _ in range(decontam.BLOCK_CHARS // 8))
    tracemalloc.start()
    decontam.test_suffixes([("1", body)], 10)
    assert tracemalloc.get_traced_memory()[1] < 350e6
