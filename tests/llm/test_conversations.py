"""Conversation repair against plain search over all edits."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import conversations as c
from tessera.llm.queries import op11_conversation_repair

from .cases import DIR

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(turns):
    """(cost, audit) by relaxing (cost, audit) of every state, insertions included, turn by turn."""
    after = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
    new = {"0": "U", "S": "U", "A": "U", "U": "A"}

    def better(best, q, value):
        if q not in best or value < best[q]:
            best[q] = value

    def inserted(best):
        for _ in range(4):
            for q, (cost, audit) in list(best.items()):
                better(best, new[q], (cost + 3, audit + "I"))
        return best

    best = inserted({"0": (0, "")})
    for initial, fault in turns:
        nxt = {}
        for q, (cost, audit) in best.items():
            better(nxt, q, (cost + 4, audit + "D"))
            if fault in (c.FINE, c.TRUNCATED):
                cut = 3 if fault == c.TRUNCATED else 0
                better(nxt, new[q], (cost + 3 + cut, audit + "R"))
                if (q, initial) in after:
                    better(nxt, after[q, initial], (cost + cut, audit + "K"))
        best = inserted(nxt)
    return min(v for q, v in best.items() if q in "0A")


def everything(rows):
    """The whole contract, row by row."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if what == 0:
            convs[conv] += []
            continue
        text = "" if what == 1 else "".join(x for x in text if x not in ".!?") if what == 2 else text
        convs[conv] += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = {}
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns = set(), []
        for _, role, text in found:
            bare = text.rstrip(SPACES)
            fault = c.BLANK if not bare else c.DUPLICATE if (role, text) in seen else c.TRUNCATED if bare[-1] not in ".!?" else c.FINE
            seen.add((role, text))
            turns.append((role[:1], fault))
        cost, audit = cheapest(turns)
        numbers = [r[0] for r in found if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        kept, state, at = [], "0", 0
        for e in audit:
            if e == "I":
                state = "A" if state == "U" else "U"
                kept.append({"U": "user", "A": "assistant"}[state] + ":")
                continue
            _, role, text = found[at]
            at += 1
            if e == "R":
                state = "A" if state == "U" else "U"
                kept.append({"U": "user", "A": "assistant"}[state] + ":" + text)
            elif e == "K":
                state = role[0].upper()
                kept.append(f"{role}:{text}")
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        counts = [sum(t[1] == k for t in turns) for k in (c.BLANK, c.DUPLICATE, c.TRUNCATED)]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def test_layers_find_the_least_cost_and_audit():
    rng = random.Random(1)
    for _ in range(4000):
        turns = [(rng.choice("suuaaat"), rng.choices(range(4), (6, 2, 1, 1))[0]) for _ in range(rng.randint(0, 9))]
        assert c.least_repair(turns) == cheapest(turns), turns
    long = [(rng.choice("ssuat"), rng.choice((0, 0, 1, 2))) for _ in range(3000)]
    assert c.least_repair(long) == cheapest(long)
    junk_then_system = [("t", c.BLANK)] * 500 + [("s", c.FINE), ("u", c.FINE), ("a", c.FINE)]
    assert c.least_repair(junk_then_system) == (2000, "D" * 500 + "KKK")


def test_repair_takes_linear_time_and_few_bytes():
    turns = [("u", c.FINE), ("a", c.TRUNCATED), ("u", c.BLANK)] * 40_000
    cost, audit = c.least_repair(turns)
    assert audit == "KKD" * 40_000 and cost == 7 * 40_000


def test_query_equals_plain_search(spark):
    rows = spark.read.parquet(f"{DIR}/conversations.parquet")
    want = everything([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    out = op11_conversation_repair(spark, DIR)
    assert found(out) == want
    assert dict(out.dtypes) | {"audit": "string"} == {"conv_id": "bigint", **dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], "bigint"), "audit": "string", "repaired_sha256": "string"}


@pytest.mark.parametrize("seed", range(3))
def test_nulls_ties_and_repeated_rows(spark, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "well", " ", "", None, "é\n?  ", "a\x85", "x" * 100_000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "usher"]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(-3, 6)]), rng.choice(roles), rng.choice(texts)) for _ in range(600)]
    assert found(c.faults_and_repair(spark.createDataFrame(rows, SCHEMA))) == everything(rows)


def test_one_conversation_of_most_rows_empty_table_and_clashing_columns(spark):
    rows = [(7 if i % 3 else i, i, ("user", "assistant")[i % 2], f"Turn {i % 50}.") for i in range(9000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("x")).withColumn("gone", F.lit(1)).withColumn("cost", F.lit("c"))
    assert found(c.faults_and_repair(df)) == everything(rows)
    assert c.faults_and_repair(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(c.faults_and_repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_spans_of_turn_numbers_beyond_a_long(spark):
    conv = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{t}".encode()) % 20 > 4 for t in (-(2**63), 2**63 - 1)))
    rows = [(conv, -(2**63), "user", "Hi."), (conv, 2**63 - 1, "assistant", "Yes.")]
    assert found(c.faults_and_repair(spark.createDataFrame(rows, SCHEMA)))[conv][0] == 2**63 - 1
