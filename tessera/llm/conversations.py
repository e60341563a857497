"""Repair of conversation structure at least cost, by layers of cost over bitsets of grammar states.

Legal role initials are (s?(ua)+)?: four states, nothing read (0), system read (1), user read (2),
assistant read (3); 0 and 3 accept. For every turn, from the last to the first, one integer holds the
layers of increasing cost, four bits a layer: bit q of layer c is set if an accepted end can be reached
from state q with cost c. An edit of cost k moves a set up by k layers, that is a shift by 4 * k bits.
The first layer with state 0 before the first turn is the least cost, and following the bits forward,
least letter first, gives the least audit. All states' least costs lie within twelve layers of each other
(two insertions lead from any state to where another is, a deletion past what only the start can
take), so a base and sixteen layers a turn lose nothing, and time and memory are linear in the turns.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: What is wrong with a turn, in the order in which it is looked for.
FINE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3
_KEEP, _REROLE, _DELETE, _INSERT, _CUT = 0, 3, 4, 3, 3
_LAYERS = (1 << 64) - 1
_SYSTEM, _USER, _ASSISTANT = (int("".join(["1" if q == s else "0" for q in (3, 2, 1, 0)] * 16), 2) for s in (1, 2, 3))


def _back_user(w: int) -> int:
    """The states from which a user turn leads into the states of w, layer by layer."""
    w &= _USER
    return w >> 2 | w >> 1 | w << 1


def _back_assistant(w: int) -> int:
    return (w & _ASSISTANT) >> 1


def _back_system(w: int) -> int:
    return (w & _SYSTEM) >> 1


def _nothing(_: int) -> int:
    return 0


_BACK = {"s": _back_system, "u": _back_user, "a": _back_assistant}
#: The state after a kept turn, by state and role initial; after a rerole or insertion by state.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_NEXT = {0: 2, 1: 2, 3: 2, 2: 3}
_ROLE = {2: "user", 3: "assistant"}


def _settled(w: int) -> int:
    """w with insertions: twice, as a third would only repeat a state at a higher cost."""
    for _ in range(2):
        w |= (_back_user(w) | _back_assistant(w)) << 4 * _INSERT
    return w & _LAYERS


def _layers(turns: list[tuple[str, int]]) -> tuple[array, array]:
    """Bases and layers before every turn and after the last: the cost of layer c is base + c."""
    w, base = _settled(0b1001), 0
    bases, words = array("q", [base]), array("Q", [w])
    for initial, fault in reversed(turns):
        made = w << 4 * _DELETE
        if fault in (FINE, TRUNCATED):
            cut = _CUT if fault == TRUNCATED else 0
            made |= _BACK.get(initial, _nothing)(w) << 4 * (_KEEP + cut) | (_back_user(w) | _back_assistant(w)) << 4 * (_REROLE + cut)
        w = _settled(made)
        while not w & 0xF:
            w >>= 4
            base += 1
        bases.append(base)
        words.append(w)
    return bases[::-1], words[::-1]


def least_repair(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """The least cost of making turns (role initial, fault) legal, and the least audit of that cost.

    The audit has one letter for each edit in order: K keep, R rerole, D delete, I insert.
    """
    bases, words = _layers(turns)

    def reached(j: int, q: int, cost: int) -> bool:
        return cost >= bases[j] and bool(words[j] >> (4 * (cost - bases[j]) + q) & 1)

    cost = next(bases[0] + c for c in range(16) if words[0] >> 4 * c & 1)
    left, j, q, audit = cost, 0, 0, []
    while j < len(turns) or left:
        initial, fault = turns[j] if j < len(turns) else ("", BLANK)
        more, stays = j < len(turns), fault in (FINE, TRUNCATED)
        cut = _CUT if fault == TRUNCATED else 0
        kept = _AFTER.get((q, initial))
        if more and reached(j + 1, q, left - _DELETE):
            audit.append("D")
            left, j = left - _DELETE, j + 1
        elif reached(j, _NEXT[q], left - _INSERT):
            audit.append("I")
            left, q = left - _INSERT, _NEXT[q]
        elif more and stays and kept is not None and reached(j + 1, kept, left - _KEEP - cut):
            audit.append("K")
            left, j, q = left - _KEEP - cut, j + 1, kept
        else:
            audit.append("R")
            left, j, q = left - _REROLE - cut, j + 1, _NEXT[q]
    return cost, "".join(audit)


@lru_cache(maxsize=50_000)
def _short_repair(turns: tuple[tuple[str, int], ...]) -> tuple[int, str]:
    return least_repair(list(turns))


class RepairedText:
    """SHA-256 of a repaired conversation, turn by turn: role:text of what is kept, joined by newlines."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.empty, self.sha = audit, 0, 0, True, hashlib.sha256()

    def _add(self, role: str, text: str) -> None:
        self.sha.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = _NEXT[self.state]
            self._add(_ROLE[self.state], "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _AFTER[self.state, role[:1]]
            self._add(role, text)
        elif edit == "R":
            self.state = _NEXT[self.state]
            self._add(_ROLE[self.state], text)

    def digest(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) after damage by crc32 of conv_id:turn modulo 20; null roles and texts are one space.

    0 drops the row (it stays as a marker with gone set, so that its conversation is known), 1 empties the
    text, 2 removes its marks of sentence ends, 3 repeats the row, 4 makes its role user.
    """
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    what = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    one = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(what == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(what <= 1, F.lit("")).when(what == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (what == 0).alias("gone"),
        F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return one.drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """rows with their first fault; rows are spread by conv_id already, so that finding duplicates deals nothing anew."""
    bare = F.expr(f"rtrim('{_SPACES}', text)")
    again = F.expr("row_number() over (partition by conv_id, role, text, gone order by turn) > 1")
    end = F.right(bare, F.lit(1)).isin(".", "!", "?")
    return rows.withColumn("fault", F.when(bare == "", BLANK).when(again, DUPLICATE).when(~end, TRUNCATED).otherwise(FINE).cast("byte"))


class _Facts:
    """What is counted of one conversation; five small numbers and one entry a turn."""

    def __init__(self, conv: object) -> None:
        self.conv, self.turns, self.low, self.high, self.distinct = conv, [], None, None, 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None:  # in rising order
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        self.turns.append(_TURNS.setdefault((initial, fault), (initial, fault)))

    def row(self) -> tuple:
        turns = self.turns
        cost, audit = _short_repair(tuple(turns)) if len(turns) <= 24 else least_repair(turns)
        found = [sum(t[1] == k for t in turns) for k in (BLANK, DUPLICATE, TRUNCATED)]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, 2**63 - 1)
        return self.conv, gaps, *found, illegal, cost, audit


_TURNS: dict[tuple[str, int], tuple[str, int]] = {}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of sorted rows (conv, conv_key, turn, initial, fault, gone)."""
    now, key, kind = None, None, None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    for batch in batches:
        kind, done = batch.column("conv_id").type, []
        for conv, k, turn, initial, fault, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or k != key:
                done += [now.row()] if now else []
                now, key = _Facts(conv), k
            if not gone:
                now.add(turn, initial, fault)
        if done:
            yield made(done)
    if now:
        yield made([now.row()])


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation: rows come sorted, a conversation's counts (role null) before its turns."""
    head, text = None, None
    for batch in batches:
        kinds, done = batch.schema, []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[1] is None:
                done += [(*head, text.digest())] if head else []
                head, text = (row[0], *row[3:]), RepairedText(row[-1])
            else:
                text.turn(row[1], row[2])
        if done:
            yield _hash_batch(done, kinds)
    if head:
        yield _hash_batch([(*head, text.digest())], kinds)


def _hash_batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns, names = list(zip(*rows, strict=True)), ["conv_id", *_COUNTS]
    arrays = [pa.array(c, kinds.field(n).type) for c, n in zip(columns, names, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[-1], pa.string())], names=[*names, "repaired_sha256"])


def repaired(rows: DataFrame) -> DataFrame:
    """Counts of faults, cost, audit and hash of every conversation's least repair; rows are (conv_id, turn, role, text, gone).

    Turns are taken in the order of turn (nulls first), then role, then text; null conversations are one
    conversation. A conversation of which all turns are gone has zeros, an empty audit and the hash of the
    empty text. Turns are streamed in order twice: first what is wrong with them, which gives the audit,
    then their texts past that audit, so a task holds a few bytes for each turn of one conversation
    and never its texts. Other columns play no part; an empty table gives no rows.
    """
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("conv_id", "turn", "role", "text", "gone")
    ordered = _faults(rows.repartition(spread, "conv_id")).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    light = ordered.select("conv_id", F.col("conv_id").cast("string").alias("conv_key"), "turn", F.left("role", F.lit(1)).alias("initial"), "fault", "gone")
    counts = StructType([rows.schema["conv_id"], *StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")])
    heads = light.mapInArrow(_counted, counts)
    texts = rows.filter("not gone").select("conv_id", "role", "text", "turn", *(F.lit(None).cast(counts[c].dataType).alias(c) for c in _COUNTS))
    both = heads.select("conv_id", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("turn"), *_COUNTS).unionByName(texts)
    both = both.repartition(spread, "conv_id").sortWithinPartitions("conv_id", F.col("role").isNotNull(), F.asc_nulls_first("turn"), "role", "text")
    return both.select("conv_id", "role", "text", *_COUNTS).mapInArrow(_hashed, StructType([*counts, *StructType.fromDDL("repaired_sha256 string")]))


def faults_and_repair(rows: DataFrame) -> DataFrame:
    """What the damaged conversations of a table (conv_id, turn, role, text) need; see damaged and repaired."""
    return repaired(damaged(rows))
