"""Language identification by cross-parsing entropy.

A suffix automaton of sample text per language answers how long the text at hand can be read
as a substring of the sample. Reading a text greedily in longest matches cuts it into phrases;
the language with the fewest phrases a letter wins.

An automaton's transitions lie in one array, each state's row shifted so that no two entries meet
(row displacement): of any alphabet, a few bytes for each letter of the sample, and one numpy step
advances many pieces of text at once. A text is parsed in pieces of fixed length, a border costing
every language the same.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import mapped

#: Sample documents for each language and characters of them, at most. Documents are taken whole.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 40_000
#: Cost of one phrase more in the score, in nats: phrases of one text are not independent, so far less than a back reference's.
PHRASE_COST = 2.0
#: Characters parsed as one piece, and characters of all pieces in flight.
PIECE, FLIGHT = 256, 2_000_000
UNKNOWN = "und"


def automaton(text: str) -> tuple[list[dict[str, int]], int]:
    """Transitions of the suffix automaton of the text (online construction); state 0 is the root."""
    go: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for ch in text:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and ch not in go[p]:
            go[p][ch] = cur
            p = link[p]
        if p >= 0:
            q = go[p][ch]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(ch) == q:
                    go[p][ch] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go, len(go)


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def squeezed(text: str) -> str:
    """Lower case, with every run of non-letters as one space; empty if there is no letter."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


@dataclass
class Automaton:
    """Transitions of a language: from state x by letter c to to[base[x] + c] if check[base[x] + c] is x.

    letters are the code points of the sample, c - 1 their place in it (0: not in the sample); root
    has the states after one letter, the last state for a letter that the sample lacks.
    """

    letters: np.ndarray
    base: np.ndarray
    check: np.ndarray
    to: np.ndarray
    root: np.ndarray


def packed(text: str) -> Automaton:
    """Suffix automaton of a squeezed text with its rows shifted into one array."""
    letters = sorted(set(text))
    number = {c: k + 1 for k, c in enumerate(letters)}
    go, count = automaton(text)
    width = len(letters) + 1
    base, check, to = np.zeros(count + 1, dtype=np.int64), [-1] * (2 * width), [0] * (2 * width)
    low = last = width  # no free place before low, none taken behind last
    for state in sorted(range(count), key=lambda x: -len(go[x])):
        edges = sorted((number[c], x) for c, x in go[state].items())
        if not edges:
            break
        while check[low] >= 0:
            low += 1
            if low + width >= len(check):
                check += [-1] * (len(check) + width)
                to += [0] * (len(to) + width)
        # rows with several letters go near the end, those with one then fill the holes
        place = low if len(edges) == 1 else max(low, last - 32)
        while True:
            at = place - edges[0][0]
            if at + width >= len(check):
                check += [-1] * (len(check) + width)
                to += [0] * (len(to) + width)
            if all(check[at + c] < 0 for c, _ in edges):
                break
            place += 1
        base[state] = at
        for c, x in edges:
            check[at + c], to[at + c] = state, x
        last = max(last, at + edges[-1][0])
    root = np.full(width, count, dtype=np.uint32)
    for c, x in go[0].items():
        root[number[c]] = x
    size = int(base.max()) + width + 1
    return Automaton(np.array([ord(c) for c in letters], dtype=np.int32), base.astype(np.int32), np.array(check[:size], dtype=np.int32), np.array(to[:size], dtype=np.uint32), root)


@dataclass
class LanguageModel:
    """names; number of a code point among the letters of all samples (0: in none); by language its automaton
    and the letter in it of each such number."""

    names: list[str]
    letters: np.ndarray
    symbols: list[np.ndarray]
    automata: list[Automaton]


def model_of(automata: dict[str, Automaton]) -> LanguageModel:
    """Model of the languages' automata."""
    names = sorted(automata)
    known = np.unique(np.concatenate([automata[k].letters for k in names])) if names else np.zeros(0, np.int32)
    letters = np.zeros(0x110000, dtype=np.uint32)
    letters[known] = np.arange(1, len(known) + 1)
    symbols = []
    for k in names:
        symbol = np.zeros(len(known) + 1, dtype=np.uint32)
        symbol[letters[automata[k].letters]] = np.arange(1, len(automata[k].letters) + 1)
        symbols.append(symbol)
    return LanguageModel(names, letters, symbols, [automata[k] for k in names])


def build(samples: dict[str, str]) -> LanguageModel:
    """Model from sample text by language."""
    return model_of({k: packed(squeezed(t)) for k, t in samples.items()})


def phrases(texts: list[str], model: LanguageModel) -> np.ndarray:
    """Phrases (texts x languages) in which each whole normalised text is parsed."""
    codes, owner_of, sizes = [], [], []
    for k, text in enumerate(texts):
        code = model.letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        codes.append(code)
        n = -(-len(code) // PIECE)
        owner_of.append(np.full(n, k))
        sizes.append(np.minimum(PIECE, len(code) - PIECE * np.arange(n)))
    flat, owner, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (codes, owner_of, sizes))
    out = np.zeros((len(texts), len(model.names)), dtype=np.int64)
    start = np.cumsum(size) - size
    # pieces by falling size, so that those still being read are a prefix
    order = np.argsort(-size, kind="stable")
    start, owner, size = start[order], owner[order], size[order]
    alive = np.searchsorted(-size, -np.arange(PIECE), side="left")
    for lang, (symbol, held) in enumerate(zip(model.symbols, model.automata, strict=True)):
        own = symbol[flat]
        state = held.root[own[start]] if len(start) else np.zeros(0, np.uint32)
        count = np.ones(len(start), dtype=np.int64)
        for step in range(1, PIECE):
            n = int(alive[step])
            if not n:
                break
            letter, now = own[start[:n] + step], state[:n]
            at = held.base[now] + letter
            on = held.check[at] == now
            state[:n] = np.where(on, held.to[at], held.root[letter])
            count[:n] += ~on
        out[:, lang] = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
    return out


def _taken(texts: list[str]) -> str:
    """Whole texts in order as long as they fit; of none that fits, pieces from all over the first."""
    taken, size = [], 0
    for text in texts:
        if size + len(text) + 1 <= SAMPLE_CHARS and text:
            taken.append(text)
            size += len(text) + 1
    if not taken and texts:
        n = SAMPLE_CHARS // 400
        taken = [texts[0][k * len(texts[0]) // n :][:399] for k in range(n)]
    return " ".join(taken)


def _picked(docs: DataFrame, keep: Column, text_col: str, lang_col: str) -> DataFrame:
    """(lang, h, text): of each hash class of ids, the document with the least hash among those short enough to fit with others, or else among all.

    Up to SAMPLE_DOCS documents for each language; the least hashes are found with a map-side
    minimum, so no language is gathered in one place.
    """
    base = docs.select("doc_id", F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")).filter(keep & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    hashed = base.withColumn("h", F.struct((F.length("text") > SAMPLE_CHARS // 4).alias("long"), F.xxhash64("doc_id").alias("hash"))).withColumn("g", F.pmod("h.hash", F.lit(SAMPLE_DOCS)))
    least = hashed.groupBy("lang", "g").agg(F.min("h").alias("h")).select("lang", "h")
    # at most SAMPLE_DOCS rows a language, a small fixed number of languages
    return hashed.select("lang", "h", "text").join(F.broadcast(least), ["lang", "h"]).select("lang", "h.long", "h.hash", "text")


def sample(docs: DataFrame, keep: Column, *, text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Sample text by language, at most SAMPLE_CHARS characters each."""

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        texts = frame.sort_values(["long", "hash", "text"])["text"]
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "text": [_taken([squeezed(t) for t in texts])]})

    return {r.lang: r.text for r in _picked(docs, keep, text_col, lang_col).groupBy("lang").applyInPandas(cut, "lang string, text string").collect()}


def fit(docs: DataFrame, keep: Column, *, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Model from the rows that keep allows; each language's automaton is built in a task and takes about a megabyte."""
    fields = ("letters", "base", "check", "to", "root")

    def made(frame: pd.DataFrame) -> pd.DataFrame:
        texts = frame.sort_values(["long", "hash", "text"])["text"]
        held = packed(_taken([squeezed(t) for t in texts]))
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], **{f: [getattr(held, f).tobytes()] for f in fields}})

    rows = _picked(docs, keep, text_col, lang_col).groupBy("lang").applyInPandas(made, "lang string, " + ", ".join(f"{f} binary" for f in fields)).collect()
    kinds = {"letters": np.int32, "base": np.int32, "check": np.int32, "to": np.uint32, "root": np.uint32}
    return model_of({r.lang: Automaton(*(np.frombuffer(r[f], dtype=kinds[f]) for f in fields)) for r in rows})


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of docs (struct row) with lang_pred and score.

    score is the softmax share of the winner when each phrase costs PHRASE_COST; near 1 when no
    other language parses the text nearly as well. A text that is null
    or has no letter is "und" with score 0; ties go to the first language by name; without any
    language every text is "und".
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: pa.StructArray) -> list[pa.Array]:
        model = held.value
        texts = [t or "" for t in pc.struct_field(rows, [text_col]).cast(pa.string()).to_pylist()]
        names, scores = [], []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= FLIGHT):
                chars += len(texts[end])
                end += 1
            clean = [squeezed(t) for t in texts[at:end]]
            counts = phrases(clean, model)
            for k, text in enumerate(clean):
                if not any(map(str.isalpha, text)) or not model.names:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                row = counts[k].astype(float)
                best = int(np.argmin(row))
                names.append(model.names[best])
                scores.append(float(1 / np.exp(-(row - row[best]) * PHRASE_COST).sum()))
            at = end
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return mapped(docs, run, "lang_pred string, score double", list(docs.columns) if carry is None else carry)
