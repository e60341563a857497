"""Benchmark decontamination by suffix arrays of the training text.

Each task sorts the word suffixes of its documents into a suffix array and binary-searches every
distinct test window in it. All occurrences give the hit words and the matched items. Where there
are any, the hit words and the items they meet are sorted once more as whole suffixes, and common
prefixes of neighbours give the longest verbatim matches with their places.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import mapped
from .textnum import ALNUM, pieces, utf8, words

#: Words of a window.
WINDOW = 10
#: Benchmark characters that are broadcast at once; a larger benchmark goes in several blocks.
BLOCK_CHARS = 4_000_000
#: Bytes of text in one suffix array.
SHARD_BYTES = 2_000_000


@dataclass
class TestSuffixes:
    """Distinct test windows in order; `low` and `high` bound all suffixes that start with the window."""

    vocabulary: np.ndarray  # sorted word hashes; word number = place + 1
    low: np.ndarray
    high: np.ndarray
    length: np.ndarray
    owner: np.ndarray  # items that have window w: item[owner[w]:owner[w + 1]]
    item: np.ndarray
    names: list[str]
    words: np.ndarray  # word numbers of all items in a row; item k has words[first[k]:first[k + 1]]
    first: np.ndarray
    least: np.ndarray  # by word number: the shortest window that starts with the word


def _keys(numbers: np.ndarray, width: int) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    return np.ascontiguousarray(numbers.astype(">u4")).view(f"S{4 * width}").reshape(-1)


def test_suffixes(items: list[tuple[str, str]], window: int) -> TestSuffixes | None:
    """Windows of the items (name, text); None if no item has words. Takes some 100 bytes a word at most."""
    items = sorted(items)
    raw, offsets = utf8(pa.array([t for _, t in items], pa.string()))
    w = words(raw, offsets, ALNUM)
    if not len(w.hashes):
        return None
    vocabulary, number = np.unique(w.hashes, return_inverse=True)
    number = (number + 1).astype(np.uint32)
    sizes = np.diff(w.first)
    item = np.repeat(np.arange(len(items), dtype=np.int32), sizes)
    left = np.repeat(w.first[1:], sizes) - np.arange(len(number))  # words from each place to the end of its item
    whole = np.minimum(sizes, window)[item]
    starts = np.flatnonzero((left >= window) | (left == sizes[item]))
    length = whole[starts].astype(np.int32)
    padded = np.concatenate((number, np.zeros(window, dtype=np.uint32)))
    rows = np.empty((len(starts), window), dtype=">u4")
    for k in range(window):
        rows[:, k] = np.where(k < length, padded[starts + k], 0)
    low = rows.view(f"S{4 * window}").reshape(-1)
    # equal windows are one, whatever items they stand in
    order = np.lexsort((item[starts], length, low)) if len(low) else np.zeros(0, np.int64)
    low, length, item = low[order], length[order], item[starts][order]
    fresh = np.concatenate(([True], (low[1:] != low[:-1]) | (length[1:] != length[:-1])))
    again = ~fresh & np.concatenate(([False], item[1:] == item[:-1]))
    at = np.flatnonzero(fresh)
    owner = np.concatenate((np.cumsum(~again)[at] - 1, [int((~again).sum())]))
    low, length = low[at], length[at]
    high = np.ascontiguousarray(low).view(">u4").reshape(-1, window).copy()
    high[np.arange(window) >= length[:, None]] = 0xFFFFFFFF
    least = np.full(len(vocabulary) + 1, 1 << 40, dtype=np.int64)
    np.minimum.at(least, np.ascontiguousarray(low).view(">u4").reshape(-1, window)[:, 0].astype(np.int64), length.astype(np.int64))
    return TestSuffixes(vocabulary, low, high.view(f"S{4 * window}").reshape(-1), length, owner, item[~again], [n for n, _ in items], number, w.first, least)


def _numbers(w, test: TestSuffixes) -> np.ndarray:
    """Word numbers of the texts, 0 for words that no test item has."""
    place = np.minimum(np.searchsorted(test.vocabulary, w.hashes), len(test.vocabulary) - 1)
    return np.where(test.vocabulary[place] == w.hashes, place + 1, 0)


def _occurrences(w, number: np.ndarray, test: TestSuffixes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and distinct test windows that occur there, by binary search in the suffix array.

    A position has at most one window of each length, so these are at most `window` times the positions.
    """
    n = len(w.hashes)
    # words left until the text ends or a word comes that no test item has
    here = np.arange(n)
    unknown = np.append(np.flatnonzero(number == 0), n)
    run = np.minimum(unknown[np.searchsorted(unknown, here)], w.first[np.minimum(np.searchsorted(w.first, here, side="right"), len(w.first) - 1)]) - here
    # a suffix in which no test window fits is in no answer
    at = np.flatnonzero((number > 0) & (run >= test.least[number]))
    if not len(at):
        return at, at
    padded = np.concatenate((number, np.zeros(window, dtype=number.dtype)))
    rows = np.empty((len(at), window), dtype=">u4")
    for k in range(window):
        rows[:, k] = np.where(k < run[at], padded[at + k], 0)
    keys = rows.view(f"S{4 * window}").reshape(-1)
    order = np.argsort(keys, kind="stable")
    array = keys[order]
    lo, hi = np.searchsorted(array, test.low, side="left"), np.searchsorted(array, test.high, side="right")
    found = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), found)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
    return at[order[lo[which] + inner]], which


def _longest(number: np.ndarray, spans: list[tuple[int, int]], starts: np.ndarray, test: TestSuffixes, items: np.ndarray) -> list[tuple[int, int, int]]:
    """Longest verbatim matches (item, start, end), none inside another, of words in the spans with any of the items.

    All suffixes of the spans and of the items are sorted together by doubling; a suffix's longest
    match is its common prefix with the nearest item suffix on either side.
    """
    parts = [test.words[test.first[k] : test.first[k + 1]].astype(np.int64) for k in items.tolist()]
    cut = sum(len(p) + 1 for p in parts)  # behind each part stands a word of its own
    parts += [number[a:b] for a, b in spans]
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    text = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])
    for p, e in zip(parts, ends.tolist(), strict=True):
        text[e - len(p) : e] = p
    text[ends] = -1 - np.arange(len(ends))
    ranks = [np.unique(text, return_inverse=True)[1]]
    step, most = 1, max(len(p) for p in parts)
    while step < most:
        ahead = np.concatenate((ranks[-1][step:] + 1, np.zeros(min(step, len(text)), dtype=np.int64)))
        ranks.append(np.unique(ranks[-1] * (len(text) + 1) + ahead, return_inverse=True)[1])
        step *= 2
    order = np.argsort(ranks[-1], kind="stable")
    of_item = order < cut
    place = np.arange(len(order))
    before = np.maximum.accumulate(np.where(of_item, place, -1))
    after = np.minimum.accumulate(np.where(of_item, place, len(order))[::-1])[::-1]
    back = np.empty(len(order), dtype=np.int64)
    back[order] = place
    inside = np.concatenate([np.arange(a, b) for a, b in spans])
    where = np.concatenate([np.arange(e - (b - a), e) for (a, b), e in zip(spans, ends[len(items) :].tolist(), strict=True)])
    mine = where[np.isin(inside, starts)]
    size, other = np.zeros(len(mine), dtype=np.int64), np.zeros(len(mine), dtype=np.int64)
    for side, there in ((before, before[back[mine]] >= 0), (after, after[back[mine]] < len(order))):
        x, y = mine.copy(), np.where(there, order[np.clip(side[back[mine]], 0, len(order) - 1)], 0)
        first, got = y.copy(), np.zeros(len(mine), dtype=np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            same = there & (x < len(text)) & (y < len(text))
            same &= ranks[level][np.minimum(x, len(text) - 1)] == ranks[level][np.minimum(y, len(text) - 1)]
            x, y, got = x + (same << level), y + (same << level), got + (same << level)
        better = got > size
        size, other = np.where(better, got, size), np.where(better, first, other)
    at = inside[np.isin(inside, starts)]
    end = at + size
    top = np.concatenate(([True], end[1:] > np.maximum.accumulate(end)[:-1]))
    return [(int(items[owner[o]]), a, b) for o, a, b in zip(other[top].tolist(), at[top].tolist(), end[top].tolist(), strict=True)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _hits_of(column: pa.Array, test: TestSuffixes, window: int) -> tuple[np.ndarray, dict[int, tuple[list, set, list]]]:
    """Word counts of the texts; for each text with hits its spans, items and longest matches (item, start, end)."""
    raw, offsets = utf8(column)
    counts, hits = np.zeros(len(column), dtype=np.int64), {}
    for i, j in pieces(offsets, SHARD_BYTES):
        w = words(raw, offsets[i : j + 1], ALNUM)
        counts[i:j] = np.diff(w.first)
        number = _numbers(w, test)
        at, which = _occurrences(w, number, test, window)
        if not len(at):
            continue
        doc = np.searchsorted(w.first, at, side="right") - 1
        order = np.argsort(at, kind="stable")
        doc, at, which = doc[order], at[order], which[order]
        borders = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            d, base = int(doc[a]), int(w.first[doc[a]])
            seen = np.unique(which[a:b])
            items = np.unique(np.concatenate([test.item[test.owner[k] : test.owner[k + 1]] for k in seen.tolist()]))
            spans = _merged(list(zip(at[a:b].tolist(), (at[a:b] + test.length[which[a:b]]).tolist(), strict=True)))
            longest = _longest(number, spans, at[a:b], test, items)
            hits[i + d] = ([(x - base, y - base) for x, y in spans], {test.names[k] for k in items.tolist()}, [(test.names[k], x - base, y - base) for k, x, y in longest])
    return counts, hits


def find_matches(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """Rows of docs (struct row) with n_words, spans, items and matches.

    spans: flat starts and ends of the merged hit words; items: ids (as text) of the benchmark items
    with an occurring window; matches: longest verbatim matches (item, start, end), word places, none
    inside another, each with one of the items that have it.
    A window is `window` consecutive words of an item, or the whole item if it has fewer words. Null
    or wordless texts have no words and no hits; a null item id reads as "null"; an empty benchmark
    matches nothing. The benchmark is read in blocks of bounded size, and each block is searched for in all
    documents.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"), F.col(item_text).cast("string").alias("body")).filter("body is not null")
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = int(total // BLOCK_CHARS) + 1
    carry = list(docs.columns) if carry is None else carry
    kind = "n_words long, spans array<long>, items array<string>, matches array<struct<item: string, start: long, end: long>>"
    out = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == block) if blocks > 1 else items
        suffixes = spark.sparkContext.broadcast(test_suffixes([(r.name, r.body) for r in part.collect()], window))

        def run(rows: pa.StructArray, held=suffixes, first=out is None) -> list[pa.Array]:
            column = pc.struct_field(rows, [text_col] if first else ["row", text_col])
            if held.value is None:
                raw, offsets = utf8(column)
                counts, hits = np.concatenate([np.diff(words(raw, offsets[i : j + 1], ALNUM).first) for i, j in pieces(offsets)] or [np.zeros(0, np.int64)]), {}
            else:
                counts, hits = _hits_of(column, held.value, window)
            before = [None] * len(rows) if first else list(zip(*(pc.struct_field(rows, [c]).to_pylist() for c in ("spans", "items", "matches")), strict=True))
            spans, names, matches = [], [], []
            for k, old in enumerate(before):
                s, n, m = hits.get(k, ([], set(), []))
                if old is not None:
                    s = s + list(zip(old[0][::2], old[0][1::2], strict=True))
                    n, m = n | set(old[1]), m + [(x["item"], x["start"], x["end"]) for x in old[2]]
                spans.append([x for ab in _merged(s) for x in ab])
                names.append(sorted(n))
                matches.append([{"item": a, "start": b, "end": c} for a, b, c in sorted(set(m))])
            of = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            return [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string())), pa.array(matches, of)]

        if out is None:
            # the text goes along only if another block needs it
            along = carry if blocks == 1 else list(dict.fromkeys([*carry, text_col]))
            out = mapped(docs, run, kind, along)
        else:
            out = mapped(out, run, kind, ["row"]).select("row.row", "n_words", "spans", "items", "matches")
    return out.select(F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row"), "n_words", "spans", "items", "matches")


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """Digest of find_matches: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_matches(docs, benchmark, carry=[id_col], **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: x - acc)  # ends less starts
    return found.select(
        F.col("row").getField(id_col).alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    return find_matches(docs, benchmark, **options).filter(F.size("spans") == 0).select("row.*")
