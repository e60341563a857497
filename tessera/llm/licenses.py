"""License notices by winnowed fingerprints and banded alignment.

Word k-grams of the templates are winnowed into an inverted index. A document whose k-grams meet
the index has candidate places; around each, its words are aligned with the template's in a
band, and the matched share and the span in the text are reported.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import mapped
from .license_texts import license_of, templates
from .textnum import ALNUM, combine, pieces, utf8, words

#: Words of a k-gram and k-grams of a winnowing window. All k-grams of a text are looked up, so a copy with
#: GRAM + WINDOW - 1 unchanged words in a row is always a candidate; of a template of up to SHORT words, all k-grams are kept.
GRAM, WINDOW, SHORT = 4, 3, 40
#: Words that an alignment may drift from its diagonal.
BAND = 6
#: Least share of a template's words that must match.
COVERAGE = 0.8

#: Template characters that are broadcast, at most.
TEMPLATE_CHARS = 16_000_000

TEMPLATES = templates()


def _grams(hashes: np.ndarray) -> np.ndarray:
    n = len(hashes) - GRAM + 1
    return combine([hashes[k : n + k] for k in range(GRAM)]) if n > 0 else np.zeros(0, dtype=np.uint64)


@dataclass
class Index:
    """Winnowed k-grams, sorted, with the template and place of each; the templates' words; and for each
    template the pairs (words that it alone has, words that only the other has) against those it can be taken for."""

    grams: np.ndarray
    template: np.ndarray
    place: np.ndarray
    names: list[str]
    words: list[np.ndarray]
    differ: list[list[tuple[frozenset[int], frozenset[int]]]]


def _differences(names: list[str], held: list[np.ndarray]) -> list[list[tuple[frozenset[int], frozenset[int]]]]:
    """Where two templates of different licenses share so many words that one can pass for the other, how they differ."""
    sets = [frozenset(h.tolist()) for h in held]
    out: list[list[tuple[frozenset[int], frozenset[int]]]] = []
    for a, mine in zip(names, sets, strict=True):
        found = {(mine - other, other - mine) for b, other in zip(names, sets, strict=True) if license_of(a) != license_of(b) and len(mine & other) >= COVERAGE * COVERAGE * len(mine)}
        out.append(sorted(found, key=lambda f: (sorted(f[0]), sorted(f[1]))))
    return out


def index(templates: dict[str, str]) -> Index:
    """Of every window of k-grams the least one, rightmost on ties; a template of too few words for one is left out."""
    names = sorted(templates)
    found, held = [], []
    for t, name in enumerate(names):
        h = words(*utf8(pa.array([templates[name]])), ALNUM).hashes
        held.append(h)
        g = _grams(h)
        window = 1 if len(h) <= SHORT else WINDOW
        for s in range(max(1, len(g) - window + 1)) if len(g) else ():
            part = g[s : s + window]
            at = s + len(part) - 1 - int(np.argmin(part[::-1]))
            found.append((int(g[at]), t, at))
    found = sorted(set(found))
    return Index(np.array([f[0] for f in found], dtype=np.uint64), np.array([f[1] for f in found], dtype=np.int64), np.array([f[2] for f in found], dtype=np.int64), names, held, _differences(names, held))


def align(text: np.ndarray, template: np.ndarray, center: int, least: int = 0, most: int | None = None) -> tuple[int, int, int]:
    """Matched words of the template in its best alignment with the text near the diagonal, and the text words it spans.

    Common subsequence within the band around text place = template place + center, of text words
    least..most, with most matched words less text words skipped between them; of several the one
    with most matched words, then the shortest span, then the first.
    """
    n, width = len(template), 2 * BAND + 1
    lo, hi = max(least, center - BAND, 0), min(len(text) if most is None else most, center + n + BAND)
    part, wanted = text[lo:hi].tolist(), template.tolist()
    unit = len(part) + 1
    # a cell is ((matched - skipped) * (n + 1) + matched) * unit + 1 + first word, 0 without a match
    skip, match = (n + 1) * unit, (n + 2) * unit
    row, best = [0] * (width + 1), (0, 0, 0)
    for i, word in enumerate(wanted):
        new, left = [0] * (width + 1), 0
        j = i + center - BAND - lo
        for d in range(width):
            got = max(row[d + 1], left - skip, 0)
            if 0 <= j < len(part) and part[j] == word:
                hit = row[d] + match if row[d] else match + j + 1
                got = max(got, hit)
                best = max(best, (hit // unit, hit % unit - 1 - j, -j))
            new[d] = left = got
            j += 1
        row = new
    value, span, last = best
    return (value % (n + 1), lo - last + span, lo - last + 1) if value else (0, lo, lo)


def _same(text: np.ndarray, first: int, last: int, held: Index, t: int, matched: int) -> bool:
    """False if what tells the template from another license is not there, or what tells the other one is."""
    if matched == len(held.words[t]) == last - first:
        return True
    there = set(text[first:last].tolist())
    return all((not own or len(own & there) >= COVERAGE * len(own)) and (not other or len(other & there) < COVERAGE * len(other)) for own, other in held.differ[t])


def _found(text: np.ndarray, held: Index, t: int, hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Matches (words, first, last) of one template from its hits (text place, template place), none on another.

    Whole copies come first; what lies between two of them is then searched from left to right, each
    time from the words after the last match, so that no copy hides the one beside it.
    """
    template = held.words[t]
    n = len(template)
    need = COVERAGE * n
    exact, end = [], 0
    for center in sorted({at - place for at, place in hits}):
        if center >= end and center + n <= len(text) and (text[center : center + n] == template).all():
            exact.append((n, center, center + n))
            end = center + n
    out: list[tuple[int, int, int]] = []
    inside = np.concatenate(([0], np.cumsum(np.isin(text, template))))  # words of the template before each place
    failed: set[tuple[int, int]] = set()  # windows, and the place in them, that hold no match

    def seek(lo: int, hi: int, k: int) -> int:
        """Matches in text words lo..hi, from the k-th hit on; the first hit that was not looked at."""
        while k < len(hits) and hits[k][0] < hi:
            at, place = hits[k]
            k += 1
            a, b = max(lo, at - place - BAND), min(hi, at - place + n + BAND)
            if at < lo or b - a < need or inside[b] - inside[a] < need:
                continue
            window = (hash(text[a:b].tobytes()), at - place - a)
            if window in failed:
                continue
            score, first, last = align(text, template, at - place, lo, hi) if np.isin(template, text[a:b]).sum() >= need else (0, a, a)
            if score < need or score < COVERAGE * (last - first) or not _same(text, first, last, held, t, score):
                failed.add(window)
            else:
                if first - lo >= need:
                    seek(lo, first, bisect_left(hits, (lo, -1)))
                out.append((score, first, last))
                lo = last
        return k

    k, lo = 0, 0
    for m in exact:
        k = seek(lo, m[1], k)
        lo = m[2]
    seek(lo, len(text), k)
    return out + exact


def _matches(w, doc: int, held: Index, hits: list[tuple[int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Matches in one document from its hits (word place, index row): name, coverage, words, first and last word."""
    a, b = int(w.first[doc]), int(w.first[doc + 1])
    text = w.hashes[a:b]
    of: dict[int, list[tuple[int, int]]] = {}
    for at, row in sorted(hits):
        of.setdefault(int(held.template[row]), []).append((at - a, int(held.place[row])))
    out = [(held.names[t], m[0] / len(held.words[t]), *m) for t, places in of.items() for m in _found(text, held, t, places)]
    # of overlapping matches the one with most matched words stands
    chosen: list[tuple[str, float, int, int, int]] = []
    taken: list[tuple[int, int]] = []
    for m in sorted(out, key=lambda m: (-m[2], -m[1], m[3], m[0])):
        k = bisect_left(taken, (m[3], m[4]))
        if (k == len(taken) or m[4] <= taken[k][0]) and (k == 0 or taken[k - 1][1] <= m[3]):
            taken.insert(k, (m[3], m[4]))
            chosen.append(m)
    return sorted(chosen, key=lambda m: (m[3], m[0]))


def templates_from(table: DataFrame, *, name_col: str = "name", text_col: str = "text") -> dict[str, str]:
    """Templates of a table, for whole licenses of any length; more than TEMPLATE_CHARS characters are refused. Of one name the first text counts."""
    size = table.agg(F.sum(F.length(text_col))).first()[0] or 0
    if size > TEMPLATE_CHARS:
        raise ValueError(f"templates have {size} characters, more than {TEMPLATE_CHARS}")
    rows = table.filter(F.col(name_col).isNotNull() & F.col(text_col).isNotNull()).groupBy(F.col(name_col).alias("name")).agg(F.min(text_col).alias("text"))
    return {r.name: r.text for r in rows.collect()}


def scan(docs: DataFrame, templates: dict[str, str] | None = None, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of docs (struct row) with matches: array of (license, template, coverage, matched_words, start, end) in code points.

    license is the identifier (of a family, without a version, where the text names none), template the text of it that matched.

    Whole texts are scanned; null and empty texts have no matches. Copies of one template never
    overlap; of overlapping matches of several the one with most matched words stands, on ties the
    one of higher coverage, then the first. A text that could be one of several licenses counts for
    the one whose distinguishing words (name, version, terms) it has, and for none if it has none.
    """
    held = docs.sparkSession.sparkContext.broadcast(index(templates or TEMPLATES))

    def run(rows: pa.StructArray) -> list[pa.Array]:
        column = pc.struct_field(rows, [text_col])
        raw, offsets = utf8(column)
        out: list[list[dict]] = [[] for _ in range(len(column))]
        known = held.value.grams
        for i, j in pieces(offsets):
            w = words(raw, offsets[i : j + 1], ALNUM)
            g = _grams(w.hashes)
            at = np.flatnonzero(np.isin(g, known)) if len(known) else np.zeros(0, np.int64)
            doc = np.searchsorted(w.first, at, side="right") - 1
            inside = at + GRAM <= w.first[np.minimum(doc + 1, len(w.first) - 1)]
            hits: dict[int, list[tuple[int, int]]] = {}
            for p, d in zip(at[inside].tolist(), doc[inside].tolist(), strict=True):
                lo, hi = np.searchsorted(known, g[p], side="left"), np.searchsorted(known, g[p], side="right")
                hits.setdefault(d, []).extend((p, r) for r in range(lo, hi))
            base = int(offsets[i])
            for d, places in hits.items():
                data = raw[int(offsets[i + d]) : int(offsets[i + d + 1])]
                chars = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
                for name, coverage, score, first, last in _matches(w, d, held.value, places):
                    s = int(w.starts[w.first[d] + first]) + base - int(offsets[i + d])
                    e = int(w.ends[w.first[d] + last - 1]) + base - int(offsets[i + d])
                    out[i + d].append({"license": license_of(name), "template": name, "coverage": coverage, "matched_words": score, "start": int(chars[s]) - 1, "end": int(chars[e - 1])})
        kind = pa.struct([("license", pa.string()), ("template", pa.string()), ("coverage", pa.float64()), ("matched_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
        return [pa.array(out, pa.list_(kind))]

    return mapped(docs, run, "matches array<struct<license: string, template: string, coverage: double, matched_words: long, start: long, end: long>>", list(docs.columns) if carry is None else carry)


def license_spans(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per match: the id, license, template, coverage, matched_words, start, end."""
    found = scan(docs, carry=[id_col], **options)
    return found.select(F.col("row").getField(id_col).alias("doc_id"), F.explode("matches").alias("m")).select("doc_id", "m.*")
