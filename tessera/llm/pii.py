"""Personal data: exact patterns, and a skip-chain conditional random field for what they miss.

The patterns give base spans. Every number or address in the text is then a mention. Mentions of the
same characters share all their potentials, however far apart: they are one node, and have one
label. Nodes that follow each other where they first stand are joined by chain edges; nodes that
resemble each other (same last digits, same mailbox name) are tied by skip edges to one hub of what
they share, so any number of them is two steps apart. Base spans are observed labels; loopy
sum-product messages run until they no longer change and carry them on: a bare form of a phone
number that stands elsewhere in full is found everywhere, and a lone look-alike is not. A text
without base spans is scored as well, by the looks of its mentions and what they share.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field as attribute
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import mapped

KINDS = ("email", "ip", "card", "phone")
#: A label is taken from the field if its marginal probability is at least this.
SURE = 0.9
#: Messages of a text run until none changes by more than this, which is looked at every CHECK rounds; the share of the old message kept.
SETTLED, CHECK, DAMPING = 1e-4, 4, 0.3
#: A text whose messages swing for so many rounds is taken as it stands then.
MOST_ROUNDS = 5000
#: Generated documents that the field is trained on, and steps of the training.
TRAINING_DOCS, STEPS = 1000, 100
#: Nodes of several texts whose messages are passed together.
FLIGHT = 50_000

_DIGIT = re.compile("[0-9]")
_MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the first part can only start where a run of digits does, which keeps the search linear
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HOST = re.compile(r"(?:@|[\[(]at[\])] ?)[A-Za-z0-9.-]*[A-Za-z0-9-]\.[A-Za-z]")
_NATIONAL = re.compile(r"\([0-9]{3}\)[ -]?[0-9]{3}[ -][0-9]{4}|\(0[0-9]{1,4}\)[ -]?[0-9]{3,5}[ -]?[0-9]{3,5}")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# mailboxes and words with digits are tried only where a word starts, or goes on after a number: linear in long words
_NODE = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9.-]*[A-Za-z0-9]"
    r"|\+?\(?[0-9](?:[().\x20-]{0,2}[0-9])*(?![A-Za-z0-9@_])"
    r"|(?:(?<![A-Za-z0-9._%+-])|(?<=[0-9])(?=[.%+-]))[A-Za-z0-9._%+-]*[0-9][A-Za-z0-9._%+-]*"
)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """The check-digit rule of payment cards."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches of the mailbox pattern, found from each @ so that long words cost nothing."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _MAILBOX.match(text, start) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        else:
            end = max(end, at + 1)  # no later match can start before this @
        at = text.find("@", max(end, at + 1))
    return out


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns by start, then kind."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 14 <= len(d := _only_digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _features(s: str) -> list[float]:
    """What one mention looks like."""
    digits = _only_digits(s)
    n = len(digits)
    parts = s.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)
    size = [float(lo <= n <= hi) for lo, hi in ((0, 3), (4, 6), (7, 9), (10, 11), (12, 13), (14, 19), (20, 10**9))]
    letters = any(c.isalpha() for c in s)
    return [1.0, *size, float("@" in s), float("at]" in s or "at)" in s), float(bool(_HOST.search(s))), float(quad), float(s.startswith("+")), float("(" in s or ")" in s), float(bool(_NATIONAL.fullmatch(s))), float("-" in s or " " in s), float(letters), float(14 <= n <= 19 and not letters and luhn(digits))]


def _keys(s: str) -> list[str]:
    """Mentions that share a key are the same thing, or nearly."""
    digits = _only_digits(s)
    out = [f"d{digits[-7:]}"] if len(digits) >= 7 else []
    name = re.split(r"@| ?[\[(]at[\])] ?", s)[0].lower()
    if len(name) >= 4 and any(c.isalpha() for c in name):
        out.append(f"w{name}")
    return out


@dataclass
class Graph:
    """Nodes of several documents, chain edges between them, and skip edges (node, hub) to what several of them share."""

    doc: list[int]
    spans: list[list[tuple[int, int]]]  # of a node, all places where it stands without being a base span
    words: list[str]
    observed: list[int]  # label number, -1 if free
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    hubs: list[int] = attribute(default_factory=list)  # document of each hub


def empty_graph() -> Graph:
    return Graph([], [], [], [], [], [])


def add_nodes(graph: Graph, doc: int, text: str, base: list[Span]) -> None:
    """The mentions of one text: every base span, and what is apart from all of them."""
    mentions = [(s, e, KINDS.index(k) + 1) for k, s, e in base]
    b, reach = 0, 0
    for m in _NODE.finditer(text):
        s, e = m.span()
        while b < len(base) and base[b][1] < e:
            reach = max(reach, base[b][2])
            b += 1
        if reach <= s:
            mentions.append((s, e, -1))
    node: dict[str, int] = {}
    same: dict[str, list[int]] = {}
    first = len(graph.doc)
    for s, e, label in sorted(mentions):
        word = text[s:e]
        if (k := node.get(word, -1)) < 0:
            k = node[word] = len(graph.doc)
            graph.doc.append(doc)
            graph.spans.append([])
            graph.words.append(word)
            graph.observed.append(-1)
            if k > first:
                graph.chain.append((k - 1, k))
            for key in _keys(word):
                same.setdefault(key, []).append(k)
        if label < 0:
            graph.spans[k].append((s, e))
        elif graph.observed[k] < 0:
            graph.observed[k] = label
    for nodes in same.values():
        if len(nodes) > 1:
            graph.skip += [(k, len(graph.hubs)) for k in nodes]
            graph.hubs.append(doc)


@dataclass
class Field:
    """Log potentials: unary weights (features x labels), chain table (labels x labels), skip table (node label x hub label), hub prior."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    hub: np.ndarray


class _Messages:
    """Loopy sum-product over a graph: variables are nodes, then hubs; each edge carries a message either way."""

    def __init__(self, graph: Graph, field: Field, looks: np.ndarray | None = None) -> None:
        self.field, self.n = field, len(graph.doc)
        looks = np.array([_features(w) for w in graph.words]).reshape(self.n, -1) if looks is None else looks
        observed = np.array(graph.observed)
        local = looks @ field.unary
        local[observed >= 0] = -40.0
        local[observed >= 0, observed[observed >= 0]] = 0.0
        self.local = np.concatenate((local, np.tile(field.hub, (len(graph.hubs), 1))))
        chain, skip = (np.array(x, dtype=np.int64).reshape(-1, 2) for x in (graph.chain, graph.skip))
        skip = skip + np.array([0, self.n])
        doc = np.array([*graph.doc, *graph.hubs], dtype=np.int64)
        # directed edges by table: chain forth and back, skip to the hub and back
        self.parts = [(chain, field.chain), (chain[:, ::-1], field.chain.T), (skip, field.skip), (skip[:, ::-1], field.skip.T)]
        sizes = [len(ends) for ends, _ in self.parts]
        self.ends = np.concatenate([ends for ends, _ in self.parts])
        at = np.concatenate(([0], np.cumsum(sizes)))
        numbers = [np.arange(at[k], at[k + 1]) for k in range(4)]
        self.back = np.concatenate((numbers[1], numbers[0], numbers[3], numbers[2]))
        self.kind = np.repeat(np.arange(4), sizes)
        self.doc = doc[self.ends[:, 0]] if len(self.ends) else np.zeros(0, np.int64)
        self.message = np.zeros((len(self.ends), local.shape[1]))

    def inflow(self, edges: np.ndarray) -> np.ndarray:
        """Sum of the messages of those edges at each variable."""
        dst = self.ends[edges, 1]
        return np.stack([np.bincount(dst, weights=self.message[edges, x], minlength=len(self.local)) for x in range(self.local.shape[1])], axis=1)

    def run(self, rounds: int = MOST_ROUNDS, settled: float = SETTLED) -> np.ndarray:
        """Log beliefs of all variables; each document stops on its own, so that others beside it change nothing."""
        tables = [np.exp(t) for _, t in self.parts]
        live = np.arange(len(self.ends))
        for k in range(rounds):
            if not len(live):
                break
            src, kind = self.ends[live, 0], self.kind[live]
            out = self.local[src] + self.inflow(live)[src] - self.message[self.back[live]]
            top = out.max(axis=1, keepdims=True)
            out = np.exp(out - top)
            new = np.empty_like(out)
            border = np.searchsorted(kind, np.arange(5))
            for t in range(4):
                new[border[t] : border[t + 1]] = out[border[t] : border[t + 1]] @ tables[t]
            new = np.log(new)
            new -= np.log(np.exp(new - new.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + new.max(axis=1, keepdims=True)
            old = self.message[live]
            self.message[live] = DAMPING * old + (1 - DAMPING) * new
            if settled and k % CHECK == CHECK - 1:
                moved = np.zeros(int(self.doc.max()) + 1)
                np.maximum.at(moved, self.doc[live], np.abs(new - old).max(axis=1))
                live = live[moved[self.doc[live]] > settled]
        return self.local + self.inflow(np.arange(len(self.ends)))

    def pairs(self, belief: np.ndarray, part: int) -> np.ndarray:
        """Probabilities (edges x label x label) of both ends of the edges of a part."""
        edges = np.flatnonzero(self.kind == part)
        a, b = self.ends[edges].T
        joint = (belief[a] - self.message[self.back[edges]])[:, :, None] + (belief[b] - self.message[edges])[:, None, :] + self.parts[part][1]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        return joint / joint.sum(axis=(1, 2), keepdims=True)


def _shares(belief: np.ndarray) -> np.ndarray:
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def marginals(graph: Graph, field: Field) -> np.ndarray:
    """Label probabilities (nodes x labels)."""
    if not graph.doc:
        return np.zeros((0, len(KINDS) + 1))
    return _shares(_Messages(graph, field).run())[: len(graph.doc)]


def _generated(count: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Documents with known entities: full and bare mentions, and numbers that are nobody's."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeiourstlnmd") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        d = digits(15)
        return next(d + c for c in "0123456789" if luhn(d + c))

    def hidden() -> list[tuple[str, str]]:
        """Mentions of an entity that has none of the patterns' forms: a written-out mailbox, a national phone number."""
        if rng.random() < 0.5:
            at = rng.choice((" [at] ", " (at) ", "[at]", "(at)"))
            m = ("email", f"{word()}{rng.choice((digits(2), '', '.' + word()))}{at}{word()}.{rng.choice(('com', 'org', 'example.net'))}")
        else:
            m = ("phone", rng.choice((f"({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)} {digits(4)}", f"(0{digits(3)}) {digits(rng.randint(6, 8))}")))
        return [m] * rng.choice((1, 1, 2, 3, 7))

    def entity() -> list[tuple[str, str]]:
        kind = rng.choice(KINDS)
        if kind == "email":
            name = f"{word()}{word()}.{digits(2)}"
            host = f"{word()}{rng.randint(1, 9)}.example.{rng.choice(('com', 'org'))}"
            return [(kind, f"{name}@{host}"), (kind, rng.choice((f"{name} [at] {host}", f"{name}@localhost", name)))]
        if kind == "ip":
            ip = ".".join(str(rng.randint(1, 255)) for _ in range(4))
            return [(kind, ip), (kind, ip)]
        if kind == "card":
            c = card()
            return [(kind, c), (kind, " ".join(c[i : i + 4] for i in range(0, 16, 4)))]
        a, b, c = digits(3), digits(3), digits(4)
        return [(kind, f"+1 ({a}) {b}-{c}"), (kind, rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{b}-{c}")))]

    def other() -> str:
        return rng.choice((str(rng.randint(0, 9999)), f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}", f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", digits(7), digits(8), digits(10), digits(16), f"{digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", "".join(rng.choice("0123456789abcdef") for _ in range(40)), f"{word()}{digits(2)}", f"({rng.randint(1, 999)})", f"({rng.randint(1, 2030)}) " + " ".join(str(rng.randint(1, 999)) for _ in range(rng.randint(2, 5))), f"{word()}.{digits(2)}", f"x@{word()}", f"{word()} {rng.choice(('(at)', '[at]'))} {word()}{rng.choice(('', '.'))}"))

    def alike() -> list[str]:
        """Mentions that share their digits or a name and are nobody's."""
        w, d = word() + word(), digits(7)
        return rng.choice(([f"{w} (at) {word()}", f"{w} (at) {word()}", f"{w} [at] {word()}"], [d, f"0{d}"], [f"v{d}", d], [digits(3) + d, d], [f"{d[:3]}-{d[3:]}", d], [f"{w}{digits(2)}", f"{w}{digits(2)}"], [f"x{d}", f"y{d}", f"{digits(4)}{d}"]))

    out = []
    for _ in range(count):
        bits: list[tuple[str, str]] = [("", word()) for _ in range(rng.randint(5, 30))]
        for _ in range(rng.randint(0, 2)):
            full, bare = entity()
            bits.insert(rng.randint(0, len(bits)), full)
            if rng.random() < 0.6:
                for _ in range(rng.choice((1, 1, 1, 2, 6))):
                    bits.insert(rng.randint(0, len(bits)), bare)
        if rng.random() < 0.3:
            for m in hidden():
                bits.insert(rng.randint(0, len(bits)), m)
        for _ in range(rng.randint(0, 4)):
            o = ("", other())
            for _ in range(rng.choice((1, 1, 2, 2, 7))):
                bits.insert(rng.randint(0, len(bits)), o)
        if rng.random() < 0.4:
            for o in alike():
                bits.insert(rng.randint(0, len(bits)), ("", o))
        text, spans = "", []
        for kind, s in bits:
            text += " , "
            if kind:
                spans.append((kind, len(text), len(text) + len(s)))
            text += s
        out.append((text, spans))
    return out


@lru_cache(maxsize=1)
def trained(count: int = TRAINING_DOCS, seed: int = 20) -> Field:
    """Weights fitted jointly on generated documents: the gradient of the conditional likelihood, with the
    expected counts of features, neighbours and shared mentions from the messages themselves.

    A hub's own label is that of its mentions. Base spans are observed, as they are later.
    """
    graph, gold = empty_graph(), []
    for d, (text, spans) in enumerate(_generated(count, seed)):
        first = len(graph.doc)
        add_nodes(graph, d, text, base_spans(text))
        for k in range(first, len(graph.doc)):
            there = [KINDS.index(kind) + 1 for kind, a, b in spans for s, e in graph.spans[k] if a < e and b > s]
            gold.append(max([0, graph.observed[k], *there]))
    labels = len(KINDS) + 1
    y = np.array(gold)
    of_hub = np.zeros(len(graph.hubs), dtype=np.int64)
    for k, hub in graph.skip:
        of_hub[hub] = max(of_hub[hub], y[k])
    looks = np.array([_features(w) for w in graph.words])
    free = np.array(graph.observed) < 0
    one = np.eye(labels)

    def counts(ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros((labels, labels))
        np.add.at(out, (a[ends[:, 0]], b[ends[:, 1]]), 1.0)
        return out

    chain, skip = np.array(graph.chain).reshape(-1, 2), np.array(graph.skip).reshape(-1, 2)
    seen = [looks[free].T @ one[y[free]], counts(chain, y, y), counts(skip, y, of_hub), one[of_hub].sum(axis=0)]
    seen[1] = (seen[1] + seen[1].T) / 2
    field = Field(np.zeros((looks.shape[1], labels)), np.zeros((labels, labels)), np.zeros((labels, labels)), np.zeros(labels))
    mean, spread = [np.zeros_like(x) for x in seen], [np.zeros_like(x) for x in seen]
    for step in range(1, STEPS + 1):
        messages = _Messages(graph, field, looks)
        belief = messages.run(rounds=10, settled=0.0)
        p = _shares(belief)
        near = messages.pairs(belief, 0).sum(axis=0)
        expected = [looks[free].T @ p[: len(y)][free], (near + near.T) / 2, messages.pairs(belief, 2).sum(axis=0), p[len(y) :].sum(axis=0)]
        for k, name in enumerate(("unary", "chain", "skip", "hub")):
            weights = getattr(field, name)
            slope = (seen[k] - expected[k]) / len(y) - 2e-5 * weights
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            spread[k] = 0.99 * spread[k] + 0.01 * slope * slope
            weights += 0.2 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-6)
    return field


def all_spans(texts: list[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and base spans with those the field adds, of each whole text."""
    base = [base_spans(t or "") for t in texts]
    more: dict[int, list[Span]] = {}
    graph = empty_graph()
    for k, t in enumerate(texts):
        add_nodes(graph, k, t or "", base[k])
        if graph.doc and (len(graph.doc) >= FLIGHT or k == len(texts) - 1):
            p = marginals(graph, field)
            for i in np.flatnonzero(p[:, 1:].max(axis=1) >= SURE).tolist():
                if graph.spans[i]:
                    kind = KINDS[int(p[i, 1:].argmax())]
                    more.setdefault(graph.doc[i], []).extend((kind, a, b) for a, b in graph.spans[i])
            graph = empty_graph()
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return [(b, sorted(b + more[k], key=order) if k in more else b) for k, b in enumerate(base)]


def find_spans(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of docs (struct row) with base and spans, arrays of (kind, start, end) in code points.

    A null or empty text has no spans. Base spans are always among the spans.
    """
    held = docs.sparkSession.sparkContext.broadcast(trained())

    def run(rows: pa.StructArray) -> list[pa.Array]:
        column = pc.struct_field(rows, [text_col]).cast(pa.string())
        got = []
        for s in range(0, len(column), 512):
            got += all_spans(column.slice(s, 512).to_pylist(), held.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return [pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in r[i]] for r in got], kind) for i in (0, 1)]

    of = "array<struct<kind: string, start: long, end: long>>"
    return mapped(docs, run, f"base {of}, spans {of}", list(docs.columns) if carry is None else carry)


def span_text(column: str):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, *, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets, and the size column set anew.

    Overlapping spans are masked as one, by the kind of the first. Null texts stay null.
    """
    held = docs.sparkSession.sparkContext.broadcast(trained())

    def run(rows: pa.StructArray) -> list[pa.Array]:
        texts = pc.struct_field(rows, [text_col]).cast(pa.string()).to_pylist()
        out: list[str | None] = []
        for s in range(0, len(texts), 512):
            part = texts[s : s + 512]
            for text, (_, spans) in zip(part, all_spans(part, held.value), strict=True):
                if spans and text is not None:
                    bits, at = [], 0
                    for kind, a, b in spans:
                        if a >= at:
                            bits += [text[at:a], f"[{kind.upper()}]"]
                        at = max(at, b)
                    text = "".join(bits) + text[at:]
                out.append(text)
        return [pa.array(out, pa.string())]

    got = mapped(docs, run, "clean string", [c for c in docs.columns if c != text_col])
    cols = []
    for c in docs.columns:
        new = F.col("clean") if c == text_col else F.length("clean").cast(docs.schema[c].dataType) if c == size_col else F.col("row").getField(c)
        cols.append(new.alias(c))
    return got.select(*cols)
