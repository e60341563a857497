"""HTML source as a flat tree of elements with their text blocks.

Forgiving in the ways pages need it: unclosed paragraphs and list items end where the next one
starts, stray end tags are ignored, and comments are skipped. Scripts and styles run to their own
end tag or, as in browsers, to the end of the page; drawings, frames and other raw elements without
an end tag are ordinary elements, so that nothing after them is lost. Text outside the body, before
its tag or after its end, belongs to the body; without one to an implied body. Formulas and the
text in place of an object are text of the line, and so is text of elements with unknown names,
unless they have a class, id or role to be judged by.

Everything is read in time linear in the source, however broken it is.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*+")
_STOP = re.compile("[>=]")
_QUOTED = re.compile(r"\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++)))?+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")
_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9A-Fa-f])")
_TOO_LONG = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9A-Fa-f]{9,});?")
#: Elements whose content is no text of the page up to their end tag; the first two also without one.
_SCRIPTS = ("script", "style")
RAW = frozenset((*_SCRIPTS, "noscript", "template", "textarea", "svg", "iframe", "title", "noembed", "noframes", "xmp"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end blocks; all others stand in a line.
BLOCK = frozenset(
    "html head body address article aside blockquote button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li link main menu meta nav ol optgroup option p pre script search section select style summary table tbody td template tfoot th thead "
    "title tr ul video audio canvas iframe noscript textarea svg input base source track param area embed noembed noframes xmp".split()
)
_MATH = "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml"
#: Known elements of a line: their class says how text looks, not what it is for.
INLINE = frozenset(f"{_MATH} object a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q ruby rb rp rt s samp small span strike strong sub sup time tt u var br wbr img picture map".split())
#: Elements that a drawing cannot hold: one of these before its end tag shows that it has none.
_OUTSIDE = re.compile(r"<(?:p|div|h[1-6]|ul|ol|li|table|blockquote|article|section|main|nav|aside|header|footer|body|pre)[\s/>]", re.I)
#: Tags that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
_ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
_JUDGED = frozenset(("class", "id", "role", "aria-label", "itemprop", "data-role"))


def decoded(text: str) -> str:
    """Text with its character references decoded; numbers of any length are one character."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _TOO_LONG.sub("\ufffd", _ZEROS.sub(r"&#\1", text))
    return html.unescape(text)


class _Source:
    """Places in a source, each sought once: a pattern's next match is kept until it is passed."""

    def __init__(self, text: str) -> None:
        self.text, self.known, self.ends = text, {}, {}
        self.last = text.rfind(">")
        self.quotes = True

    def after(self, pattern: re.Pattern, at: int) -> tuple[int, int] | None:
        """Start and end of the first match from a place on; places asked for never fall."""
        if pattern not in self.known or (self.known[pattern] is not None and self.known[pattern][0] < at):
            m = pattern.search(self.text, at)
            self.known[pattern] = m and m.span()
        return self.known[pattern]

    def end_tag(self, name: str, at: int) -> tuple[int, int] | None:
        if name not in self.ends:
            self.ends[name] = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I)
        return self.after(self.ends[name], at)

    def tag_end(self, at: int) -> int:
        """Place behind the > of the tag whose name ends at a place; 0 if there is none.

        A > in a quoted value ends no tag. Where that would leave a tag open to the end of the page,
        quotes mean nothing from there on.
        """
        if at > self.last:
            return 0
        k = at
        while self.quotes:
            m = _STOP.search(self.text, k)
            if not m:
                self.quotes = False
            elif m[0] == ">":
                return m.end()
            else:
                k = m.end()
                if (q := _QUOTED.match(self.text, k)) and (close := self.text.find(q[1], q.end())) >= 0:
                    k = close + 1
                elif q:
                    self.quotes = False
        return self.text.index(">", at) + 1


@dataclass
class Tree:
    """Elements in document order (0 is a root that stands for the page) and text blocks.

    A block is text between two borders of block elements, with white space made single; it
    belongs to the block element around it.
    """

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    tokens: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    depth: list[int] = field(default_factory=lambda: [0])
    inline: list[int] = field(default_factory=lambda: [0])  # inline elements inside
    link_chars: list[int] = field(default_factory=lambda: [0])
    block_node: list[int] = field(default_factory=list)
    block_text: list[str] = field(default_factory=list)


# Words by which a name tells how a page is set, not what an element is for.
_STATES = frozenset("no not without has with is open opened closed fixed sticky left right wide full enabled disabled free type count on off".split())


# Words by which a name tells how a page is set, not what an element is for.
_STATES = frozenset("no not without has with is open opened closed fixed sticky left right wide full enabled disabled free type count on off".split())


def _attributes(source: str) -> list[str]:
    """Words of the attributes that say what an element is for; "hidden" for one that is not shown.

    A word that is only part of a name, such as tag-cloud, has a hyphen before it; names that tell of a state, such
    as no-sidebar or header-fixed, have none of their words.
    """
    words: list[str] = []
    for key, *values in _ATTRIBUTE.findall(source):
        key = key.lower()
        if key in _JUDGED:
            for name in "".join(values).split():
                found = _WORD.findall(_CAMEL.sub(r"\1 \2", name).lower())
                if len(found) == 1:
                    words += found
                elif not _STATES.intersection(found):
                    words += ["-" + w for w in found]
        elif key == "hidden" or (key == "style" and _NOT_SHOWN.search("".join(values))):
            words.append("hidden")
    return words


def parse(source: str) -> Tree:
    """Tree of an HTML source; a null or empty one has a root and no blocks."""
    tree = Tree()
    source = source or ""
    places = _Source(source)
    stack = [0]  # open block elements
    where: dict[str, list[int]] = {"#root": [0]}  # by tag, their places in the stack
    anchors = 0
    bits: list[str] = []
    linked = 0

    def opened(name: str, words: list[str], *, push: bool = True) -> None:
        tree.parent.append(stack[-1])
        tree.tag.append(name)
        tree.tokens.append(tuple(words))
        tree.depth.append(tree.depth[stack[-1]] + 1)
        tree.inline.append(0)
        tree.link_chars.append(0)
        if push:
            where.setdefault(name, []).append(len(stack))
            stack.append(len(tree.tag) - 1)

    def nearest(names: tuple[str, ...]) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=0)

    def inside() -> None:
        """Loose text and inline elements stand in a body."""
        if tree.tag[stack[-1]] in ("#root", "html"):
            opened("body", [])

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", decoded("".join(bits))).strip()
        if text:
            inside()
            tree.block_node.append(stack[-1])
            tree.block_text.append(text)
            tree.link_chars[stack[-1]] += linked
        bits.clear()
        linked = 0

    def close(upto: int) -> None:
        flush()
        while len(stack) > upto:
            where[tree.tag[stack.pop()]].pop()

    def text_upto(end: int) -> None:
        nonlocal linked
        if end > at:
            bits.append(source[at:end])
            if anchors:
                linked += end - at

    at, n = 0, len(source)
    while at < n:
        begin = source.find("<", at)
        while begin >= 0 and not (source[begin + 1 : begin + 2].isalpha() and source[begin + 1].isascii()) and source[begin + 1 : begin + 2] not in ("/", "!", "?"):
            begin = source.find("<", begin + 1)
        text_upto(begin if begin >= 0 else n)
        if begin < 0:
            break
        if source.startswith("<!--", begin):
            end = source.find("-->", begin + 2)
            at = end + 3 if end >= 0 else n
            continue
        ends = source[begin + 1] == "/"
        m = _NAME.match(source, begin + 1 + ends)
        at = places.tag_end(m.end() if m else begin + 2)
        if not at:  # cut off within a tag
            break
        if not m:
            continue
        name, inner = m[0].lower(), source[m.end() : at - 1]
        if ends:
            if name == "a":
                anchors = max(0, anchors - 1)
            elif name in ("body", "html"):  # the body stays open for text that follows
                flush()
                if k := nearest(("body",)):
                    close(k + 1)
            elif k := nearest((name,)):
                close(k)
            elif name in BLOCK:
                flush()
            continue
        empty = inner.endswith("/")
        if name in RAW and not empty:
            stop = places.end_tag(name, at)
            if stop and name == "svg" and (out := places.after(_OUTSIDE, at)) and out[0] < stop[0]:
                stop = None
            if stop:
                if name in ("textarea", "iframe", "xmp"):
                    flush()
                at = stop[1]
                continue
            if name in _SCRIPTS:
                break
            if name == "svg":
                continue
        words = _attributes(inner) if inner else []
        if name not in BLOCK and (not words or name in INLINE):
            inside()
            tree.inline[stack[-1]] += 1
            if name == "a":
                anchors += 1
            elif name in ("br", "wbr"):
                bits.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if name in ("html", "body") and where.get("body"):
            continue
        if name in _ENDS_P and tree.tag[stack[-1]] == "p":
            close(len(stack) - 1)
        if name in _ENDS_SAME and (k := nearest(_ENDS_SAME[name])) > nearest(_STOPS[name]):
            close(k)
        anchors = 0
        opened(name, words, push=not empty)
    flush()
    return tree
