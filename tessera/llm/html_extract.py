"""Main text of web pages by boosted trees over DOM nodes.

Every block element is scored from its own and its subtree's features. A page is then decoded as
a whole: the most likely labelling in which no main-text element stands inside one that is not.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import boosting
from .common import mapped
from .html_tree import Tree, parse

#: Generated pages that the trees are trained on.
TRAINING_PAGES = 600  # and a quarter as many fragments
# Attribute words that speak for main text, clearly against it, and against it at times; headings of what readers wrote.
GOOD = frozenset("article body content entry main post story text hentry blog page paragraph".split())
BAD = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie copyright disqus footer gdpr hidden login menu modal nav navbar navigation newsletter pagination popup promo recommended related replies search sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
WEAK = frozenset("aside button byline caption dialog form header meta notice reply share tag tags tooltip".split())
READERS = frozenset("comment comments replies reply responses response discussion".split())
_TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "table", "blockquote", "pre", "figure", "nav", "header", "footer", "aside", "form", "body", "button")
_TAG_NUMBER = {t: k + 1 for k, t in enumerate(_TAGS)}
_BAD_TAGS = frozenset(("nav", "footer", "aside", "form", "button", "select", "dialog", "menu"))


def features(tree: Tree) -> np.ndarray:
    """Features (nodes x 30): tag, attribute words, depth, subtree text and links, place among siblings.

    A name speaks against what stands below it only where little of the page does: an element that holds a heading
    of the first rank and half of the page's own text or more is no noise by name, and nor is the body.
    """
    n = len(tree.tag)
    chars, words, blocks, stops = (np.zeros(n) for _ in range(4))
    readers, first = np.zeros(n), [True] * n
    parent = tree.parent
    for node, text in zip(tree.block_node, tree.block_text, strict=True):
        chars[node] += len(text)
        words[node] += text.count(" ") + 1
        blocks[node] += 1
        stops[node] += text.count(".") + text.count(",")
        up = parent[node] if node else 0
        if first[up] and tree.tag[node] in ("h2", "h3", "h4") and text.count(" ") < 5 and not READERS.isdisjoint(text.lower().split()):
            readers[up] = 1
        while node >= 0 and first[node]:
            first[node] = False
            node = parent[node]
    bad = np.array([sum(w in BAD for w in t) for t in tree.tokens], dtype=float)
    part = np.array([sum(w[1:] in BAD for w in t if w[0] == "-") for t in tree.tokens], dtype=float)
    weak = np.array([sum(w.removeprefix("-") in WEAK for w in t) for t in tree.tokens], dtype=float)
    good = np.array([sum(w.removeprefix("-") in GOOD for w in t) for t in tree.tokens], dtype=float)
    tag = np.array([_TAG_NUMBER.get(t, 0) for t in tree.tag], dtype=float)
    bad_tag = np.array([t in _BAD_TAGS for t in tree.tag], dtype=float)
    good_tag = np.array([t in ("article", "main") for t in tree.tag], dtype=float)
    page_header = np.array([t == "header" for t in tree.tag], dtype=float)
    links, inline = np.array(tree.link_chars, dtype=float), np.array(tree.inline, dtype=float)
    inner, children, titles, named = np.ones(n), np.zeros(n), np.array([t == "h1" for t in tree.tag], dtype=float), np.zeros(n)
    own = chars.copy()
    for k in range(n - 1, 0, -1):  # children come after their parent
        p = parent[k]
        named[p] += chars[k] if bad[k] or bad_tag[k] or readers[k] else named[k]
        for a in (chars, words, blocks, stops, links, inline, inner, titles):
            a[p] += a[k]
        children[p] += 1
    total, plain = max(chars[0], 1.0), max(chars[0] - links[0], 1.0)
    share = np.maximum(chars - links, 0) / plain
    whole = np.maximum(chars, 1.0)
    holds = ((share >= 0.5) & (titles > 0)) | np.array([t in ("body", "html") for t in tree.tag])
    up_good, up_bad, up_part, up_article, up_readers = (np.zeros(n) for _ in range(5))
    place, seen = np.zeros(n), np.zeros(n)
    for k in range(1, n):
        p = parent[k]
        up_good[k] = up_good[p] + good[p]
        up_bad[k] = up_bad[p] + (0 if holds[p] else (bad[p] > 0) + bad_tag[p] + (page_header[p] if not up_article[p] else 0))
        up_part[k] = up_part[p] + (0 if holds[p] else (part[p] > 0) + (weak[p] > 0))
        up_article[k] = max(up_article[p], good_tag[p])
        up_readers[k] = max(up_readers[p], readers[p])
        place[k] = seen[p]
        seen[p] += 1
    up = np.maximum(np.array(parent), 0)
    return np.stack(
        [tag, bad_tag, good_tag, page_header, np.minimum(good, 3), np.minimum(bad, 3), np.minimum(part, 3), np.minimum(weak, 3), np.minimum(up_good, 3), np.minimum(up_bad, 3), np.minimum(up_part, 3), up_article, readers, up_readers, holds.astype(float), np.minimum(titles, 2), named / whole, share, np.array(tree.depth, dtype=float), np.log1p(chars), chars / total, words / np.maximum(blocks, 1), chars / inner, links / whole, inline / inner, stops / np.maximum(words, 1), children, place / np.maximum(children[up], 1), own / whole, chars / np.maximum(chars[up], 1)],
        axis=1,
    )


def decode(tree: Tree, p: np.ndarray) -> np.ndarray:
    """Most likely labelling of the nodes in which every main-text node has only such ancestors."""
    yes, no = np.log(np.maximum(p, 1e-9)), np.log(np.maximum(1 - p, 1e-9))
    n = len(p)
    below_no, below_best = np.zeros(n), np.zeros(n)  # sums over children: all "no"; the better of both
    in_no, in_yes = np.zeros(n), np.zeros(n)
    for k in range(n - 1, -1, -1):
        in_no[k], in_yes[k] = no[k] + below_no[k], yes[k] + below_best[k]
        if k:
            q = tree.parent[k]
            below_no[q] += in_no[k]
            below_best[q] += max(in_no[k], in_yes[k])
    out = np.zeros(n, dtype=bool)
    out[0] = True  # the page itself
    for k in range(1, n):
        out[k] = out[tree.parent[k]] and in_yes[k] > in_no[k]
    return out


def _generated_page(rng: random.Random) -> tuple[str, str]:
    """A page whose main text is marked by the letter q, which no other text of it has."""
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(1, 9)))
    sentence = lambda least, most: " ".join(word() for _ in range(rng.randint(least, most))).capitalize() + rng.choice((".", ".", "!", ""))
    marked = lambda s: "q" + s
    link = lambda: f'<a href="/{word()}">{word()}</a>'
    some = lambda xs: rng.choice(xs)
    close = lambda tag: "" if rng.random() < 0.1 else f"</{tag}>"

    def menu() -> str:
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 8))) + "</ul>"

    def misnamed() -> str:
        """Names of an element that holds the article, among them words that elsewhere name noise."""
        odd = lambda: some(sorted(BAD | WEAK))
        names = [some((lambda: f"{odd()}-{word()}", lambda: f"{word()}-{odd()}", lambda: f"no-{odd()}", lambda: f"{odd()}-open", lambda: some(sorted(WEAK)), lambda: some(("post", "hentry", "page", "single", "layout", "home"))))() for _ in range(rng.randint(1, 4))]
        return f' class="{" ".join(names)}"'

    def misnamed() -> str:
        """Names of an element that holds the article, among them words that elsewhere name noise."""
        odd = lambda: some(sorted(BAD | WEAK))
        names = [some((lambda: f"{odd()}-{word()}", lambda: f"{word()}-{odd()}", lambda: f"no-{odd()}", lambda: f"{odd()}-open", lambda: some(sorted(WEAK)), lambda: some(("post", "hentry", "page", "single", "layout", "home"))))() for _ in range(rng.randint(1, 4))]
        return f' class="{" ".join(names)}"'

    def paragraph(mark: bool) -> str:
        s = sentence(1, 60) + (" " + sentence(2, 40) if rng.random() < 0.5 else "")
        s = marked(s) if mark else s
        if rng.random() < 0.15:
            s = "<b>" + s + ("<br>" if rng.random() < 0.5 else "</b>")
        if rng.random() < 0.1:
            s += " " + link()
        return f"<p>{s}{close('p')}"

    def article() -> str:
        out = [f"<h1>{marked(sentence(1, 9))}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.68:
                out.append(paragraph(True))
            elif kind < 0.72:
                out.append(f'<p class="{some(sorted(WEAK))} {word()}">{marked(sentence(4, 40))}</p>')
            elif kind < 0.75:
                caption = some(("figcaption", 'p class="caption"', 'div class="caption"'))
                out.append(f'<figure><img src="a.png"><{caption}>{marked(sentence(2, 20))}</{caption.split()[0]}></figure>')
            elif kind < 0.82:
                out.append(f"<h2>{marked(sentence(1, 6))}</h2>")
            elif kind < 0.88:
                out.append("<ul>" + "".join(f"<li>{marked(sentence(1, 15))}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{paragraph(True)}</blockquote>")
            elif kind < 0.96:
                out.append(f'<div class="{some(("ad", "advert", "promo", "share", "related", "newsletter"))}">{sentence(2, 12)}</div>')
            else:
                out.append(f"<aside>{sentence(2, 20)}</aside>")
        return "".join(out)

    def noise() -> str:
        return some(
            (
                lambda: f'<div class="{some(("ad", "ads banner", "advertisement", "sponsored"))}">{sentence(2, 14)}</div>',
                lambda: f'<div class="{some(("cookie-notice", "consent", "notice", "popup"))}"><p>{sentence(4, 16)}</p><button>{word()}</button></div>',
                lambda: f'<aside class="{some(("sidebar", "widget", ""))}"><h3>{sentence(1, 3)}</h3>{menu()}<p>{sentence(3, 25)}</p></aside>',
                lambda: f'<div id="{some(("sidebar", "related", "recommended"))}">{menu()}</div>',
                lambda: f'<form><label>{word()}</label><input name="a"><button>{word()}</button>{sentence(1, 5)}</form>',
                lambda: f'<div class="breadcrumbs">{link()} / {link()}</div>',
                lambda: f'<div id="{some(("comments", "replies", "disqus"))}">' + "".join(f'<div class="comment"><p>{sentence(2, 40)}</p></div>' for _ in range(rng.randint(1, 4))) + "</div>",
                lambda: f'<{some(("section", "div"))}><h{(level := some((2, 3)))}>{some(("Comments", "3 Comments", "12 comments", "Replies", "Responses", "Discussion"))}</h{level}>' + "".join(f"<div><p>{sentence(2, 60)}</p></div>" for _ in range(rng.randint(1, 12))) + "</section></div>",
                lambda: f'<section class="{some(("comments", "comment-list", "post-comments"))}"><h2>{sentence(1, 2)}</h2>' + "".join(f'<div class="comment"><p>{sentence(5, 60)}</p></div>' for _ in range(rng.randint(3, 14))) + "</section>",
                lambda: f'<{some(("section", "div"))}><h{(level := some((2, 3)))}>{some(("Comments", "3 Comments", "12 comments", "Replies", "Responses", "Discussion"))}</h{level}>' + "".join(f"<div><p>{sentence(2, 60)}</p></div>" for _ in range(rng.randint(1, 12))) + "</section></div>",
                lambda: f'<section class="{some(("comments", "comment-list", "post-comments"))}"><h2>{sentence(1, 2)}</h2>' + "".join(f'<div class="comment"><p>{sentence(5, 60)}</p></div>' for _ in range(rng.randint(3, 14))) + "</section>",
                lambda: f'<section class="comments"><h2>{sentence(1, 2)}</h2>' + "".join(f"<article><p>{sentence(2, 40)}</p></article>" for _ in range(rng.randint(1, 4))) + "</section>",
            )
        )()

    body = article()
    shape = rng.random()
    names = misnamed() if rng.random() < 0.5 and "<h1>" in body else ""
    if shape < 0.5:
        body = f"<article{names}>{body}</article>"
    elif shape < 0.65:
        body = f"<main{names}><article>{body}</article></main>"
    elif shape < 0.75 and names:
        body = f"<{(tag := some(('section', 'div')))}{names}>{body}</{tag}>"
    elif shape < 0.9:
        body = f'<div class="{some(("content", "post-body", "entry-content", "main-text", "article-body"))}">{body}</div>'
    else:
        body = f'<main id="main">{body}</main>'
    top = [f"<nav>{menu()}</nav>" if rng.random() < 0.7 else f'<div class="{some(("menu", "nav", "navbar"))}">{menu()}</div>']
    if rng.random() < 0.5:
        top.insert(rng.randint(0, 1), f"<header>{sentence(1, 5)}{menu() if rng.random() < 0.4 else ''}</header>")
    before = [noise() for _ in range(rng.randint(0, 2))]
    after = [noise() for _ in range(rng.randint(0, 2))]
    foot = f"<footer>&copy; {word()} &middot; {sentence(1, 12)}</footer>" if rng.random() < 0.9 else f'<div id="footer">{sentence(1, 12)}</div>'
    inner = "".join(top + before) + body + "".join(after) + foot
    if "<h1>" in body and rng.random() < 0.3:
        wrapper = some(("div", "div", "section", "form"))
        inner = f"<{wrapper}{misnamed() if rng.random() < 0.7 else ''}>{inner}</{wrapper}>"
    page = f"<body{misnamed() if rng.random() < 0.4 else ''}>"
    return f"<html><head><title>{sentence(1, 5)}</title></head>{page}" + inner + ("</body></html>" if rng.random() < 0.9 else ""), body


def _generated_fragment(rng: random.Random) -> str:
    """A source without tags of page and body: loose marked text, with a menu, a footer or an advert at times."""
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(1, 9)))
    line = lambda: " ".join(word() for _ in range(rng.randint(1, 40))).capitalize() + rng.choice((".", ".", "!", ""))
    body = "<br>".join("q" + line() for _ in range(rng.randint(1, 8)))
    if rng.random() < 0.3:
        body += "".join(f"<p>q{line()}</p>" for _ in range(rng.randint(1, 3)))
    before = "<nav><ul>" + "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(rng.randint(2, 6))) + "</ul></nav>" if rng.random() < 0.3 else ""
    after = rng.choice((f"<footer>{line()}</footer>", f'<div class="ad">{line()}</div>', "", "", ""))
    return before + body + after


@lru_cache(maxsize=1)
def trained(pages: int = TRAINING_PAGES, seed: int = 10) -> boosting.Boosted:
    """Trees fitted on generated pages: a node is main text if its subtree holds any."""
    rng = random.Random(seed)
    xs, ys = [], []
    sources = [_generated_page(rng)[0] for _ in range(pages)] + [_generated_fragment(rng) for _ in range(pages // 4)]
    for source in sources:
        tree = parse(source)
        y = np.zeros(len(tree.tag))
        for node, text in zip(tree.block_node, tree.block_text, strict=True):
            if text.startswith("q"):
                while node >= 0 and not y[node]:
                    y[node] = 1
                    node = tree.parent[node]
        xs.append(features(tree))
        ys.append(y)
    return boosting.fit(np.concatenate(xs), np.concatenate(ys))


def main_texts(sources: list[str | None], model: boosting.Boosted) -> list[str]:
    """Main text of each page: its blocks in page order, one a line."""
    trees = [parse(s or "") for s in sources]
    if not trees:
        return []
    p = model.predict(np.concatenate([features(t) for t in trees]))
    out, at = [], 0
    for tree in trees:
        keep = decode(tree, p[at : at + len(tree.tag)])
        at += len(tree.tag)
        out.append("\n".join(text for node, text in zip(tree.block_node, tree.block_text, strict=True) if keep[node]))
    return out


def extract(pages: DataFrame, *, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """Rows of pages (struct row) with text, the main text of the whole source.

    A null or empty source, or one without main text, gives the empty text.
    """
    held = pages.sparkSession.sparkContext.broadcast(trained())

    def run(rows: pa.StructArray) -> list[pa.Array]:
        column = pc.struct_field(rows, [html_col]).cast(pa.string())
        return [pa.array([t for s in range(0, len(column), 256) for t in main_texts(column.slice(s, 256).to_pylist(), held.value)], pa.string())]

    return mapped(pages, run, "text string", list(pages.columns) if carry is None else carry)


def main_content(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    found = extract(pages, carry=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
