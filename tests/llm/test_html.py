import random

import numpy as np

from tessera.llm import boosting, html_extract
from tessera.llm.html_tree import parse


def test_blocks_of_broken_markup():
    tree = parse("<body><nav><a href='/x'>Menu</a></nav><script>var t=\"</p>\";</script><p><b>One &amp;\n two<br><p>Three<!-- x --> more</p></div>tail")
    assert tree.block_text == ["Menu", "One & two", "Three more", "tail"]
    assert [tree.tag[k] for k in tree.block_node] == ["nav", "p", "p", "body"]


def test_entities_white_space_and_lists():
    tree = parse("<ul><li>a&nbsp;b<li>&lt;c&gt;  &eacute;</ul><table><tr><td>1<td>2<tr><td>3</table>")
    assert tree.block_text == ["a b", "<c> é", "1", "2", "3"]
    assert parse("").block_text == [] and parse("<p").block_text in ([], ["<p"])


def test_generated_pages_held_out():
    model, rng = html_extract.trained(), random.Random(1234)
    wrong = total = 0
    for _ in range(150):
        tree = parse(html_extract._generated_page(rng)[0])
        keep = html_extract.decode(tree, model.predict(html_extract.features(tree)))
        for node, text in zip(tree.block_node, tree.block_text, strict=True):
            total += 1
            wrong += keep[node] != text.startswith("q")
    assert wrong / total < 0.02


def test_no_kept_node_in_a_dropped_one():
    rng = np.random.default_rng(1)
    tree = parse("<div><p>a</p><div><p>b</p><ul><li>c<li>d</ul></div></div><footer><p>e</p></footer>")
    for _ in range(200):
        keep = html_extract.decode(tree, rng.random(len(tree.tag)))
        assert all(keep[tree.parent[k]] for k in range(1, len(keep)) if keep[k])


def test_decoding_is_the_best_labelling():
    import itertools

    rng = np.random.default_rng(2)
    tree = parse("<div><p>a</p><div><p>b</p></div></div><p>c</p>")
    for _ in range(50):
        p = rng.uniform(0.05, 0.95, len(tree.tag))
        score = lambda x: sum(np.log(p[k] if v else 1 - p[k]) for k, v in enumerate(x) if k)
        allowed = [x for x in itertools.product((False, True), repeat=len(p)) if x[0] and all(x[tree.parent[k]] or not x[k] for k in range(1, len(p)))]
        assert abs(score(html_extract.decode(tree, p)) - max(map(score, allowed))) < 1e-9


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    assert ((model.predict(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_pages(spark):
    page = "<html><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div><article><h1>Title</h1><p>First &amp; foremost, text.</p><aside>See also</aside><p>Second\n paragraph.</p></article><div id='comments'><div class='comment'><p>Nice one!</p></div></div><form><label>Mail</label><button>Go</button></form><footer>&copy; x</footer></body></html>"
    rows = [(1, "u", page, "t"), (2, None, None, "t"), (3, "v", "", "t"), (4, "w", "<article><p>" + "long text. " * 20_000, "t"), (1, "u", page, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.url, r.text, r.n_chars) for r in html_extract.main_content(pages).collect() if r.url)
    want = "Title\nFirst & foremost, text.\nSecond paragraph."
    assert got[:2] == [(1, "u", want, len(want))] * 2
    assert got[2] == (3, "v", "", 0) and got[3][3] == len("long text. " * 20_000) - 1
    assert html_extract.main_content(pages).count() == 5
    assert html_extract.main_content(pages.limit(0)).count() == 0


def test_loose_text_outside_the_body_is_kept():
    model = html_extract.trained()
    loose = "First line of the text, long enough.<br>Second <b>line</b> here.<br>Third."
    want = {
        loose: "First line of the text, long enough. Second line here. Third.",
        "A short note.": "A short note.",
        "Start<p>One, two.</p>end": "Start\nOne, two.\nend",
        "<html><head><title>x</title></head>" + loose + "</html>": "First line of the text, long enough. Second line here. Third.",
        "<html><body><article><h1>T</h1><p>Some text, first.</p></article></body></html>" + loose: "T\nSome text, first.\nFirst line of the text, long enough. Second line here. Third.",
        "<nav><ul><li><a href='/'>Home</a></li></ul></nav>" + loose + "<footer>copy</footer>": "First line of the text, long enough. Second line here. Third.",
    }
    assert dict(zip(want, html_extract.main_texts(list(want), model), strict=True)) == want
    rng = random.Random(77)
    pages = [html_extract._generated_fragment(rng) for _ in range(150)]
    wrong = total = 0
    for page in pages:
        tree = parse(page)
        keep = html_extract.decode(tree, model.predict(html_extract.features(tree)))
        for node, text in zip(tree.block_node, tree.block_text, strict=True):
            total += 1
            wrong += keep[node] != text.startswith("q")
    assert wrong / total < 0.02


def test_formulas_and_objects_are_text():
    page = "<article><h1>T</h1><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be even.</p><object data='a.pdf'><param name='p'>The text in its place.</object></article>"
    assert parse(page).block_text == ["T", "Let x=2 be even.", "The text in its place."]
    assert html_extract.main_texts([page], html_extract.trained()) == ["T\nLet x=2 be even.\nThe text in its place."]


def test_one_body_holds_what_stands_outside_it():
    tree = parse("<b>before</b><html><body class='post'><div>in</div></body></html>after</body><p>late</p>")
    assert tree.block_text == ["before", "in", "after", "late"]
    assert tree.tag.count("body") == 1 and tree.tag[tree.block_node[2]] == "body"


def test_nothing_after_an_unclosed_element_is_lost():
    want = "T\nPara one, first.\nAfter it, second.\nLast, third."
    model = html_extract.trained()
    for tag in ("object data=x", "svg", "math", "iframe src=x", "textarea", "noscript", "template", "title", "video"):
        page = f"<article><h1>T</h1><p>Para one, first.</p><{tag}><p>After it, second.</p><p>Last, third.</p></article>"
        assert html_extract.main_texts([page], model) == [want], tag
    closed = "<p>a<svg><title>x</title><text>label</text></svg>b<script>var x='<p>';</script>c<style>p{}</style>d<iframe>old</iframe>e"
    assert parse(closed).block_text == ["abcd", "e"]
    assert parse("<p>a<script>b<p>c").block_text == ["a"]
    assert parse("<p>a <x-y>b</x-y> c<x-y class='ad'>d</x-y>e 3 < 4 &#0000066; &#" + "9" * 9000 + ";").block_text == ["a b c", "d", "e 3 < 4 B �"]
    assert parse("<p style='overflow:hidden'>a").tokens[-1] == () and parse("<p hidden>a").tokens[-1] == ("hidden",)


def test_hostile_sources_take_linear_time():
    """Four times the source takes about four times the processor's time; twelve times would be far from linear."""
    import time

    def spent(source):
        began = time.process_time()
        parse(source)
        return time.process_time() - began

    n = 10_000
    for make in (
        lambda n: "<a '" * n, lambda n: '<a x="' * n, lambda n: '<a x=">" ' * n, lambda n: "<svg>" * n + "<p></svg>", lambda n: "<div>" * n + "<li></li>" * n, lambda n: "<li><ul>" + "<div>" * n + "<li></li>" * n,
        lambda n: "<div>" * n + "</x>" * n, lambda n: "<!--" * n, lambda n: "<iframe>" * n, lambda n: "<p " + "a" * 10 * n + ">", lambda n: "<" * 10 * n, lambda n: "&#" + "9" * 10 * n,
    ):
        small = min(spent(make(n)) for _ in range(2))
        assert spent(make(4 * n)) < 12 * max(small, 0.01), make(3)


BODY = "<h1>A title of it</h1><p>The first paragraph says, at some length, what this is about.</p><p>The second goes on about it, with a comma or two, and ends.</p>"
TEXT = "A title of it\nThe first paragraph says, at some length, what this is about.\nThe second goes on about it, with a comma or two, and ends."
NAV, FOOT = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>", "<footer>&copy; 2024 by us</footer>"


def test_an_article_is_not_judged_by_a_word_in_a_name():
    pages = [
        f'<body>{NAV}<article class="post hentry category-news tag-politics">{BODY}</article>{FOOT}</body>',
        f'<body class="page no-sidebar">{NAV}<article>{BODY}</article>{FOOT}</body>',
        f'<body class="home has-sidebar">{NAV}<main>{BODY}</main><aside class="sidebar"><p>Read this too</p></aside>{FOOT}</body>',
        f'<body><div class="layout with-sidebar">{NAV}<main>{BODY}</main></div>{FOOT}</body>',
        f'<body class="header-fixed">{NAV}<article>{BODY}</article>{FOOT}</body>',
        f'<body><form action="/" method="post">{NAV}<div class="content">{BODY}</div>{FOOT}</form></body>',
        f'<body>{NAV}<article class="post comment-open">{BODY}</article>{FOOT}</body>',
        f'<body>{NAV}<section class="notice board">{BODY}</section>{FOOT}</body>',
        f'<body class="menu-open sidebar-left">{NAV}<div id="wrap" class="site header-sticky"><article class="post share-enabled">{BODY}</article></div>{FOOT}</body>',
        f'<body>{NAV}<article>{BODY}</article><section><h2>3 Comments</h2><div><p>I think, as a reader, that this is so.</p></div><div><p>No, it is not, as anyone can see.</p></div></section>{FOOT}</body>',
        f'<body>{NAV}<article>{BODY}</article><div id="comments">' + '<div class="comment"><p>A long remark of a reader, who has much to say, and says it here.</p></div>' * 9 + f"</div>{FOOT}</body>",
        f'<body>{NAV}<div class="cookie-notice"><p>We use cookies here</p><button>Fine</button></div><article>{BODY}</article><div class="ad">Buy it now</div>{FOOT}</body>',
    ]
    model = html_extract.trained()
    for page, got in zip(pages, html_extract.main_texts(pages, model), strict=True):
        assert got == TEXT, page
    inner = BODY.replace("</h1>", "</h1><p class='share price'>The share price rose by two per cent, to nine.</p><figure><img src=a><figcaption class='caption'>What the picture shows, in a line.</figcaption></figure>")
    want = TEXT.replace("A title of it\n", "A title of it\nThe share price rose by two per cent, to nine.\nWhat the picture shows, in a line.\n")
    assert html_extract.main_texts([f"<body>{NAV}<article>{inner}</article>{FOOT}</body>"], model) == [want]


class Plain(__import__("html.parser", fromlist=["HTMLParser"]).HTMLParser):
    """Blocks of the first article by another parser: for pages whose only noise stands outside it."""

    def __init__(self):
        super().__init__()
        self.on, self.bits, self.blocks = False, [], []

    def border(self):
        text = " ".join("".join(self.bits).split())
        self.blocks += [text] if self.on and text else []
        self.bits = []

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "p", "h1", "div", "ul", "li"):
            self.border()
            self.on = self.on or tag == "article"
        elif tag == "br":
            self.bits.append(" ")

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1", "div", "ul", "li"):
            self.border()
            self.on = self.on and tag != "article"

    def handle_data(self, data):
        self.bits.append(data)


def test_given_pages_match_another_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.main_content(pages).collect()}
    right = made = wanted = 0
    for r in pages.collect():
        plain = Plain()
        plain.feed(r.html or "")
        plain.border()
        blocks = got[r.page_id].split("\n") if got[r.page_id] else []
        right += sum(a == b for a, b in zip(blocks, plain.blocks, strict=False))
        made, wanted = made + len(blocks), wanted + len(plain.blocks)
    assert 2 * right / (made + wanted) > 0.999
