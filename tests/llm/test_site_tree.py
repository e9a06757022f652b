"""Main text of made-up pages, and the style tree against plain counting."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from parcelflow.llm import site_tree as S

PAGES = "page_id long, url string, html string"

ARTICLE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head><body>'
    '<header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <p>no</p> -->'
    '<div class="cookie-notice">Accept</div><aside>Side</aside>'
    "<article><header><h1>Head &amp; line</h1></header><p><b>One  two\nthree<br>four<br><p>Five&nbsp;six &lt;x&gt; &#233;&copy;</p>"
    "<form><label>Name</label><input></form><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><div class='ad'>Buy</div>"
    '<pre> x\n y </pre>tail<section id="comments"><p>First!</p></section></article><footer>&copy; F</footer></body></html>'
)
TEXT = "Head & line\n\nOne two three four\n\nFive six <x> é©\n\na\n\nb\n\nc\n\nd\n\nx y\n\ntail"


def soup(i, word):
    return (
        f'<body><div class="top"><a>Home</a> <a>About</a></div><div class="body"><h2>Story {word}</h2><div>Text of {word}, '
        f'number {i}.</div></div><div class="bottom">All rights reserved</div></body>'
    )


def texts(spark, rows):
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "'clash' as text", "1 as n_chars").repartition(3)
    out = S.page_texts(frame).collect()
    assert all(r.n_chars == len(r.text) for r in out)
    return sorted(((r.page_id, r.url, r.text) for r in out), key=str)


def test_declared_roles_and_odd_markup(spark):
    long_page = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    cases = {
        1: (ARTICLE, TEXT),
        2: (None, ""),
        3: ("", ""),
        4: ("plain <i>in</i>line & text", "plain inline & text"),
        5: ("<p>a<div>b</p>c</div></x>d <unknown>e</unknown><p title='>'>f", "a\n\nb\n\nc\n\nd e\n\nf"),
        6: ("<article>one</article><p>out</p><main>two</main>", "one\n\ntwo"),
        7: ("<p>unclosed <a href='x>still</p><p>z", None),
        8: (long_page, "\n\n".join(["word"] * 30_000)),
        9: ("<nav>only menu</nav>", ""),
        10: ("<p>x</p><script>never ends <p>y</p>", "x"),
        11: ("<button>b</button><p>a <span class='share'>Share</span> z</p>", "a z"),
        13: ("<article>teaser</article><div>the body<p>of the page</p></div>", "teaser\n\nthe body\n\nof the page"),
        14: ("<article></article><div>body</div>", "body"),
        15: ("<div>short</div><article>the article</article>", "the article"),
        12: ("<p>1 &lt 2 &bogus; &#x41;</p>", "1 < 2 &bogus; A"),
    }
    rows = [(i, None if i % 2 else "no host", h) for i, (h, _) in cases.items()]
    got = {i: t for i, _, t in texts(spark, rows)}
    for i, (_, want) in cases.items():
        assert want is None or got[i] == want, i


def test_attributes_by_name_and_whole_words():
    text = lambda h: "\n\n".join(t for _, r, t in S.parse(h)[0] if r)
    for mark in (
        'style="overflow:hidden"', 'title="hidden gems"', 'href="/p?id=search"', "href=/x?class=nav", 'data-id="related"', 'class="with-sidebar"',
        'class="no-sidebar has-comments"', 'aria-hidden="false"', "data-x='a class=\"nav\"'",
    ):
        assert text(f"<body {mark}><article><p {mark}>a <a {mark}>b</a></p></article></body>") == "a b", mark
        assert text(f"<div {mark}>a</div>") == "a", mark
    for mark in ("hidden", 'hidden=""', 'class="x sidebar"', "CLASS=cookie-notice", 'id="comments"', "role='search'", 'title="x" hidden'):
        assert text(f"<article>a<div {mark}>b</div></article>") == "a", mark
    assert text('<div class="sidebar">x<div><article>a</article></div></div>') == "a"
    assert text('<div id="overlay"><main>a<div class="related"><article>b</article></div></main></div>') == "a"
    for mark in (
        'class="comment-list"', 'class="comments-area"', 'id="post-comments"', 'id="comment-17"', 'class="commentList"', 'class="ad-2"',
        'class="site-footer"',
    ):
        assert text(f"<article>a<div {mark}>b</div></article>") == "a", mark
        assert text(f"<article>a</article><div {mark}>{'b' * 99}</div>") == "a", mark
    for mark in ('class="post-body"', 'id="article"', 'class="list"', 'class="has-comments no-ads"', 'class="3"'):
        assert text(f"<div {mark}>a</div>") == "a", mark
    assert text("<article><p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z</p></article>") == "x y=2 z"
    for outer in ("<nav>", "<div hidden>", "<div role='search'>", "<aside class='sidebar'>", "<nav><div class='menu'>"):
        assert text(f"{outer}<article>b</article>") == "", outer


def test_tree_removes_what_repeats_on_a_host(spark, monkeypatch):
    rows = [(i, f"http://A.example/{i}", soup(i, f"w{i}")) for i in range(12)]
    rows += [(50, "http://b.example/x", soup(50, "only")), (None, "http://b.example/y?z", None), (0, rows[0][1], rows[0][2])]
    want = [(i, u, f"Story w{i}\n\nText of w{i}, number {i}.") for i, u, _ in rows[:12]]
    want += [(50, rows[12][1], "Home About\n\nStory only\n\nText of only, number 50.\n\nAll rights reserved"), (None, rows[13][1], ""), want[0]]
    assert texts(spark, rows) == sorted(want, key=str)
    monkeypatch.setattr(S, "BROADCAST_NODES", 0)  # by join
    assert texts(spark, rows) == sorted(want, key=str)
    assert texts(spark, []) == []


def plain_importance(pages):
    """``{(host, path): (role, pages, importance)}`` by counting one by one."""
    layouts, contents = defaultdict(Counter), defaultdict(Counter)
    roles = defaultdict(int)
    for host, page in pages:
        blocks, styles = S.parse(page)
        for p, (r, c) in styles.items():
            layouts[host, p][c] += 1
            roles[host, p] = max(roles[host, p], r)
        for p, t in {(p, t) for p, _, t in blocks if p in styles}:
            contents[host, p][t] += 1
    want = {}
    for (host, p), texts_ in contents.items():
        m = sum(layouts[host, p].values())
        if m == 1:
            want[host, p] = roles[host, p], m, 1.0
            continue
        layout = -sum(k / m * math.log(k / m, m) for k in layouts[host, p].values())
        repeat = sum(k * math.log(k, m) for k in texts_.values()) / sum(texts_.values())
        want[host, p] = roles[host, p], m, 0.1 * layout + 0.9 * (1 - repeat)
    return want


def test_importance_against_plain_counting(spark):
    pages = [("h", soup(i, f"w{i % 3}")) for i in range(9)] + [("g", ARTICLE)]
    frame = spark.createDataFrame([(i, f"http://{h}/", p) for i, (h, p) in enumerate(pages)], PAGES)
    want = {(h, S._code(p)): x for (h, p), (_, _, x) in plain_importance(pages).items()}
    got = {(r.host, r.path): r.importance for r in S.style_tree(frame).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def framed(i, own, body):
    """A page whose article holds a repeated box, and whose body may lie beside the article."""
    box = '<div class="rights">Sent to you by the same desk every day</div>'
    beside = f"<div class='text'>{'Long story of ' + own + ' ' + 'x' * 99}</div>" if body else ""
    return f"<body><div class='line'>Always here</div><article><h2>{own}</h2>{box}</article>{beside}<div class='end'>End</div></body>"


def test_extraction_against_plain_version(spark):
    pages = [("inside", framed(i, f"w{i}", False)) for i in range(8)]
    pages += [("beside", framed(i, f"w{i}", i % 2 == 0)) for i in range(8)]
    pages += [("alike", framed(0, "same", True))] * 6 + [("few", framed(i, f"w{i}", True)) for i in range(4)]
    pages += [("soup", soup(i, f"w{i % 5}")) for i in range(10)]
    nodes, want = plain_importance(pages), []
    for i, (host, page) in enumerate(pages):
        best = max((x for (h, _), (r, _, x) in nodes.items() if h == host and r == S.MAIN), default=0)
        left = {S.OPEN: [], S.MAIN: []}
        for k, (p, role, text) in enumerate(S.parse(page)[0]):
            r, m, x = nodes[host, p]
            gone = m >= 5 and (x < 0.35 if r == S.OPEN else x < 0.15 and best >= 0.5)
            if not gone:
                left[role].append((k, text))
        sizes = {r: sum(len(t) for _, t in b) for r, b in left.items()}
        both_ = not left[S.MAIN] or sizes[S.OPEN] >= 2 * sizes[S.MAIN]
        want.append((i, f"http://{host}/", "\n\n".join(t for _, t in sorted(left[S.MAIN] + left[S.OPEN] * both_))))
    got = texts(spark, [(i, f"http://{h}/", p) for i, (h, p) in enumerate(pages)])
    assert got == sorted(want, key=str)
    text = {i: t for i, _, t in got}
    assert text[1] == "w1" and text[8].startswith("w0\n\nLong story of w0") and text[9] == "w1"
    assert "same desk" in text[16] and "End" not in text[10]
