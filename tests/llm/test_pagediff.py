"""Main text: markup cases, differencing against plain neighbours, brute-force subsequences."""

import random

import pytest

from studytrail.llm import pagediff as P

PAGES = "page_id long, url string, html string, print long, drops string"


def extract(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], PAGES)
    return sorted(((r.page_id, r.url, r.text, r.n_chars) for r in P.extracted(df).collect()), key=repr)


CASES = [
    ("<article><h1>T</h1><p>a  b\n c</p></article>", ["T", "a b c"]),
    ("<body><nav>m</nav><article><p>a &amp; b &lt;&#8364;&#x41;&nbsp;c</p></article><footer>&copy; f</footer>", ["a & b <€A c"]),
    ("<header>h</header><main><header><h1>T</h1></header>x<aside>s</aside>y</main>", ["T", "x", "y"]),
    ("<article><p>one<p>two<br>three<ul><li>4<li>5</ul>", ["one", "two", "three", "4", "5"]),
    ("<article><p>a<script>if (a < b) '</p>'</script>b</p><style>p{}</style><form>f<input></form></article>", ["ab"]),
    ("<article><div class='ad'>buy <div>now</div></div><p>text</p><div class=\"cookie-notice\">c</div></article>", ["text"]),
    ("<article><p>text</p></article><section id=comments><article><p>reader</p></article></section>", ["text"]),
    ("<nav><ul><li>m<article><p>text</article>", ["text"]),
    ("<article><p title='a>b'>x <b>bold</b><i>i</i>talic</p>", ["x bolditalic"]),
    ("<article><!-- no --><p>x</p><!-- open <p>y</p>", ["x"]),
    ("<article><p>cut &am", ["cut &am"]),
    ("<article><p>cut <a href='x", ["cut"]),
    ("<article><p class=notice>n<p>text</article>", ["text"]),
    ("<article><TABLE><TR><TD>1<TD>2</TABLE></ARTICLE><p>out</p>", ["1", "2"]),
    ("<div hidden>h</div><div style='display: none'>n</div><p>open</p>", ["open"]),
    ("no markup < at & all", ["no markup < at & all"]),
    ("<article></article>", []),
    ("", []),
    (None, []),
]


@pytest.mark.parametrize("html,lines", CASES)
def test_markup(html, lines):
    assert P.text_lines(html)[1] == lines


def test_every_row_comes_out(spark):
    rows = [(i, f"http://h{i}/x", html) for i, (html, _) in enumerate(CASES)]
    want = [(i, f"http://h{i}/x", "\n".join(lines), len("\n".join(lines))) for i, (_, lines) in enumerate(CASES)]
    assert extract(spark, rows) == sorted(want, key=repr)


def page(*lines):
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>"


def test_lines_of_the_nearest_page_go(spark):
    rows = [
        (1, "http://h/a/1", page("Menu", "first text", "Imprint")),
        (2, "http://h/a/2", page("Menu", "second text", "Imprint")),
        (3, "http://h/b/1", page("Other menu", "third text")),
        (4, "http://k/a/1", page("Menu", "alone on its host", "Imprint")),
        (5, "http://h/a/10", page("Menu", "tenth text", "second text", "Imprint")),
    ]
    texts = {r[0]: r[2] for r in extract(spark, rows)}
    # /a/10 follows /a/2, whose text it repeats.
    assert texts == {1: "first text", 2: "second text", 3: "Other menu\nthird text", 4: "Menu\nalone on its host\nImprint", 5: "tenth text"}


def test_marked_articles_keep_shared_lines(spark):
    rows = [(i, f"http://h/{i}", f"<p>Menu</p><article><p>Same</p><p>t{i}</p></article>") for i in range(4)]
    assert [r[2] for r in extract(spark, rows)] == [f"Same\nt{i}" for i in range(4)]


def test_copies_and_odd_rows(spark):
    same = page("Menu", "text")
    rows = [(1, "http://h/1", same), (1, "http://h/1", same), (2, "http://h/2", same), (3, None, page("a")), (3, None, page("b")),
            (None, "http://[", page("c")), (4, "not a url", None)]
    want = [(1, "http://h/1", "Menu\ntext", 9)] * 2 + [(2, "http://h/2", "Menu\ntext", 9), (3, None, "a", 1), (3, None, "b", 1),
            (None, "http://[", "c", 1), (4, "not a url", "", 0)]
    assert extract(spark, rows) == sorted(want, key=repr)
    assert extract(spark, []) == []


def test_one_host_over_many_ranges(spark):
    """The hot host's order is cut; neighbours meet across the cuts."""
    rows = [(i, f"http://h/p/{i}", page("Menu", f"text {i}", "Imprint")) for i in range(300)]
    assert {r[2] for r in extract(spark, rows)} == {f"text {i}" for i in range(300)}


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(rng.randrange(9))]
        b = [rng.randrange(4) for _ in range(rng.randrange(9))]
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
        kept = [a[i] for i in sorted(P.common(a, b))]
        rest = iter(b)
        assert len(kept) == size[-1][-1] and all(x in rest for x in kept)


def test_long_page_is_whole(spark):
    html = "<article>" + "".join(f"<p>line {i}</p>" for i in range(30_000)) + "</article>"
    (row,) = extract(spark, [(1, "http://h/1", html)])
    assert row[2] == "\n".join(f"line {i}" for i in range(30_000))


def test_article_text_with_telling_names_stays():
    """Slugs of headings and sections, counts, titles; but parts named as a whole go."""
    keeps = [
        '<h2 id="search-algorithms">a</h2>', '<section id="related-work">a</section>', '<p id="ad-hoc">a</p>', '<h3 id="navigation">a</h3>',
        '<div class="comment-count">a</div>', '<p>a <a title="a hidden gem">b</a></p>', '<p class="no-sidebar">a</p>',
        "<p style='color: red' data-x='display:none'>a</p>", '<p id="alert-levels">a</p>', '<div class="share-price">a</div>',
    ]
    goes = [
        '<div class="comments">a</div>', '<div id="comment-list">a</div>', '<div class="ad-slot-2">a</div>', '<p hidden>a</p>',
        '<div class="reader-comments">a</div>', '<div class="x cookie-notice">a</div>', '<ul class=related-posts><li>a</ul>',
        '<p STYLE="display : none">a</p>', '<div role="complementary">a</div>', "<div class='newsletter-form'>a</div>",
    ]
    for part, want in [(k, ["a b"] if "<a" in k else ["a"]) for k in keeps] + [(g, []) for g in goes]:
        assert P.text_lines(f"<article>{part}<p>z</p></article>") == (True, [*want, "z"]), part


@pytest.mark.parametrize("role", ['role="main"', "role='main'", "role=main", 'class="x" ROLE="Main"'])
def test_role_main_marks_the_article(role):
    assert P.text_lines(f"<p>Menu</p><div {role}><p>a</p></div>") == (True, ["a"])


def test_copies_lose_the_same_lines(spark):
    """Copies beside one page that differs: equal pages have equal texts, however many there are."""
    rows = [(i, f"http://h/a/{i}", page("Menu", "copied text", "Imprint")) for i in range(1, 5)]
    rows += [(9, "http://h/a/9", page("Menu", "other text", "Imprint")), (20, "http://h/b", page("Menu", "copied text", "Imprint"))]
    texts = {r[0]: r[2] for r in extract(spark, rows)}
    assert texts == {**{i: "copied text" for i in (1, 2, 3, 4, 20)}, 9: "other text"}


def plain(nodes, hidden=False):
    """Blocks of a tree of (element, attributes, children or text), as the rules have them."""
    out = []
    for name, attributes, inner in nodes:
        gone = hidden or name in ("nav", "footer", "aside", "script") or attributes in (' class="ad-box"', " hidden")
        if isinstance(inner, str):
            out += [] if gone else [" ".join(inner.split())]
        else:
            out += plain(inner, gone)
    return out


def written(nodes):
    return "".join(f"<{n}{a}>{i if isinstance(i, str) else written(i)}</{n}>" for n, a, i in nodes)


def test_random_page_trees():
    """Brute force over random nested pages: every block outside the parts that go, once, in order."""
    rng = random.Random(9)

    def tree(depth):
        nodes = []
        for _ in range(rng.randrange(1, 4)):
            if depth and rng.random() < 0.5:
                name = rng.choice(["div", "section", "ul", "nav", "aside", "footer"])
                nodes.append((name, rng.choice(["", ' class="ad-box"', ' id="search-work"', " hidden"]), tree(depth - 1)))
            else:
                nodes.append((rng.choice(["p", "h2", "div"]), rng.choice(["", ' id="ad-hoc"', ' title="hidden"']), f"t{rng.randrange(99)}  x\n"))
        return nodes

    for _ in range(300):
        nodes = tree(3)
        marked, lines = P.text_lines(f"<nav><p>Menu</p></nav><article>{written(nodes)}</article><footer>Imprint</footer>")
        want = plain(nodes)
        assert lines == want if want else not marked
