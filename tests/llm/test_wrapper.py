import random
from functools import cache

from vuelometria.llm.dom import Element, blocks, parse
from vuelometria.llm.wrapper import constant_nodes, extract, extract_articles, induce, layouts, simple_tree_matching

PAGE = """<!DOCTYPE html><html><head><title>{t}</title><style>p{{x}}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home {n}</a></li><li><a>News</a></li></ul></nav><div class="site-header">Daily {n}</div>
<div class="cookie-notice">We use cookies</div><div class="page"><div class="story"><h1>{t}</h1><p>First &amp; {n} <b>bold<br>part
<p>Second&nbsp;{n} line <a href="a>b">link</a> end<ul><li>one<li>two</ul><div class="ad">Buy {n}</div>
<form><input name=q><p>Search</p></form><aside>See also {n}</aside><section id="comments"><p>I like {n}</p></section>
<!-- <p>hidden</p> --></div></div><footer>&copy; site {n}</footer></body></html>"""
TEXT = "{t}\nFirst & {n} bold part\nSecond {n} line link end\none\ntwo"


def page(n):
    return PAGE.format(t=f"Title {n}", n=n * 37)


def test_wrapper_finds_the_varying_region():
    assert induce([parse(page(n)) for n in range(5)]) == ["div.page", "div.story"]
    a, b = parse(page(1)), parse(page(2))
    assert simple_tree_matching(a, b) == simple_tree_matching(b, a) > 20
    assert simple_tree_matching(parse("<p>x"), parse("<i>x</i>")) == 1


def test_articles(spark):
    rows = [(n, f"http://h.org/{n}", page(n)) for n in range(20)] + [(50, "http://h.org/50", page(3))] * 2
    other = "<html><body><main><p>Only {0} here</p></main><footer>f</footer>"
    rows += [(90, "http://h.org/x", other.format(1)), (91, None, other.format(2)), (92, "http://z.org", None), (93, "http://z.org", "")]
    rows += [(94, "http://y.org", "no markup at all &lt; 1"), (95, "http://y.org", "<article>cut <p>off <scr"), (None, None, None)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, path string, host string")
    for broadcast in (100, 0):
        got = {r.page_id: r for r in extract_articles(pages, broadcast_hosts=broadcast).collect()}
        for n in range(20):
            assert got[n].text == TEXT.format(t=f"Title {n}", n=n * 37) and got[n].n_chars == len(got[n].text)
        assert got[50].text == got[3].text and got[90].text == "Only 1 here" and got[91].text == "Only 2 here"
        assert got[92].text == got[93].text == got[None].text == "" and got[92].n_chars == 0
        assert got[94].text == "no markup at all < 1" and got[95].text.startswith("cut\noff")
    assert extract_articles(pages).count() == len(rows) and extract_articles(pages.limit(0)).collect() == []


def test_copies_on_a_host_are_no_template():
    path = induce([parse(page(1))] * 4)
    assert extract(page(1), path) == TEXT.format(t="Title 1", n=37)


def test_long_page():
    body = "".join(f"<p>paragraph {i} of the page" for i in range(20000))
    assert len(extract(f"<body><article>{body}</article>", ["article"]).split("\n")) == 20000
    assert blocks(parse("<div>" * 5000 + "x")) == ["x"]


def test_deep_pages_and_odd_markup(spark):
    deep = "<body>" + "<div>" * 1500 + "deep text" + "</div>" * 1500 + "</body>"
    odd = "<body><article><p title=don't>first</p><p>it's <math><mi>x</mi></math></p><p title='a>b' lang=\"x\">last</p></article></body>"
    rows = [(i, f"http://deep.org/{i}", page) for i, page in enumerate([deep, deep.replace("deep", "other"), odd])]
    got = {r.page_id: r.text for r in extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "deep text", 1: "other text", 2: "first\nit's x\nlast"}


def test_matching_counts_nodes_to_a_depth():
    a = parse("<div>" * 300)
    assert simple_tree_matching(a, a) == 101 and simple_tree_matching(a, a, depth=3) == 4


def plain_matching(a, b):
    """Simple tree matching by its recursive definition."""

    @cache
    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), best(xs[1:], ys[1:]) + plain_matching(xs[0], ys[0]))

    return 1 + best(tuple(a.children), tuple(b.children)) if a.label == b.label else 0


def random_tree(rng, size):
    nodes = [Element("div")]
    for _ in range(size):
        child = Element(rng.choice(["div", "ul", "p"]))
        rng.choice(nodes[-4:]).inner.append(child)
        nodes.append(child)
    return nodes[0]


def test_matching_against_the_definition():
    rng = random.Random(7)
    for _ in range(60):
        a, b = random_tree(rng, 14), random_tree(rng, 14)
        pairs = []
        assert simple_tree_matching(a, b, pairs) == plain_matching(a, b) == len(pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert all(x.label == y.label for x, y in pairs)


def test_template_nodes_are_removed(spark):
    bare = "<body><div>Home Sport Money</div><div><h1>Story {0}</h1><p>Words of story {0}, told at length.</p></div><div>Copyright of the paper</div></body>"
    named = (
        "<body><div class=wrap><div class=masthead>The Paper, since 1900</div><div class='post post-{0}'><p>Item {0} is long enough.</p>"
        "<p>The same closing line.</p></div><div class=legalese>All rights reserved</div></div></body>"
    )
    rows = [(n, f"http://bare.org/{n}", bare.format(n)) for n in range(9)]
    rows += [(100 + n, f"http://named.org/{n}", named.format(n)) for n in range(9)]
    mixed = [(200 + n, f"http://mixed.org/{n}", (bare if n % 2 else named).format(n)) for n in range(24)]
    few = [(300 + n, f"http://few.org/{n}", bare.format(n)) for n in range(2)]
    copies = [(400 + n, f"http://copies.org/{n}", bare.format(1).replace("Home", f"Home{n}")) for n in range(5)]
    pages = spark.createDataFrame(rows + mixed + few + copies, "page_id long, url string, html string")
    for broadcast in (100, 0):
        got = {r.page_id: r.text for r in extract_articles(pages, broadcast_hosts=broadcast).collect()}
        story, item = "Story {0}\nWords of story {0}, told at length.", "Item {0} is long enough.\nThe same closing line."
        for n in range(9):
            assert got[n] == story.format(n) and got[100 + n] == item.format(n)
        for n in range(24):
            assert got[200 + n] == (story if n % 2 else item).format(n)
        # two pages do not tell what is template; an article that is on all pages is none
        assert got[300] == "Home Sport Money\n" + story.format(0) + "\nCopyright of the paper"
        assert all(story.format(1) in got[400 + n] for n in range(5))


def test_every_layout_of_a_host_has_a_wrapper(spark):
    def names(k):
        return [chr(97 + k // 26) + chr(97 + k % 26) + c for c in "abcdefg"]

    usual = '<body><div class=masthead>The Paper</div><div class=page><div class=story><h1>Story {0}</h1><p>Words of story {0}.</p></div></div></body>'
    # a short text where the usual layout has its article, the article in containers of its own
    other = (
        '<body><div class=masthead>The Paper</div><div class=page><div class=story>Ask the editors.</div><section class={1[0]}><div class={1[1]}>'
        '<div class={1[2]}>{1[2]}</div><div class={1[3]}><center class={1[4]}></center><div class={1[5]}><h2>Feature {0}</h2>'
        '<p>Words of feature {0} in layout {1[6]}, told at great length and with care.</p></div></div></div></section></div></body>'
    )
    rows = [(n, "http://one.org/", usual.format(n)) for n in range(60)]
    rows += [(1000 + 10 * k + n, "http://one.org/", other.format(n, names(k))) for k in range(40) for n in range(8)]
    alone = [(5000 + k, "http://one.org/", other.format(k, names(40 + k))) for k in range(3)]
    pages = spark.createDataFrame(rows + alone, "page_id long, url string, html string")
    for broadcast, sample in ((1000, 12), (0, 12), (1000, 1)):
        got = {r.page_id: r.text for r in extract_articles(pages, broadcast_hosts=broadcast, sample=sample).collect()}
        feature = "Feature {0}\nWords of feature {0} in layout {1}, told at great length and with care."
        for n in range(60):
            assert got[n].endswith(f"Story {n}\nWords of story {n}.")
        for k in range(40):
            for n in range(8):
                assert got[1000 + 10 * k + n].endswith(feature.format(n, names(k)[6]))
                assert sample == 1 or got[1000 + 10 * k + n] == feature.format(n, names(k)[6])
        # a single page of its layout
        assert all(got[5000 + k].endswith(feature.format(k, names(40 + k)[6])) for k in range(3))


def test_layouts_and_constant_nodes():
    news = [parse(page(n)) for n in range(4)]
    shop = [parse(f"<body><table><tr><td>item number {n}</td><td>price</td></tr></table></body>") for n in range(3)]
    assert [len(g) for g in layouts([news[0], shop[0], *news[1:], *shop[1:]])] == [4, 3]
    assert len(constant_nodes(shop)) == 1 and constant_nodes(shop[:2]) == constant_nodes([]) == set()


def test_wide_pages_are_aligned_within_bounds():
    wide = parse("<body>" + "<div><ul>" + "<li><b>x</b></li>" * 3000 + "</ul></div>" + "<div><p>a</p></div>" * 2000 + "</body>")
    assert simple_tree_matching(wide, wide) < 200
