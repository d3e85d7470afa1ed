import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import html_text as H

SCHEMA = "page_id long, url string, html string, rid string, text_ string, lines string"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<article><h1>T &amp; t</h1><p><b>one<br>two<p>three\n  four</p></article><p>out</p>", "T & t\none two\nthree four"),
        ("<nav>n</nav><main><p>a</p><aside>s</aside><form>f<input></form><p>b</p></main><footer>x</footer>", "a\nb"),
        ('<p>a</p><div class="ad box"><div>x</div>y</div><p>b</p><div id="comments"><p>c</p></div>', "a\nb"),
        ('<article><p>a</p><article class="comment">c</article><script>var t="</p><p>x";</script><p>b</p></article>', "a\nb"),
        ("<p>lead</p><article>address<header><h1>h</h1></header>&lt;b&gt; &#233;&nbsp;x</article>", "address\nh\n<b> é x"),
        ("<nav>never closed<article><p>a</p></article>", "a"),
        ("plain text only", "plain text only"),
        *[
            (f"<article><h1>T</h1><p>body</p><div {mark}><p>x</p><ul><li>y</li></ul></div><p>end</p></article>", "T\nbody\nend")
            for mark in (
                'class="comment-list"',
                'class="related-posts"',
                "class='big ad-slot'",
                'id="post-comments"',
                'class="article__newsletter-signup"',
                "class=social-links",
            )
        ],
        *[
            (f"<div {mark}><article><h1>T</h1><p>body</p></article></div>", "T\nbody")
            for mark in ('class="content-sidebar-wrap"', 'class="no-sidebar"', 'class="related-posts"')
        ],
        ('<article class="post has-share"><div class="comments-open entry-content">body</div></article>', "body"),
        ('<article>own</article><div class="related-posts"><article>another</article></div>', "own"),
        ("<main><h1>T</h1><p>the body</p></main><article>teaser</article>", "T\nthe body"),
        ("<main><h1>T</h1></main><article>a longer text than main has</article>", "a longer text than main has"),
        ("<main><p>lead in main</p><article>in it</article></main><article>out of it, and longer</article>", "in it"),
        ('<p>a</p><p class="x>b</p><p>c</p>', "a\nb\nc"),
        ('<p>a</p><p title="1 > 0">b</p>', "a\nb"),
        ('<p class="broadcast-address">kept</p><!-- <p>x</p> --><p hidden>h</p>', "kept"),
    ],
)
def test_parse(html, text):
    assert "\n".join(H.parse(html)[0]) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14))
def test_common_lines_is_longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    at = H.common_lines(np.array(a, np.int64), np.array(b, np.int64))
    rest = iter(b)
    assert len(at) == t[-1][-1] and all(any(x == y for y in rest) for x in (a[i] for i in at))


def site(n, hosts=3):
    """Pages without marked articles: a site's own lines around a text of the page's own."""
    rows = []
    for i in range(n):
        h = i % hosts
        body = f"<div>Site {h} says hello</div><p>own text {i}</p><p>more {i} of it</p><div>Imprint of {h}</div>"
        rows.append((i, f"https://h{h}.example.org/a/{i:04d}?x=1", page(body), "x", "y", "z"))
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_differencing_deletes_what_neighbours_share(spark, tmp_root, partitions):
    spark.createDataFrame(site(60), SCHEMA).repartition(partitions).write.parquet(f"{tmp_root}/pages.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.page_id: r.text for r in H.op4_html_text(spark, tmp_root).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: f"own text {i}\nmore {i} of it" for i in range(60)}


def test_odd_pages(spark, tmp_root):
    same = page("<article><p>the same article</p></article>")
    rows = [
        (1, "http://a/1", same, None, None, None),
        (1, "http://a/1", same, None, None, None),
        (2, "http://a/2", same, None, None, None),
        (3, None, None, None, None, None),
        (None, "not a url", "", None, None, None),
        (4, "http://alone/x", page("<p>all of it</p>"), None, None, None),
        (5, "http://a/9", page("<article>" + "<p>long</p>" * 20_000 + "</article>"), None, None, None),
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_root}/pages.parquet")
    got = H.op4_html_text(spark, tmp_root).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == "the same article" and texts[3] == texts[None] == "" and texts[4] == "all of it"
    assert texts[5] == "\n".join(["long"] * 20_000)
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty_table(spark, tmp_root):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_root}/pages.parquet")
    assert H.op4_html_text(spark, tmp_root).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ('<div class="content-sidebar-wrap"><article><p>a</p></article></div>', "a"),
        ('<div class="no-sidebar site has-share menu"><nav>n</nav><article><h1>h</h1><p>a</p></article></div>', "h\na"),
        ('<article class="hentry category-notice"><p>a</p></article>', "a"),
        ('<article class="post share-enabled notice"><div class="entry-header"><h1>h</h1></div><p>a</p></article>', "h\na"),
        ('<article><div class="header"><h1>h</h1></div><p>a</p><div class="share">s</div></article>', "h\na"),
        ('<form class="search"><main><p>a</p></main></form><div class="menu">m</div>', "a"),
        ('<div class="ad">never closed<article><p>a</p></article><div>x</div>', "a"),
        ('<article><p>a</p></article><div class="comments"><article class="comment">c</article></div>', "a"),
    ],
)
def test_marked_wrappers_keep_their_article(html, text):
    assert "\n".join(H.parse(html)[0]) == text


def texts_of(spark, root, rows, partitions):
    spark.createDataFrame(rows, SCHEMA).repartition(partitions).write.parquet(f"{root}/pages.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return sorted((r.page_id, r.text) for r in H.op4_html_text(spark, root).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("partitions", [1, 9])
def test_copies_of_open_pages_keep_their_text(spark, tmp_root, partitions):
    def open_page(i, visits=""):
        return page(f"<div>Site says hello</div><p>own text {i} " + "and more " * 20 + f"</p><div>{visits}</div><div>Imprint</div>")

    rows = [(i, f"http://h/{i}", open_page(i), None, None, None) for i in range(3)]
    rows += [(1, "http://h/1", open_page(1), None, None, None)] * 30  # crawled again and again
    rows += [(10 + i, "http://h/1a", open_page(7, f"visit {i}"), None, None, None) for i in range(5)]  # near copies
    rows += [(20, "http://alone/", open_page(20), None, None, None)] * 12
    got = texts_of(spark, tmp_root, rows, partitions)
    own = lambda i: f"own text {i} " + "and more " * 19 + "and more"
    want = [(i, own(i)) for i in range(3)] + [(1, own(1))] * 30 + [(10 + i, f"{own(7)}\nvisit {i}") for i in range(5)]
    want += [(20, f"Site says hello\n{own(20)}\nImprint")] * 12
    assert got == sorted(want)


def test_open_page_beside_marked_pages_loses_the_sites_lines(spark, tmp_root):
    around = "<div>Site says hello</div>{}<div>Imprint</div>"
    rows = [(i, f"http://h/{i}", page(around.format(f"<article><p>marked {i} text</p></article>")), None, None, None) for i in (1, 3)]
    rows.append((2, "http://h/2", page(around.format("<p>an open page's text</p>")), None, None, None))
    assert texts_of(spark, tmp_root, rows, 1) == [(1, "marked 1 text"), (2, "an open page's text"), (3, "marked 3 text")]


@pytest.mark.parametrize("partitions", [1, 6])
def test_equals_brute_force(spark, tmp_root, partitions):
    """Pages of several hosts whose site lines come and go, against pairing and alignment written plainly."""
    rng = np.random.default_rng(5)
    rows, lines = [], {}
    for i in range(150):
        host = int(rng.integers(0, 4))
        shared = [f"Line {k} of site {host}" for k in range(8) if rng.random() < 0.6]
        at = int(rng.integers(0, len(shared) + 1))
        own = [f"Page {i} says {j} " + "and more " * 12 for j in range(int(rng.integers(1, 4)))]
        lines[i] = [x.strip() for x in shared[:at] + own + shared[at:]]
        rows.append((i, f"http://s{host}.example/{rng.integers(0, 10**6):06d}", page("".join(f"<p>{x}</p>" for x in lines[i])), "", "", ""))

    def lcs(a, b):
        best = [[[] for _ in range(len(b) + 1)] for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + [x] if x == y else max(best[i][j + 1], best[i + 1][j], key=len)
        return best[-1][-1]

    want = {}
    for host in {r[1].split("/")[2] for r in rows}:
        order = sorted((r[1], r[0]) for r in rows if r[1].split("/")[2] == host)
        ids = [i for _, i in order]
        for k, i in enumerate(ids):
            gone = lcs(lines[i], lines[ids[k - 1] if k else ids[1]])
            want[i] = "\n".join(x for x in lines[i] if x not in gone)
    assert dict(texts_of(spark, tmp_root, rows, partitions)) == want


def test_marked_pages_are_decided_by_their_own_lines(spark, tmp_root):
    """Between a repeated teaser and the page's own part, in article or main, the differencing decides."""
    teaser = "<article><p>Our shop has everything you need, " + "and more " * 8 + "</p></article>"
    rows = [(i, f"http://h/{i}", page(f"<article><h1>T{i}</h1><p>short {i} in words of its own</p><p>same end</p></article>{teaser}"), None, None, None) for i in range(3)]
    rows += [(10 + i, f"http://m/{i}", page(f"{teaser}<main><p>Site says hello</p><p>text {i} of main in words of its own</p></main>"), None, None, None) for i in range(3)]
    long = lambda i: f"<article><p>page {i} says {'this ' * 200}</p></article>"
    rows += [(20 + i, f"http://l/{i}", page(long(i) + teaser), None, None, None) for i in range(3)]
    want = [(i, f"T{i}\nshort {i} in words of its own\nsame end") for i in range(3)] + [(10 + i, f"text {i} of main in words of its own") for i in range(3)]
    want += [(20 + i, (f"page {i} says " + "this " * 200).strip()) for i in range(3)]
    assert texts_of(spark, tmp_root, rows, 1) == want
