"""Operators on pages and vectors: hand-made cases, odd rows, empty tables, brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import html_text, nearest, url_filter

PAGES = "page_id long, url string, html string"


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def test_structure(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><nav><a>Menu</a></nav><header>Site</header>"
        "<div class='ad'>Buy <p>now</p></div><article><header><h1>Head &amp; Co</h1></header><p>One<br>two  <b>three<p>Four &lt;b&gt;<script>var x='</p>';</script>"
        "<aside>Side</aside><form><p>Mail</p></form><ul><li>Five<li>Six</ul><!-- no --><section class='comments'><article><p>Me too</p></article></section>"
        "</article><div id='cookie-notice'>Cookies</div><footer>&copy;</footer>"
    )
    got = texts(html_text.main_text(spark.createDataFrame([(1, "http://a/x", page)], PAGES)))
    assert got[1] == "Head & Co\nOne two three\nFour <b>\nFive\nSix"


def test_shared_lines_go(spark):
    page = "<body><div>Top line</div><p>{}</p><p>{}</p><div>Bottom line</div></body>"
    rows = [(i, f"http://host/dir/{i}", page.format(f"own {i}", f"more {i}")) for i in range(1, 6)] + [(9, "http://other/", page.format("own", "more"))]
    got = texts(html_text.main_text(spark.createDataFrame(rows, PAGES)))
    assert all(got[i] == f"own {i}\nmore {i}" for i in range(1, 6)) and got[9] == "Top line\nown\nmore\nBottom line"


def test_shared_lines_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(0, 9)), rng.integers(0, 4, rng.integers(0, 9))
        length = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                length[i + 1, j + 1] = length[i, j] + 1 if a[i] == b[j] else max(length[i, j + 1], length[i + 1, j])
        marks = html_text.shared_lines(a, b)
        assert marks.sum() == length[-1, -1]
        left = iter(b.tolist())
        assert all(x in left for x in a[marks].tolist())


def test_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (None, "x", ""), (2, "http://h/a", "<p>A</p>"), (2, "http://h/a", "<p>A</p>"), (3, "://", "<" * 50_000), (4, "http://h/b", "plain " * 50_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("host", "path", "key", "text", "range", "lines")})
    got = html_text.main_text(pages)
    assert got.count() == len(rows) and texts(got)[2] == "A" and texts(got)[1] == ""
    assert html_text.main_text(pages.limit(0)).count() == 0
    rules = spark.createDataFrame([("h", "/a", "block"), (None, "/", "allow")], "host string, path string, verdict string")
    judged = url_filter.judge(pages, rules)
    assert judged.count() == len(rows) and judged.where("verdict = 'block'").count() == 2
    assert url_filter.judge(pages.limit(0), rules).count() == 0 and url_filter.judge(pages, rules.limit(0)).where("rule is null").count() == len(rows)


def test_nested_rules(spark):
    rules = [("com", "/", "allow"), ("a.com", "/", "block"), ("a.com", "/x/", "allow"), ("b.a.com", "/x/y", "block"), ("com-x", "/", "block"), ("a-b.com", "/", "block")]
    urls = ["http://com/", "http://A.com/", "s://b.a.com/x/y/z", "s://b.a.com/x/z?q", "s://c.b.a.com/q#/", "s://ba.com/", "s://com-x/", "s://y.a-b.com/", "s://a.com", "nothing", None, "s://a.com.", "s:///x"]
    got = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    for r in got.collect():
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        assert (r["rule"], r["verdict"]) == (max(fits)[1:] if fits else (None, "allow")), r


def test_nearest_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 24)) * rng.uniform(0.2, 3, (3000, 1))
    x[500:900] = x[500]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5000, None, 0), (5020, [0.0] * 24, 0), (5040, [float("nan")] * 24, 0), (5060, [1.0, None] * 12, 0), (None, [1.0] * 24, 0), (6000, [1.0, 2.0], 0), (6001, [2.0, 1.0], 0)]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int"), k=20, every=20).toPandas()
    hit = total = 0
    for q in range(0, 3000, 20):
        s = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(3000), -s)) if i != q][:20]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.array_equal(mine["score"], s[mine["vec_id"]])
        hit, total = hit + len(set(order) & set(mine["vec_id"])), total + 20
    assert hit / total >= 0.95
    assert got[got["query_id"] == 6000]["vec_id"].tolist() == [6001] and set(got["query_id"]) == {*range(0, 3000, 20), 6000}
    assert nearest.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_raw_elements_end_at_their_closing_tag():
    body = "<article><p>Whole text</p></article>"
    for raw in (
        "<script>for(i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b)c='</p>'</Script >", "<style>/* <b */</style>", "<textarea>x<y</textarea>", "<svg><title>a<b</title></svg>",
        "<svg><svg></svg><text>no</text></svg>", "<script>a<b</script><script>'<c'</script>", "<script>'</scripts>'<x</script>", "<select><option>A<option>B</select>", "<option>", "<svg>",
    ):
        assert [t for _, t in html_text.lines_of(raw + body)] == ["Whole text"], raw
    assert html_text.lines_of("<p>A</p><script>a<b") == [("", "A")]
    for page in ("<html><head><title>T</title><p>A</p>", "<head><meta charset=u><title>T</title>A", "<head><title>T</title>no</head><body>A", "<head>no<div>A</div></head>", "<head>no<body>A"):
        assert [t for _, t in html_text.lines_of(page)][-1:] == ["A"], page
    assert html_text.lines_of("<head>no<title>T</title></head>") == []
    many = "<svg>" * 20_000 + "<p>A" + "<option>" * 20_000
    assert html_text.lines_of(many) == [("", "A")]


def kept(page):
    return [t for part, t in html_text.lines_of(page) if part != "out"]


def test_parts_to_leave_out():
    for tag in (
        "<div style='overflow:hidden'>", "<div data-hidden=false>", "<div title='a hidden id=menu class=ad'>", "<div data-id='menu'>", "<div class='content has-sidebar'>", "<div class=no-comments>",
        "<div class='no-sidebar x'>", "<div id=comments-open>", "<div aria-hidden=false>",
    ):
        assert kept(f"{tag}<p>Text</p></div>") == ["Text"], tag
    for tag in ("<article style='overflow: hidden'>", "<article class='post comments-open'>", "<main class=has-sidebar>"):
        assert kept(f"<p>B</p>{tag}<p>Text</p>") == ["B", "Text"], tag
    for tag in (
        "<div hidden>", "<div HIDDEN=''>", "<div aria-hidden='true'>", "<div class='x sidebar'>", "<div class=site-footer>", "<div id='cookie-notice'>", "<div class=ad-300x250>", "<div class='nav__menu'>",
        "<div role=navigation>", "<article class=comment>", "<div title=x id=menu-3>",
    ):
        assert kept(f"{tag}<p>Text</p></div></article><p>B</p>") == ["B"], tag


def test_wrappers_of_the_article_stay():
    body = "<article><p>Body of the page</p><form><p>Mail</p></form></article>"
    for tag, end in (("<form>", "</form>"), ("<div class=sidebar>", "</div>"), ("<div hidden><form>", "</form></div>")):
        assert kept(f"<nav>Menu</nav>{tag}<nav>Menu</nav>{body}<footer>Foot</footer>{end}") == ["Body of the page"], tag
    assert kept("<form><div role='main'>Body</div></form><article>Teaser that is longer</article>") == ["Body", "Teaser that is longer"]
    assert kept("<form><nav>Menu</nav><div>Body</div></form>") == ["Body"]
    assert kept(f"{body}<div class=comments><article>A comment that is longer than the body</article></div>") == ["Body of the page"]
    assert kept("<div>Body in divs</div><aside><article>Teaser</article></aside>") == ["Body in divs"]


def test_lines_outside_of_articles_are_compared(spark):
    page = "<div>Top line of the site</div><div>Body {0} begins here</div><div>Body {0} ends here</div><article>Teaser {0}</article><article>Quoted</article><div>Bottom line</div>"
    rows = [(i, f"http://host/dir/{i}", page.format(i)) for i in range(1, 5)]
    got = texts(html_text.main_text(spark.createDataFrame(rows, PAGES)))
    assert got == {i: f"Body {i} begins here\nBody {i} ends here\nTeaser {i}\nQuoted" for i in range(1, 5)}


def test_near_copies_tell_nothing(spark):
    page = "<div>Top line</div>" + "<p>{0} one of the body</p><p>{0} two of the body</p><p>{0} three of the body</p>" + "<div>{1}</div><div>Bottom line</div>"
    rows = [(1, "http://a/x", page.format("x", "Read")), (2, "http://a/x/print", page.format("x", "Print")), (3, "http://a/y", page.format("y", "Other")), (4, "http://b/x", page.format("x", "Read")), (5, "http://b/x2", page.format("x", "Print"))]
    got = texts(html_text.main_text(spark.createDataFrame(rows, PAGES)))
    body = "{0} one of the body\n{0} two of the body\n{0} three of the body\n{1}"
    assert [got[1], got[2], got[3]] == [body.format("x", "Read"), body.format("x", "Print"), body.format("y", "Other")]
    assert got[4] == "Top line\n" + body.format("x", "Read") + "\nBottom line" and got[5].count("body") == 3


def test_marked_parts_inside_an_article():
    """Comments, adverts and notices by any part of a word; a word that tells a state of the page marks nothing."""
    out = ("user-comments", "comment-thread", "reader-comments", "ad-slot", "adsbygoogle", "gdpr-banner", "inline-advert")
    for word in out:
        for page in (f'<article><p>A</p><div class="x {word}"><p>B</p></div></article>', f'<article><p>A</p><section id="{word}">B</section></article>'):
            assert kept(page) == ["A"], page
    for word in ("no-comments", "comments-open", "has-ads", "ad-free", "comments-count-off", "commentary", "shadow-box", "reading-list"):
        assert kept(f'<article class="{word}"><div class="{word}"><p>A</p></div></article>') == ["A"], word


def test_inline_parts_do_not_break_a_line():
    assert kept("<article><p>a<span hidden>no</span>b</p></article>") == ["ab"]
    assert kept('<article><p>a<ins class="adsbygoogle">x<div>y</div></ins> b</p><p>c</p></article>') == ["a b", "c"]
    assert kept("<article><p>a <span hidden>x <b>y</b></p><p>b</p></article>") == ["a", "b"]
    assert kept("<p>a<span hidden>x") == ["a"]
    assert kept("<article><p>Press <button>OK</button> now</p></article>") == ["Press OK now"]


def test_url_rules_meet_without_a_nested_loop(spark, capsys):
    """Many rules, ranges without a border of their own, one host with a third of all urls, ties and two verdicts of one rule."""
    rng = random.Random(5)
    names = [".".join(rng.choice("abcde") for _ in range(rng.randrange(1, 5))) for _ in range(120)]
    rules = [(h, rng.choice(["/", "/x", "/x/y"]), rng.choice(["allow", "block"])) for h in names] + [("a.b", "/z", "allow"), ("a.b", "/z", "block")]
    urls = [f"http://{rng.choice(names + ['hot.host'] * 60)}{rng.choice(['', '/', '/x', '/x/yz', '/z'])}" for _ in range(3000)] + ["http://a.b/z", None, "no"]
    judged = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4), spark.createDataFrame(rules, "host string, path string, verdict string"))
    got = {r.page_id: (r.rule, r.verdict) for r in judged.collect()}
    for i, url in enumerate(urls):
        rest = url.split("://")[1] if url and "://" in url else ""
        host, _, path = rest.partition("/")
        path = "/" + path if "/" in rest else ""
        fits = [(len(h + p), h + p, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert got[i] == ((best[1], best[3]) if best else (None, "allow")), url
    judged.explain("simple")
    assert "NestedLoop" not in capsys.readouterr().out
