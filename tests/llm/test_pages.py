"""Operators on pages and vectors against plain Python and SQL."""

import base64
import hashlib
import html
import io
import re

import duckdb
import numpy as np
import pytest

from gaugeframe.llm import extraction, topk_search, url_filter, warc
from gaugeframe.llm.common import stored
from gaugeframe.llm.dom import blocks, parse
from gaugeframe.llm.oracle import ORACLE
from gaugeframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text string, verdict string"
PAGE = (
    "<html><head><title>t</title><script>var a='<p>';</script></head><body><header>Site</header>"
    "<nav><ul><li>Home<li>More</ul></nav><div class='cookie-notice'>Cookies</div>"
    "<div id=wrap><h1>Ti&amp;tle {0}</h1><p>First  {0}<br>line<p>Second &#233; <b>bold{0}</b></p>"
    "<p>Share this page</p></div><aside>Side</aside><div class=comments><p>Nice!</p></div>"
    "<form><p>Sign</p></form><footer>&copy; x</footer></body></html>"
)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h.example.org/{i}", PAGE.format(f"n{i}"), "x", "y") for i in range(8)]
    rows += [
        (20, None, None, None, None), (None, "x", "", "x", "y"), (21, "no host", "<", "x", "y"),
        (22, "https://a.com/b?c#d", "same", "x", "y"), (23, "u://a.com", "same", "x", "y"),
        (23, "u://a.com", "same", "x", "y"), (24, "HTTP://WWW.Example.COM/en/x?y", "<p>" * 5000 + "deep", "x", "y"),
        (25, "http://q.net/es/1#2", "<div>" * 300 + "x" * 100_000, "x", "y"),
        (26, "http://example.com/en/", "<a title=\"a>b\" c='<'>in</a><b", "x", "y"),
    ]
    return stored(spark.createDataFrame(rows, SCHEMA), "pages")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    columns = ", ".join(got.columns)
    want = con.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


# ---------------------------------------------------------------- archives


@pytest.mark.parametrize("range_bytes", [37, 1000, 1 << 20])
def test_archives_round_trip(pages, range_bytes):
    got = warc.round_trip(pages, warc.WarcOptions(range_bytes=range_bytes)).collect()
    rows = pages.collect()
    assert len(got) == len(rows)
    top = {}
    for r in rows:
        body = r.html or ""
        top[body] = max(top.get(body, -1), -1 if r.page_id is None else r.page_id)
    want = []
    for r in rows:
        body = r.html or ""
        data = body.encode()
        refers = None if r.page_id == top[body] else top[body]
        want.append(
            (r.page_id, r.url, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "response" if refers is None else "revisit", refers, data if refers is None else b"")
        )
    key = lambda x: tuple(map(str, x))
    assert sorted(((*r[:6], bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)


def test_reader_owns_by_start_and_skips_false_magic():
    o = warc.WarcOptions()
    members = [warc.record(i, f"u{i}", bytes([i]) * 500, None, o.date) for i in range(20)]
    noise = b"\x1f\x8b\x08 not a member"
    data = noise + noise.join(members)
    for width in (1, 50, 333, len(data)):
        ids = []
        for start in range(0, len(data), width):
            source = type("S", (io.BytesIO,), {"read_at": lambda s, n, at: data[at : at + n]})()
            ids += [
                int(r["fields"]["WARC-Page-ID"])
                for r in warc.records_in_range(source, len(data), start, start + width, o)
            ]
        assert ids == list(range(20))


# ---------------------------------------------------------------- extraction


def test_wrapper_finds_slot_and_template(pages):
    got = {r.page_id: r for r in extraction.extract(pages).collect()}
    for i in range(8):
        assert got[i].text == f"Ti&tle n{i}\nFirst n{i} line\nSecond é boldn{i}"
        assert got[i].n_chars == len(got[i].text)
    assert got[20].text == "" and got[None].text == "" and got[24].text == "deep"
    assert got[22].text == "same" and got[25].n_chars == 100_000 and got[26].text.startswith("in")
    assert sum(1 for r in extraction.extract(pages).collect()) == pages.count()


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "http://h/", PAGE.format("same")) for i in range(9)]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in got.collect()} == {
        "Ti&tle same\nFirst same line\nSecond é boldsame\nShare this page"
    }


def texts_of(spark, rows):
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r.page_id: r.text for r in got.collect()}


@pytest.mark.parametrize("tag", ["div", "section"])
def test_sibling_containers_are_all_kept(spark, tag):
    page = "<body><article><h1>T{0}</h1>" + "".join(f"<{tag}>par {k} of {{0}}</{tag}>" for k in "123")
    got = texts_of(spark, [(i, "http://h/", page.format(f"n{i}") + "</article></body>") for i in range(7)])
    for i in range(7):
        assert got[i] == f"Tn{i}\npar 1 of n{i}\npar 2 of n{i}\npar 3 of n{i}"


def test_what_stands_beside_a_long_body_is_kept(spark):
    page = (
        "<body><div><p>Site menu</p></div><div><h1>Title {0}</h1><p>Lead {0}</p>"
        "<div><div><p>" + "body {0} " * 80 + "</p></div></div><section><p>End {0}</p></section></div></body>"
    )
    got = texts_of(spark, [(i, "http://h/", page.format(f"n{i}")) for i in range(7)])
    for i in range(7):
        body = " ".join([f"body n{i}"] * 80)
        assert got[i] == f"Title n{i}\nLead n{i}\n{body}\nEnd n{i}"


def test_layouts_of_a_host_are_induced_apart(spark):
    """Also pages without text, of which one would have the smallest hash, and small hosts."""
    one = "<body><div><p>Menu one</p></div><div><p>A {0}</p><p>more {0}</p></div></body>"
    two = "<body><section><p>Menu two</p></section><main><p>B {0}</p><p>more {0}</p></main></body>"
    rows = [(i, "http://h/", one.format(f"n{i}")) for i in range(20)]
    rows += [(i, "http://h/", two.format(f"n{i}")) for i in range(20, 40)]
    rows += [(i, "http://h/", "" if i % 2 else None) for i in range(40, 80)]
    rows += [(i, "http://small/", one.format(f"n{i}")) for i in range(80, 83)]
    rows += [(90, "http://single/", two.format("n90"))]
    got = texts_of(spark, rows)
    for i, text in got.items():
        kind = "B" if 20 <= i < 40 or i == 90 else "A"
        assert text == ("" if 40 <= i < 80 else f"{kind} n{i}\nmore n{i}")


def test_tree_matching_by_hand():
    a = ["r", 0, [], [[x, 0, [], []] for x in "xyz"]]
    b = ["r", 0, [], [[x, 0, [], []] for x in "yqz"]]
    size, pairs = extraction.match(a, b)
    assert size == 3 and {p[0][0] for p in pairs} == {"r", "y", "z"}


def test_given_pages_give_their_articles(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    page = {r.page_id: r.html for r in rows.collect()}
    for r in extraction.extract(rows).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", page[r.page_id], re.S)[1]
        parts = [re.sub("<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h1)>", article)]
        texts = [" ".join(html.unescape(x).split()) for x in parts]
        assert r.text == "\n".join(x for x in texts if x)


def test_no_text_is_slow_to_parse():
    for text in ("<a " * 50_000, "<a b='" * 50_000, "<!--" * 50_000, "<script>" * 50_000, "<p>" * 50_000):
        list(blocks(parse(text), lambda node, path: False))


# ---------------------------------------------------------------- urls


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, rule in url_filter.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


def test_url_rules(spark, pages):
    for frame in (pages, spark.read.parquet(f"{SF}/pages.parquet")):
        url = {}
        for r in frame.collect():
            url.setdefault(r.page_id, r.url)
        rows = url_filter.judge(frame).collect()
        assert len(rows) == frame.count()
        for r in rows:
            assert (r.host, r.path) == plain_url(url[r.page_id])
            rule = plain_rule(r.host, r.path)
            assert r.rule == (rule and rule[1])
            assert r.verdict == (rule[0] if rule else "block" if r.block_score > 0 else "allow")


def test_viterbi_against_all_splits():
    cost = {"ad": 2.0, "ads": 2.5, "track": 3.0, "t": 9.0, "rack": 3.5, "st": 4.0}

    def every(s):
        if not s:
            yield 0.0, []
        for n in range(1, len(s) + 1):
            if s[:n] in cost or n == 1:
                for c, rest in every(s[n:]):
                    yield c + cost.get(s[:n], 20.0), [s[:n], *rest]

    for label in ("adstrack", "adtrack", "st", "adsrack"):
        words = url_filter.viterbi(label, cost, 20.0)
        assert words == min(every(label))[1]
    assert url_filter.viterbi("qqad", cost, 20.0) == ["qq", "ad"]


def test_long_words_of_the_texts_are_found_in_hosts(spark):
    word = "donaudampfschifffahrtsgesellschaft"
    df = spark.createDataFrame(
        [(1, f"http://my{word}.de/", f"<p>my {word} my donau dampf</p>")],
        "page_id long, url string, html string",
    )
    hosts = df.selectExpr(f"'my{word}.de' AS host")
    got = url_filter.segmented_hosts(hosts, df, url_filter.UrlOptions()).first()
    assert got.words == sorted(["de", "my", word])


def test_classifier_separates_hosts(spark):
    rows = [(i, f"http://{'badads' if i % 2 else 'goodnews'}.x.{'com' if i % 2 == 0 else 'net'}/{'es/' if i % 2 else ''}p{i}",
             "<p>bad ads good news</p>" * 3) for i in range(40)]
    rows += [(100, "http://badads.y.org/", ""), (101, "http://goodnews.y.org/", "")]
    got = {r.page_id: r for r in url_filter.judge(
        stored(spark.createDataFrame(rows, "page_id long, url string, html string"), "urls")).collect()}
    assert got[100].verdict == "block" and got[101].verdict == "allow"


# ---------------------------------------------------------------- vectors


def brute_top(rows, k):
    out = []
    valid = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in {(i, tuple(q)) for i, q in valid if i % 50 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, d)), j) for j, d in valid if j != i and len(d) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centers[i % 6] + rng.normal(size=8) / 20]) for i in range(900)]
    rows += [(i, rows[7][1]) for i in range(900, 1000)]  # ties
    rows += [(1000, None), (1001, []), (1050, [None] * 8), (1100, [float("nan")] * 8), (None, rows[3][1]),
             (1150, [1.0, 2.0]), (1151, [0.5, 0.5]), (50, rows[50][1])]
    df = stored(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vecs")
    small = topk_search.Search(rows_per_pivot=100, data_block=64, query_block=4, fan=4, leaf=8)
    got = topk_search.top_k(df, df["vec_id"] % 50 == 0, small).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 5)
    assert topk_search.digest(df.where("vec_id < 0")).isEmpty()


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for _ in range(50):
        q, d = rng.normal(size=(20, 5)) * 100, rng.normal(size=(30, 5)) * 100
        s = topk_search.Search(leaf=4, fan=3)
        a, b = (topk_search.cover_tree(x, np.arange(len(x)), s) for x in (q, d))
        bound = topk_search.ball_bound(float(a.center @ b.center), a.norm, a.radius, b.norm, b.radius)
        assert (q @ d.T).max() <= bound
        assert sorted(i for c in a.children for i in c.members) == list(range(20))
