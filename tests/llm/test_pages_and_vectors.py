"""Operators on pages and vectors."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import html_text, top_k, url_filter

LONG = "The cat sat on the mat and it was a good cat that had been there for a long time with all of the others who were not at home, but had been by the sea for all of that time and so on it went for a year and a day."


def test_article():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
      <nav><ul><li><a href="/a">Menu</a></ul></nav><div class="ad">{LONG}</div>
      <article><h1>Head &amp; line</h1><p><b>{LONG}<br><p>Osie&nbsp;de.</p><p>  a\n b </p><div class="share"><a href="#">Share</a></div><form>Mail<input></form></article>
      <section id="comments"><article class="comment"><p>{LONG}</p></article></section><footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page) == f"Head & line\n{LONG}\nOsie de.\na b"


def test_elements_without_an_end():
    after = f"<p>{LONG}</p>"
    for tag in ("button", "select", "map", "noscript", "canvas", "svg"):
        assert html_text.main_text(f"<article>{after}<{tag}>{after}</article>") == f"{LONG}\n{LONG}"
        assert html_text.main_text(f"<article>{after}<{tag}>go</{tag}>{after}</article>") == f"{LONG}\n{LONG}"
    for tag in ("script", "style", "textarea"):
        assert html_text.main_text(f"<article>{after}<{tag}>{after}</article>") == LONG
    assert html_text.main_text(f"<form><article>{after}</article><p>Mail</p></form>") == LONG
    assert html_text.main_text(f"<nav><article>{after}</article></nav>") == ""


def test_long_pages_take_time_by_their_length():
    for part in ('<p x="', "<p \"'>", "<button>", "<", "<!--", "<a href='"):
        begun = time.process_time()
        html_text.main_text(part * (1_000_000 // len(part)))
        assert time.process_time() - begun < 5, part
    assert html_text.main_text(f'<article><p title="a > b">{LONG}</p><p title="open>{LONG}</p>') == f"{LONG}\n{LONG}"


def test_page_without_article():
    page = f"""<body><header>Site</header><div class="cookie-notice">{LONG}</div><div id="content"><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>
      <aside>{LONG}</aside><div><a href="x">{LONG}</a></div><p>Tiny</p></body>"""
    assert html_text.main_text(page) == f"Head\n{LONG}\nShort.\n{LONG}"


def test_odd_pages(spark):
    pages = [(1, "u", None), (1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "<article><p>x &lt;b&gt; &#65;"), (5, "u", "<article>" + "<div>" * 3000 + "deep"), (6, "u", "a < b <!-- <p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("TEXT", F.lit(1))
    got = {(r.page_id, r.text) for r in html_text.extract(df).collect()}
    assert {(1, ""), (2, ""), (3, ""), (4, "x <b> A"), (5, "deep")} <= got and len(got) == 6
    assert html_text.extract(df.limit(0)).collect() == []


def test_rules(spark):
    urls = ["https://WWW.Example.ORG/es/1", "http://a.org", "http://a.org/x", "http://example.org/en/1", "http://x.example.org/en/2?a=/", "http://notexample.org/es/",
            "http://a.com/fr/1", "http://a.com/de/1", "http://com/fr/", "x", None, "", "a://b://c/d", "http://a.com?x/fr/", "http://a.com#/fr/"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("score", F.lit("v")).withColumn("x", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert got[0] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[1][:3] == ("a.org", "", None) and got[2][2:] == ("org/", "allow")
    assert got[3][2:] == ("example.org/en/1", "block") and got[4][2:] == ("org/", "allow") and got[5][2:] == ("org/", "allow")
    assert got[6][2:] == ("com/fr/", "allow") and got[7][2:] == ("com/de/", "block") and got[8][2] == "com/fr/"
    assert got[9][:3] == got[10][:3] == got[11][:3] == ("", "", None) and got[12][:2] == ("b:", "//c/d")
    assert got[13][:3] == ("a.com", "", None) and len(got) == len(urls)
    assert url_filter.judge(df.limit(0)).count() == 0


def test_ratio(spark):
    grams = [("\x02a", 3, 1), ("ab", 2, 0), ("aa", 0, 1), ("ba", 1, 0), ("b\x03", 1, 0), ("a\x03", 0, 2)]
    got = {r.gram: r.ratio for r in url_filter.gram_scores(spark.createDataFrame(grams, "gram string, a long, b long"), 1).collect()}

    def p(gram, side):
        count = {g: c[side] for g, *c in grams}
        ends = {}
        for g, c in count.items():
            ends[g[1]] = ends.get(g[1], 0) + c
        n, t = sum(ends.values()), sum(c > 0 for c in ends.values())
        low = (ends[gram[1]] + t / len(ends)) / (n + t)
        here = {g: c for g, c in count.items() if g[0] == gram[0]}
        n, t = sum(here.values()), sum(c > 0 for c in here.values())
        return (count[gram] + t * low) / (n + t) if n else low

    assert got == {g: pytest.approx(math.log(p(g, 0) / p(g, 1))) for g, *_ in grams}


def brute(ids, x, k):
    out = []
    for i, q in zip(ids, x):
        if i % 50 == 0:
            best = sorted((-int(q @ y), j) for j, y in zip(ids, x) if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_top_k(spark):
    draw = np.random.default_rng(3)
    x = np.floor(256 * np.repeat(draw.normal(size=(8, 16)), 100, 0) + draw.normal(size=(800, 16)))
    x[100:400] = x[100]  # ties
    rows = [(k, (v / 256).tolist()) for k, v in enumerate(x)]
    odd = [(2000, None), (2050, [1.0, None]), (2100, [float("nan")]), (2150, [float("inf")]), (2200, []), (None, [1.0]), (2250, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<double>").repartition(5)
    got = top_k.top_k(df, F.col("vec_id") % 50 == 0, vectors_in_block=100, queries_in_block=5).collect()
    assert sorted(map(tuple, got)) == brute(range(800), x, 5)
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in top_k.top_k(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [j for _, _, j, _ in brute([0, 1, 2], x[:3], 5)]


def test_trees_prune():
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(20, 8)) * 1000
    x = np.floor(np.repeat(centres, 200, 0) + draw.normal(size=(4000, 8)))
    ids = np.arange(4000)
    found = top_k.Search(x[::50], ids[::50], x, ids, 5)
    assert found.scored < 0.5 * 80 * 4000
    assert sorted((i, r, j, s) for i, row, scores in zip(ids[::50].tolist(), found.found.tolist(), found.scores.astype(int).tolist()) for r, (j, s) in enumerate(zip(row, scores), 1)) == brute(ids.tolist(), x, 5)
