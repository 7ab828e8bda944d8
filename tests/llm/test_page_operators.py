"""Url rules, HTML rendering and nearest neighbours on small input."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sumweave.llm import hamming_ann, html_render, url_filter
from sumweave.llm.queries import URL_RULES


def brute_judge(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, action = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, action


def test_url_rules(spark):
    rng = random.Random(6)
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'www.', 'a.b.', 'É.'])}{rng.choice(['Example.com', 'example.net', 'xexample.com', 'com', 'net'])}"
            f"{rng.choice(['', '/', '/en', '/en/', '/en/x/y', '/es/1?q=/fr/', '?x', '#/en/', '/fr/a#b', '//en/'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "a://b://c/en/", "http://" + "s." * 500 + "net/es/" + "d/" * 500, urls[0]]
    rows = [(i if i % 9 else None, u) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    got = Counter(tuple(r) for r in url_filter.judge(pages, url_filter.rules_frame(spark, URL_RULES)).collect())
    assert got == Counter((i, *brute_judge(u, URL_RULES)) for i, u in rows)
    assert url_filter.judge(pages.limit(0), url_filter.rules_frame(spark, URL_RULES)).count() == 0
    free = url_filter.judge(pages, url_filter.rules_frame(spark, []))
    assert {(r["rule"], r["verdict"]) for r in free.collect()} == {(None, "allow")}


def test_url_rule_conflicts(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x/")], "page_id long, url string")
    rules = url_filter.rules_frame(spark, [("a.org", "/x/", "allow"), ("a.org", "/x/", "block"), ("org", "/", "allow")])
    assert url_filter.judge(pages, rules).first()["verdict"] == "block"
    with pytest.raises(ValueError):
        url_filter.judge(pages, url_filter.rules_frame(spark, [("a.org", "/x", "allow")]))


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("a  b\n c", "a b c"), ("<p>a<p>b", "a\n\nb"), ("a<br>b", "a\nb"), ("x<b>y</b>z", "xyz"), ("1 &lt; 2 &amp; é", "1 < 2 & é"),
    ("<title>t</title><script>if (a<b) '</p>'</script>ok", "ok"), ("<div hidden>n</div><p style='DISPLAY : none'>n</p><i aria-hidden=true>n</i>y", "y"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"), ("<pre>a\n  b</pre>", "a\n  b"), ("a < b", "a < b"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>10<tr><td>漢字<td>5</table>end", "Name  | N\nalpha | 10\n漢字  | 5\n\nend"),
    ("<dl><dt>T<dd>D</dl>", "T\n    D"),
    ("a<!-- <p>no</p> -->b", "ab"), ("<a href='x>y'>l</a><img alt=pic>", "lpic"), ("<p>open", "open"), ("</div>x", "x"), ("<" * 50, "<" * 50),
])
def test_rendering(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<svg><title>no</title><text>drawn</text><defs>no</defs></svg> <math><mi>x</mi><mo>+</mo><mn>1</mn></math>", "drawn x+1"),
    ("<select><option>one<option selected>two</select>", "one\ntwo"), ("<object data=x>instead</object>", "instead"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"), ("<details><summary>s</summary>no<p>no</details>", "s"), ("<details open><summary>s</summary>y</details>", "s\ny"),
    ("<table><tr>stray<td>a</td><b>bold</b><td>b</table>", "stray\nbold\na | b"),
    ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>dd<td>e<tr><td>f<td>g<td>h</table>", "a | b  | c\n  | dd | e\nf | g  | h"),
    ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a | b\nc | d"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a | b\n  | c\n  | d"),
    ("<table><tr><td colspan=2 rowspan=2>wide<td>x<tr><td>y</table>", "wide | x\n     | y"),
])
def test_all_visible_text(html, text):
    got = html_render.render(html)
    # Columns that only spanning cells fill have no width of their own.
    assert [line.split() for line in got.split("\n")] == [line.split() for line in text.split("\n")]
    if "colspan" not in html:
        assert got == text


def made(rng, depth, shown, out):
    """A random page, built with the words that it shows."""
    html = ""
    for _ in range(rng.randint(1, 4)):
        word = f"w{rng.randint(0, 10**9)}"
        kind = rng.random()
        if kind < .35 or depth > 6:
            html += f" {word} "
            out.extend([word] * shown)
        elif kind < .5:
            hide = rng.choice(["hidden", "style='display:none'", "aria-hidden=true", 'style="color:red; visibility: hidden"'])
            html += f"<{(t := rng.choice(['div', 'span', 'em', 'section']))} {hide}>" + made(rng, depth + 1, False, out) + f"</{t}>"
        elif kind < .6:
            t = rng.choice(["script", "style", "template", "noscript", "dialog", "datalist"])
            html += f"<{t}> {word} </{t}>"
        elif kind < .7:
            rows = [[f"c{rng.randint(0, 10**9)}" for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 3))]
            html += "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
            out.extend(c for r in rows for c in r * shown)
        elif kind < .78:
            html += "<ul>" + "".join("<li>" + made(rng, depth + 1, shown, out) + rng.choice(["", "</li>"]) for _ in range(2)) + "</ul>"
        else:
            t = rng.choice(["div", "span", "b", "section", "article", "select", "object", "svg", "blockquote", "h2", "a", "dialog open"])
            html += f"<{t}>" + made(rng, depth + 1, shown, out) + f"</{t.split()[0]}>"
    return html


@pytest.mark.parametrize("seed", range(60))
@pytest.mark.parametrize("deep", [0, 400])
def test_visible_words_of_made_pages(seed, deep):
    words = []
    html = "<div>" * deep + made(random.Random(seed), 0, True, words) + "</div>" * deep
    assert [w for w in html_render.render(html).split() if w[0] in "wc"] == words


def test_hidden_parts_of_deep_pages():
    assert html_render.render("<div>" * 500 + "<p hidden>secret<b>secret</b></p>shown" + "<div style='display:none'>" + "<i>" * 300 + "secret") == "shown"
    assert html_render.render("<div>" * 300 + "<div>a</div><div>b</div>c") == "a\nb\nc"
    assert html_render.render("<ul><li>" * 30_000 + "x").split() == ["-"] * (html_render.render("<ul><li>" * 30_000 + "x").split().count("-")) + ["x"]


def test_rendering_of_deep_and_long_pages():
    assert html_render.render("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert html_render.render("<ul><li>" * 3000 + "x").strip().endswith("x")
    assert len(html_render.render("<p>word" * 20_000)) > 100_000


def test_extraction(spark):
    rows = [(1, "<p>a<p>b"), (None, "x"), (2, None), (3, ""), (1, "<p>a<p>b")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash")).withColumn("url", F.lit(None).cast("string"))
    got = Counter(tuple(r) for r in html_render.extract(pages).collect())
    assert got == Counter([(1, "a\n\nb", 3), (None, "x", 1), (2, "", 0), (3, "", 0), (1, "a\n\nb", 3)])
    assert html_render.extract(pages.limit(0)).count() == 0


def vectors(n=900, d=32):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, d)) + 3 * rng.normal(size=(20, d))[rng.integers(0, 20, n)]
    x[5] = x[300] = x[400]  # ties
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_nearest_neighbours(spark):
    rows = vectors()
    odd = [(2000, None), (2100, [0.0] * 32), (2200, [math.nan] + [1.0] * 31), (2300, [1.0] * 31 + [math.inf]), (2400, [1.0] * 31 + [None]),
           (2500, [1.0] * 7), (None, [1.0] * 32), rows[7]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash")).withColumn("block", F.lit(1))
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    got = {}
    for r in hamming_ann.search(spark, df, block=200).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(got) == list(range(0, 900, 100))
    hits = 0
    for q, found in got.items():
        score = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        score[q] = np.inf
        best = np.lexsort((np.arange(len(x)), score))[:10]
        assert sorted(found) == list(range(1, 11))
        assert all(abs(s - np.sqrt(((x[v] - x[q]) ** 2).sum())) < 1e-12 for v, s in found.values())
        order = [(s, v) for _, (v, s) in sorted(found.items())]
        assert order == sorted(order) and q not in [v for _, v in order]
        hits += len({*best.tolist()} & {v for v, _ in found.values()})
    assert hits >= 0.9 * 10 * len(got)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame(vectors()[:4], "vec_id long, embedding array<float>")
    assert [r["rank"] for r in hamming_ann.search(spark, df).orderBy("rank").collect()] == [1, 2, 3]
    assert hamming_ann.search(spark, df.limit(0)).count() == 0
    assert hamming_ann.search(spark, df.where("vec_id = 1")).count() == 0


def test_multi_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 16, (500, 8), dtype=np.uint16)
    index = hamming_ann.MultiIndex(codes)
    for radius in (0, 7, 20, 45, 52, 61, 128):
        for q in (codes[3], rng.integers(0, 1 << 16, 8, dtype=np.uint16)):
            assert index.within(q, radius).tolist() == np.flatnonzero(hamming_ann.hamming(codes, q) <= radius).tolist()
