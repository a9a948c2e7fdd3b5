"""Articles out of awkward pages; the Cao start on mixed columns against plain Python."""

import html

import pytest
from pyspark.sql import functions as F

from ludoscope.operators import clusters
from ludoscope.sources import landed


@pytest.mark.parametrize("text", [
    "&eacute;&Eacute;&hellip;&mdash;&rsquo;", "&#233;&#x1F600;&#X41;&#65;", "a & b && c&", "&amp;lt;", "&bogus; &; &#; &#x; &amp", "&#0;&#xD800;&#9999999;", "&lt;p&gt;&apos;&quot;", "", "plain",
])
def test_references(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(landed.unescape_html(F.col("t"))).first()[0]
    # What names no character stays, as does a reference without its semicolon.
    kept = {"&bogus; &; &#; &#x; &amp": "&bogus; &; &#; &#x; &amp", "&#0;&#xD800;&#9999999;": "&#0;&#xD800;&#9999999;"}
    assert got == kept.get(text, html.unescape(text))


@pytest.mark.parametrize("page, text", [
    ("<article><p>a</p><article class=x>b</article><p>c</p></article><article>d</article>", "a b c"), ("<ARTICLE id='x'>a</ARTICLE> b", "a"), ("no <p>article</p>", ""),
    ("<article>open <b>end</b>", "open end"), ("</article><article>a</article>", "a"), ("<articles>x</articles><article>y</article>", "y"), ("", ""),
])
def test_first_article(spark, page, text):
    got = spark.createDataFrame([(page,)], "t string").select(landed.html_text(landed.first_article(F.col("t")))).first()[0]
    assert got == text


def test_article_record(spark):
    page = (
        "<html><head><title>T &eacute;</title><meta content='Ann &amp; Bob' name=author><meta name=\"author\" content=\"Cyd\"/><META PROPERTY='article:author' CONTENT=\"\">"
        "<meta content='2024-03-02T01:00:00' property='article:published_time'><meta name='authority' content='no'></head><article>a&nbsp;&nbsp;b<article>c</article>d</article>"
    )
    pages = spark.createDataFrame([("u", page), ("v", "<title>x</title>"), ("w", None)], "url string, html string")
    got = landed.parse_article(pages, F.lit("s")).collect()
    assert [(r["headline"], r["author"], r["article_text"], str(r["date_published"])) for r in got] == [("T é", ["Ann & Bob", "Cyd"], "a b c d", "2024-03-02 01:00:00")]


def plain_cao(rows, k):
    combos = {}
    for x, *cats in rows:
        combos.setdefault(tuple(cats), []).append(x)
    density = {c: sum(sum(len(v) for o, v in combos.items() if o[i] == c[i]) for i in range(len(c))) for c in combos}
    chosen = []
    while len(chosen) < k:
        def score(c):
            return density[c] * min((sum(a != b for a, b in zip(c, o)) for o in chosen), default=1)

        best = min(combos, key=lambda c: (-score(c), c))
        if score(best) == 0:
            break
        chosen.append(best)
    return [[sum(combos[c]) / len(combos[c]), *c] for c in chosen]


@pytest.mark.parametrize("k", [1, 3, 30])
def test_cao_start_on_mixed_columns(spark, k):
    rows = [(float(i * 7 % 11), "abc"[i * i % 3], i % 4, "xy"[i % 7 == 0]) for i in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "game_id int, x double, a string, b int, c string")
    got = clusters.init_cao_mixed(df, ["x"], ["a", "b", "c"], k)
    want = plain_cao(rows, k)
    assert [g[1:] for g in got] == [w[1:] for w in want] and [g[0] for g in got] == pytest.approx([w[0] for w in want])
    found = clusters.kprototypes(df, ["x"], ["a", "b", "c"], k, init="Cao")
    assert found.labels.count() == 60 and found.costs == sorted(found.costs, reverse=True)
