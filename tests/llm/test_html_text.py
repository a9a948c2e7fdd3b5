"""Main text of pages: the given ones, a page with every kind of surroundings, and broken markup."""

import html
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from ludoscope.llm import html_text

LONG = "The cat is on the mat and it was good for all of us in the house that he had built for them. "


def test_given_pages():
    """Their articles are plain: a heading and paragraphs."""
    for page in pq.read_table("/root/testdata/sf0.1/pages.parquet")["html"].to_pylist():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        assert html_text.main_text(page) == "\n".join(b for b in blocks if b)


def test_surroundings_go():
    page = f"""<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style></head><body class="has-sidebar">
    <header><h1>The site</h1><ul><li><a href=x>Home</a></ul></header><div id="cookieNotice">We use cookies to track you.</div>
    <div class="content"><article class="post"><header class="entry-header"><h2>Title of the &quot;thing&quot;</h2></header>
    <p>First paragraph of the article&nbsp;is   long enough &#x26; has <b>words</b> in it.<p>Second one.
    <div class="ad-slot">Buy the thing that is good for you now</div><ul><li>One<li>Two</ul><table><tr><td>a<td>b</table>
    <form><p>Leave us your mail</form><p style="display: none">hidden words</p><span class="share">Tweet it</span><p>1<br>2<br><br>3
    <p>Tail.</article><section class="comments"><article class="comment"><p>{LONG}</article></section></div>
    <aside>{LONG}</aside><div role="complementary">{LONG}</div><footer>&copy; the site</footer><script>if (a<b) "</div>"</script></body></html>"""
    assert html_text.main_text(page) == 'Title of the "thing"\nFirst paragraph of the article is long enough & has words in it.\nSecond one.\nOne\nTwo\na\nb\n1 2\n3\nTail.'


def test_two_passes_without_an_article():
    page = (
        f'<div><div><a href=a>Home of us</a> <a href=b>News for you</a></div><h1>Heading</h1><p>{LONG * 3}</p><p>Short line.</p><p>{LONG * 3}</p>'
        f'<p><a href=c>{LONG * 2}</a></p><p>Xyz qwv blip zork {"frob nix " * 20}</p><p>By us</p></div>'
    )
    long = (LONG * 3).strip()
    assert html_text.main_text(page) == f"Heading\n{long}\nShort line.\n{long}"


RUSSIAN = "Кошка сидит у окна и смотрит во двор, где дети играют в мяч до самого вечера, пока их не позовут домой."
MENU = '<div><a href=a>Home of us</a> <a href=b>News for you</a></div>'


def test_languages_without_stop_words():
    for text in (RUSSIAN, "猫坐在窗边看着院子里的孩子们踢球直到傍晚他们被叫回家吃饭为止，" * 4, "Kot siedzi przy oknie, patrzy w stronę ogrodu, gdzie dzieci grają w piłkę przez cały dzień, póki nie zapadnie zmrok."):
        assert html_text.main_text(f"{MENU}<div><p>{text}</p><p>{text[:20]}</p><p>{text}</p></div><p><a href=c>{text}</a></p>") == f"{text}\n{text[:20].strip()}\n{text}"


def test_code_between_paragraphs_stays():
    code, long = "total = compute(values, weights, axis=0); result[index] = total / scale; " * 3, (LONG * 3).strip()
    assert html_text.main_text(f"<div><p>{long}</p><pre>{code}</pre><p>{long}</p></div>") == f"{long}\n{code.strip()}\n{long}"


@pytest.mark.parametrize("tag", ["article class='post has-comments'", "div class='content with-sidebar'", "div id='legal-analysis'", "section class='popular-science'"])
def test_a_class_does_not_drop_most_of_the_text(tag):
    long, name = (LONG * 3).strip(), tag.split()[0]
    page = f"{MENU}<{tag}><h1>Heading</h1><p>{long}</p><p>{long}</p><div class='comments'><p>{long}</p></div></{name}><div class='sidebar'>{LONG}</div>"
    assert html_text.main_text(page) == f"Heading\n{long}\n{long}"


COMMENTS = "".join(f"<li><p>{LONG * 4}</p></li>" for _ in range(8))


@pytest.mark.parametrize("page", [
    "<div class=post>{a}</div><div id=comments><ol>{c}</ol></div>", "<article>{a}</article><section class=comments>{c}</section>",
    "<article>{a}<section class='post-comments'>{c}</section></article>", "<main>{a}<div class=replies>{c}</div></main>",
    "<main><div class='post comments-open'>{a}</div><div class='comment-list'>{c}</div></main>", "<div>{a}</div><div class='disqus thread'>{c}</div>",
    "<article class='has-comments'>{a}</article><div class=sponsored>{c}</div>", "<form><div>{a}</div><div id=comments>{c}</div></form>",
])
def test_comments_longer_than_the_article(page):
    long = (LONG * 4).strip()
    assert html_text.main_text(MENU + page.format(a=f"<h1>Heading</h1><p>{long}</p><p>{long}</p>", c=COMMENTS)) == f"Heading\n{long}\n{long}"


def test_comments_are_text_where_there_is_nothing_else():
    long = (LONG * 4).strip()
    assert html_text.main_text(f"{MENU}<div class=discussion><p>{long}</p></div>") == long


def test_a_page_in_a_form():
    long = (LONG * 3).strip()
    page = (
        f"<form id=aspnetForm method=post><input type=hidden name=state value=x>{MENU}<div><h1>Heading</h1><p>{long}</p><p>{long}</p></div>"
        f"<label>Your mail</label><label for=x>Name of yours</label><select><option>One</select><textarea>Write to us</textarea><button>Send</button></form>"
    )
    assert html_text.main_text(page) == f"Heading\n{long}\n{long}"
    small = "<form><p>Tell us what you think of it and win</p><p>Name</p></form>"
    assert html_text.main_text(f"<div><p>{long}</p>{small}<p>{long}</p></div>") == f"{long}\n{long}"
    assert html_text.main_text(f"<article><p>{long}</p>{small}</article>") == long


def test_many_blocks_take_time_in_proportion():
    page = "<article>" + "<p>Short one.</p>" * 20_000 + "</article><div>" + "<p>Another.</p>" * 20_000 + f"<p>{LONG * 3}</p></div>"
    begin = time.process_time()
    assert html_text.main_text(page).count("Short one.") == 20_000
    assert time.process_time() - begin < 6


def plain_second_pass(first, articles, whole):
    decided = [i for i, x in enumerate(first) if x is not None]
    return [x if x is not None else (first[min(decided, key=lambda j: (abs(i - j), not first[j]))] if decided else articles[i] or not whole) for i, x in enumerate(first)]


@pytest.mark.parametrize("seed", range(30))
def test_second_pass_against_a_search(monkeypatch, seed):
    draw = random.Random(seed)
    first = [draw.choice([None, None, True, False] if seed % 3 else [None]) for _ in range(draw.randrange(1, 30))]
    found = [html_text.Block(text="x" * 10) for _ in first]
    verdicts = iter(first)
    monkeypatch.setattr(html_text, "judge", lambda block, known: next(verdicts))
    assert html_text.settle(found) == plain_second_pass(first, [False] * len(first), False)


def test_an_inline_class_does_not_drop_words():
    long = (LONG * 3).strip()
    assert html_text.main_text(f"<p>{long} <span class='notice'>Some words</span> <a class='share' href=x>Tweet it</a> {long}</p>") == f"{long} Some words {long}"


def test_text_outside_an_article_is_judged_too():
    long = (LONG * 3).strip()
    teaser = f"<article><h2>Read this</h2><p>{LONG}</p></article>"
    assert html_text.main_text(f"<div>{teaser}<div><p>{long}</p><p>Short line.</p><p>{long}</p></div></div>").endswith(f"{long}\nShort line.\n{long}")
    assert html_text.main_text(f"<article><p>{long}</p><p>{long}</p></article><div><p>{long}</p></div><p>By us</p>") == "\n".join([long] * 3)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p", "<p"), ("a < b and c > d", "a < b and c > d"), ("<p>x<p>y", "x\ny"), ("&lt;p&gt; &#65;&nbsp;&bogus;", "<p> A &bogus;"),
    ("<!-- open", ""), ("<script>never", ""), ("</p></div>text", "text"), ("<nav>menu", ""), ("<p>a<p>a", "a\na"), ("<![CDATA[x]]>y", "y"),
])
def test_broken_pages(page, text):
    assert html_text.main_text(page) == text


def test_rows(spark):
    rows = [(1, "u", "<p>one", "x"), (1, "u", "<p>one", "x"), (None, None, None, None), (2, "v", "<p>" + "word of the " * 200_000, "é"), (3, "w", "<" * 20_000 + "a href='", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 5
    assert {r["page_id"]: r["n_chars"] for r in got.collect()} == {1: 3, None: 0, 2: 2_399_999, 3: 20_008}
    assert html_text.extract_text(pages.limit(0)).count() == 0
