"""Main text: constructed pages with known articles, templates per host, odd markup."""
import random

import pytest

from tokenmill.llm import html_text as H


def text(source, template=frozenset()):
    t = H.Tree(source)
    t.summarise()
    return t.text(set(template))


@pytest.mark.parametrize("source,want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"), ("<article><h1>T</h1><p>x<br>y  z</p></article>", "T\n\nx y z"),
    ("<p><b>One<br><p>Two</p>", "One\n\nTwo"), ("<ul><li>a<li>b</ul>", "a\n\nb"), ("a<script>var x='</p>'</script>b<style>p{}</style>c", "abc"),
    ("<!-- <p>no</p> -->yes", "yes"), ("<p title='a>b'>x</p>", "x"), ("<p title=\"x>unclosed", "unclosed"), ("1 < 2 &lt; 3", "1 < 2 < 3"),
    ("<p>&eacute;&#233;&#xE9;&nbsp;&copy</p>", "\u00e9\u00e9\u00e9 \u00a9"), ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table>", "a b\n\nc"),
    ("<nav>menu</nav><main><h1>T</h1><article><p>x</p></article></main><footer>f</footer>", "T\n\nx"),
    ("<body><header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x</p><footer>by</footer></article></body>", "T\n\nx"),
    ("<div class='cookie-notice'>c</div><div id=content><p>x</p></div><aside>s</aside><form>f<input></form>", "x"),
    ("<article><p>x</p><section class='comments'><article><p>first!</p></article></section></article>", "x"),
    ("<article><p>load and shadows</p><div class='ad-slot'>buy</div><div class=\"heading\">head</div></article>", "load and shadows\n\nhead"),
    ("<div class='menu'><article><p>x</p></article></div>", "x"), ("<p hidden>h</p><p style='display: none'>n</p><p aria-hidden=true>a</p><p>v</p>", "v"),
    ("<html><head><title>t</title></head><p>x</html>", "x"), ("</p></div>x</b>", "x"), ("<!DOCTYPE html><?xml?>x", "x"),
    ("<P>A</P><BR><Script>n</SCRIPT >z", "A\n\nz"), ("<pre>a\n  b</pre>", "a b"), ("<p>a<wbr>b</p>", "ab"), ("<textarea>no</textarea>yes", "yes"),
    ("<article><p>trunc", "trunc"), ("<p>x</p><script>never ends", "x"), ("<svg><text>no</text></svg><p>yes</p>", "yes"),
])
def test_blocks(source, want):
    assert text(source) == want


def test_long_and_deep_pages_are_linear():
    assert len(text("<div>" * 20_000 + "x" + "</div>" * 20_000)) == 1
    assert text("<p>" * 50_000 + "x") == "x"
    assert len(text("<article>" + "<p>word word</p>" * 50_000).split("\n\n")) == 50_000


def page(host, i, rng, article):
    links = "".join(f"<li><a href='/{k}'>{k}</a></li>" for k in ("home", "news", host))
    return (f"<html><body><div class=x><ul>{links}</ul></div><div><p>Welcome to {host}, all rights of this site.</p></div>"
            f"<div><h1>{article[0]}</h1>" + "".join(f"<p>{p}</p>" for p in article[1:]) + f"</div><div>Seen by {host} readers</div></body></html>")


def test_templates_of_hosts(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(40):
        host = "a.org" if i < 25 else "b.org" if i < 37 else "few.org"
        article = [f"Title {i}", f"Body {i} {rng.random()}", f"More {i}"]
        rows.append((i, f"http://{host}/{i}", page(host, i, rng, article)))
        want[i] = "\n\n".join(article) if host != "few.org" else None
    rows += [(90, None, "<p>x</p>"), (91, "http://a.org/z", None), (92, "http://a.org/y", "")]
    got = {r["page_id"]: r for r in H.extract_text(spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")).collect()}
    assert len(got) == len(rows)
    for i, w in want.items():
        if w is not None:
            assert got[i]["text"] == w
        else:
            assert "Welcome to few.org" in got[i]["text"]
    assert got[90]["text"] == "x" and got[91]["text"] == got[92]["text"] == "" and got[91]["n_chars"] == 0
    assert got[0]["n_chars"] == len(got[0]["text"]) and got[0]["url"] == "http://a.org/0"


def test_copies_of_articles_and_shared_passages_stay(spark):
    shared = "A passage that many articles of the host share. " * 5
    rows = [(i, f"http://h.org/{i}", f"<body><div>bar <a>x</a></div><article><h1>T{i % 2}</h1><p>{shared}</p><div><a>Share this</a></div></article></body>") for i in range(30)]
    rows += rows[:5]
    out = H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 35
    assert all(r["text"] == f"T{r['page_id'] % 2}\n\n{' '.join(shared.split())}" for r in out)


def test_empty(spark):
    assert H.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_on_a_small_share_of_a_hot_host(spark):
    rows = [(i, f"http://hot.org/{i}", f"<body><div>{'<p>Section menu of the ninth part.</p>' if i % 12 == 0 else ''}</div><div><p>Body {i}</p></div></body>")
            for i in range(1200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for more in ({}, {"shipped": 0}):  # shipped, and joined
        got = H.extract_text(df, **more).collect()
        assert len(got) == 1200 and all(r["text"] == f"Body {r['page_id']}" for r in got)


def test_copies_without_article_stay(spark):
    def body(i):
        return (f"<html><body><div><ul><li><a href='/'>home</a></li></ul></div><div>Host line</div>"
                f"<div><h1>T{i}</h1><p>Body {i} with a <a>link</a></p>and loose text</div></body></html>")
    rows = [(i, f"http://copy.org/{i}", body(0)) for i in range(12)]
    rows += [(100 + i, f"http://mix.org/{i}", body(i if i < 10 else 0)) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):  # one text on the whole host: only the menu goes
        assert got[i] == "Host line\n\nT0\n\nBody 0 with a link\n\nand loose text"
    for i in range(30):  # ten texts
        j = i if i < 10 else 0
        assert got[100 + i] == f"T{j}\n\nBody {j} with a link\n\nand loose text"


@pytest.mark.parametrize("source,want", [
    ("<body><div class='content has-sidebar'><p>The text of the page.</p><div class=sidebar>s</div></div></body>", "The text of the page."),
    ("<body><form><div class=menu><a>m</a></div><p>The text of the page.</p><button>go</button></form></body>", "The text of the page."),
    ("<body><div class=social><p>like</p></div><p>The text of the page.</p></body>", "The text of the page."),
    ("<body><div class=widget hidden><p>The text of the page.</p></div><p>x</p></body>", "x"),
])
def test_names_do_not_drop_most_of_a_page(source, want):
    assert text(source) == want
