import re
import html

import math
import random
import time

import pytest

from lakeq.llm import html_text

LONG = "This paragraph of the article has a good many words, so that it is long for its few tags. " * 3


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  text\n of a page", "plain text of a page"), ("<<<a href='>'", "<<"),
    ("<p>one<p>two &amp; three &eacute;&#233;&#xe9;", "one\n\ntwo & three ééé"),
    ("<article><h1>Title</h1><p><b>open bold<br><p>next", "Title\n\nopen bold\n\nnext"),
    ("<script>if (a<b) document.write('<p>no</p>')</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
    ("<p>a</p><script>never ends <p>x", "a"),
    ("<table><tr><td>one<td>two<tr><td>three</table>", "one\n\ntwo\n\nthree"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<pre>a\n  b</pre>", "a b"), ("<p>x&nbsp;y</p>", "x y"), ("</p></div></b>after", "after"),
])
def test_small_pages(page, text):
    assert html_text.main_text(page) == text


def test_boilerplate_around_and_in_the_article():
    links = "".join(f'<li><a href="/{i}">Menu entry number {i}</a></li>' for i in range(30))
    page = f"""<!DOCTYPE html><html><head><title>T</title><meta charset="utf-8"></head><body>
      <header><h1>Site name</h1></header><nav><ul>{links}</ul></nav>
      <div class="cookie-notice">We use cookies. {LONG}</div>
      <main><article><header><h1>Heading</h1></header><p>{LONG}</p>
        <div class="advert">Buy this! {LONG}</div><aside>{LONG}</aside><p>Second, with a <a href="/x">link</a>.</p>
        <form><label>Mail</label><input name="m"><button>Send</button></form>
        <ul><li>one</li><li>two</li></ul></article></main>
      <div id="sidebar">{LONG}</div><section class="comments"><p>Great article! {LONG}</p></section>
      <footer>&copy; 2024</footer></body></html>"""
    body = " ".join(LONG.split())
    assert html_text.main_text(page) == f"Heading\n\n{body}\n\nSecond, with a link.\n\none\n\ntwo"


def test_density_finds_the_text_without_semantic_tags():
    links = "".join(f'<a href="/{i}">Entry {i}</a> ' for i in range(40))
    page = (f"<body><div>{links}</div><div><div><h2>Heading</h2><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></div>"
            f"<div>{links}</div></body>")
    got = html_text.main_text(page)
    assert got.count("This paragraph") == 9 and "Entry" not in got and got.startswith("Heading")


def paragraphs(n, name):
    return "".join(f"<p>{name}{i} {LONG}</p>" for i in range(n))


def named(text):
    return re.findall(r"\b[a-z]+\d+\b", text)


LINKS = "<div><ul>" + "".join(f'<li><a href="/{i}">Menu entry number {i}</a></li>' for i in range(40)) + "</ul></div>"


@pytest.mark.parametrize("page,names", [
    # several blocks directly below the body, with a title and text between them
    (f"<body><h1>title0 of it</h1><div>{paragraphs(6, 'a')}</div>loose0 {LONG}<div>{paragraphs(3, 'b')}</div></body>",
     ["title0", *(f"a{i}" for i in range(6)), "loose0", "b0", "b1", "b2"]),
    (f"<body><div>{paragraphs(2, 'a')}</div><div><div>{paragraphs(6, 'b')}</div></div><p>c0 {LONG}</p></body>",
     ["a0", "a1", *(f"b{i}" for i in range(6)), "c0"]),
    # a section with a link
    (f"<div><section>{paragraphs(8, 'a')}</section><section>{paragraphs(5, 'b')}<p>b5 <a href='/x'>see</a> {LONG}</p></section></div>",
     [*(f"a{i}" for i in range(8)), *(f"b{i}" for i in range(6))]),
    # a block that links keep below the threshold: the paragraphs in it that reach it
    (f"<body><div>{paragraphs(8, 'a')}</div><div>{paragraphs(2, 'b')}{LINKS}</div></body>",
     [*(f"a{i}" for i in range(8)), "b0", "b1"]),
    # two articles, in main and without
    (f"<body>{LINKS}<main><article>{paragraphs(6, 'a')}</article><article>{paragraphs(2, 'b')}</article></main></body>",
     [*(f"a{i}" for i in range(6)), "b0", "b1"]),
    (f"<body><article>{paragraphs(2, 'a')}</article>{LINKS}<div><article>{paragraphs(6, 'b')}</article></div></body>",
     ["a0", "a1", *(f"b{i}" for i in range(6))]),
])
def test_all_blocks_that_reach_the_threshold(page, names):
    got = html_text.main_text(page)
    assert named(got) == names and "Menu entry" not in got


def test_slug_ids_in_the_article():
    inner = ('<h2 id="related-work">Related work</h2><section id="search-and-rescue"><p>a rescue</p></section>'
             '<p id="notice-1">a notice</p><h3 id="comments">Comments</h3>')
    for tag in ("article", "main"):
        page = f'<{tag}>{inner}<div id="comments">no</div><div class="related-posts">no</div></{tag}><div id="search-box">no</div>'
        assert html_text.main_text(page) == "Related work\n\na rescue\n\na notice\n\nComments"


def test_deep_and_broken_markup():
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 4000) == "deep"
    assert html_text.main_text("<p " + "a" * 10_000) == ""
    assert "x" in html_text.main_text("<b><p>x</b></p><i>y")


def test_table_articles(spark):
    """On the whole table: the text of every article element, and nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)[^>]*>", re.sub(r"<br>", " ", inner))
        want = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
        assert got[r.page_id].text == "\n\n".join(p for p in want if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_null_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a", "y")], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract_text(df).collect()), key=str) == [(1, "u", "a", 1), (1, None, "", 0)]
    assert html_text.extract_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("page,text", [
    ("<article><p title=it's>Hello world</p><p>don't stop</p></article>", "Hello world\n\ndon't stop"),
    ('<article><p title=it"s>Hello world</p><p>do"nt stop</p></article>', 'Hello world\n\ndo"nt stop'),
    ("<p title='a > b'>one</p><p title = \"c > d\">two</p>", "one\n\ntwo"),
    ("<p>one</p><!--><p>two</p>", "one\n\ntwo"), ("<p>one</p><!---><p>two</p>", "one\n\ntwo"),
    ("<p>one</p><!-- x --!><p>two</p>", "one\n\ntwo")])
def test_quotes_and_comments_as_in_browsers(page, text):
    assert html_text.main_text(page) == text


def test_reader_comments_go_and_headed_sections_stay():
    page = ("<article><p>The text.</p><section id=comments><p>First!</p></section><section id='user-comments'><p>Me too.</p>"
            "</section><section id='comments-on-the-law'><p>A chapter.</p></section><h2 id='comments'>Heading</h2>"
            "<section id='replies-by-date'><article><time>1</time>No</article><article>No</article></section>"
            "<section id='search-and-rescue'><p>Another.</p></section></article>")
    assert html_text.main_text(page) == "The text.\n\nA chapter.\n\nHeading\n\nAnother."


def test_words_of_a_sentence_stay():
    page = ("<article><p>See the <a class=share href=x>shared results</a> now.</p><p class='side-note'>A note.</p>"
            "<p class='ad'>Buy.</p><div class='share'><a class=share>Share</a></div></article>")
    assert html_text.main_text(page) == "See the shared results now.\n\nA note."


@pytest.mark.parametrize("page", ["<div>" * 40_000, "<b>" * 40_000, "<b>" * 20_000 + "</i>" * 20_000 + "<h1>x</h1>" * 20_000,
                                  "<ul>" * 20_000 + "<li>x" * 20_000, '<a x="' * 20_000])
def test_time_is_linear(page):
    start = time.perf_counter()
    html_text.main_text(page + "x")
    assert time.perf_counter() - start < 8


def test_density_sum_and_threshold_by_the_formula():
    """Every node of random small pages against the formulas, computed from the text."""
    rng = random.Random(4)

    def make(depth):
        tag = rng.choice(["div", "p", "a", "span", "section"] if depth else ["div"])
        inner = [rng.choice(["word " * rng.randint(1, 30), make(depth + 1) if depth < 4 else "x"]) for _ in range(rng.randint(1, 4))]
        return (tag, inner)

    def markup(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(markup, node[1]))}</{node[0]}>"

    def chars(s):
        return sum(map(len, s.split()))

    def below(node):
        return [] if isinstance(node, str) else [c for c in node.children] + [x for c in node.children for x in below(c)]

    def counts(node):
        links = [c for c in below(node) if not isinstance(c, str) and c.tag == "a"]
        outer = [c for c in links if not any(c in below(o) for o in links)]
        text = lambda n: sum(chars(c) for c in below(n) if isinstance(c, str))
        return text(node), sum(not isinstance(c, str) for c in below(node)), sum(map(text, outer)), len(links)

    for _ in range(40):
        page = markup(make(0))
        root = html_text.parse(page)
        order = html_text._count(root)
        body_chars, _, body_links, _ = counts(root)
        for node in order:
            c, t, lc, lt = counts(node)
            assert (node.chars, node.tags, node.link_chars, node.link_tags) == (c, t, lc, lt)
            if c:
                base = math.log(c / max(c - lc, 1) * lc + max(body_links, 1) / max(body_chars, 1) * c + math.e)
                want = c / max(t, 1) * max(math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log(max(base, 1.0001)), 0)
                assert node.density == pytest.approx(want)
            own = sum(chars(x) for x in node.children if isinstance(x, str))
            inline = node.tag in html_text.INLINE
            want = own if inline else own / (1 + t)
            want += sum(x.sum if x.tag in html_text.INLINE else x.density for x in node.children if not isinstance(x, str))
            assert node.sum == pytest.approx(want)

        again = html_text.parse(page)
        chosen = html_text.content(again)
        blocks = [n for n in [again, *below(again)] if not isinstance(n, str) and n.tag not in html_text.INLINE]
        most = max(n.sum for n in blocks)
        assert any(c.sum == most for c in chosen)
