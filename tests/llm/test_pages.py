from __future__ import annotations

import pytest

from forgepulse.llm import pages as P

SCHEMA = "page_id long, url string, html string, place int, host string, body int, trees string, text int, gone int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 2, "t", 3, 4) for r in rows], SCHEMA)


def texts(spark, rows, **options):
    found = P.main_text(frame(spark, rows), **options).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return {r["page_id"]: r["text"] for r in found}


def alone(page):
    """Text of one page by its markup, without a host."""
    elements = P.in_order(root := P.parse(page))
    P.measure(elements)
    held, named = P.content(elements)
    P.candidates(elements, held, named)
    joined = "".join(t for t, _ in P.pieces_of(root, named))
    return [line for line in (" ".join(x.split()) for x in joined.split("\n")) if line]


@pytest.mark.parametrize("page, lines", [
    ("", []),
    ("plain & simple", ["plain & simple"]),
    ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
    ("<article><h1>T</h1><p><b>x<br><p>y</p></article><footer>z</footer>", ["T", "x", "y"]),
    ("<p>one<br>two<br/>three</p>", ["one two three"]),
    ("<P>&amp;amp; &lt;b&gt; &#65;&#x42; &nbsp;&copy 3 < 4 &bogus; &am</P>", ["&amp; <b> AB © 3 < 4 &bogus; &am"]),
    ("<p>a <i>b</i><b>c</b>\n\t d</p>", ["a bc d"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>1<td>2<tr><th>3</th><td>4</table>", ["1 2", "3 4"]),
    ("<!-- <p>no</p> --><!--> <p>yes<!-- open <p>never", ["yes"]),
    ("<script>var a='</p>'; if (a<b) x();</script><style>p{}</style><p>t</p><script>rest <p>no", ["t"]),
    ("<title>no</title><head><p>yes</head>", ["yes"]),
    ("<p title='a > b' data-class=\"ad\">x</p><p class=\"note\">y</p>", ["x", "y"]),
    ("<p title=it's>x</p><p>don't</p>", ["x", "don't"]),
    ("</p></div>a</b>b</article>", ["ab"]),
    ("<p>a</p", ["a"]),
    ("<p>a<b", ["a"]),
    ("<article>a<nav>b</nav><aside>c</aside><form>d</form><div class='social-share'>e</div>f</article>", ["a", "f"]),
    ("<main><h1>T</h1><article>a</article><article>b</article></main>x", ["T", "a", "b"]),
    ("<article>a</article><section id=comments><article>no</article></section>", ["a"]),
    ("<article><header><h1>T</h1></header>a<div class='post-header'><h2>U</h2></div></article><header><h1>S</h1></header>", ["T", "a", "U"]),
    ("<body class='sidebar-open'><div class='no-sidebar'><div role=main>a</div><div role=navigation>b</div></div>", ["a"]),
    ("<div class='cookieNotice'>a</div><div id='comments'>b</div><div class='ad'>c</div><div hidden>d</div><p>e</p>", ["e"]),
    ("<form><p>a long text of the page in a form</p><input><button>ok</button></form><p>b</p>", ["a long text of the page in a form", "b"]),
    ("<p>a long text of the page itself</p><form><label>mail</label><input></form>", ["a long text of the page itself"]),
    ("<pre>a\n  b</pre><blockquote>c<p>d</blockquote>", ["a b", "c", "d"]),
    ("<p>　日本 語</p><p>😀</p>", ["日本 語", "😀"]),
    ("<svg><title>t</title><path/></svg><p>a<svg/>b</p>", []),
])
def test_markup(page, lines):
    if page.startswith("<svg>"):  # what follows an svg that is never closed is part of it
        lines = ["a"]
    assert alone(page) == lines


def host_page(body):
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


def test_templates_without_any_telling_markup(spark):
    """Boxes that recur on a host go, the same boxes on another host and rare ones stay."""
    rows = []
    for i in range(12):
        box = f"<div><b>Follow</b> us</div><div><p>Story {i} begins here.</p><p>It has several paragraphs, number {i * 7}.</p></div><div>All rights, {i % 2}</div>"
        rows.append((i, f"https://a.example/{i}", host_page(box)))
    rows.append((100, "https://b.example/x", rows[0][2]))
    rows.append((101, None, rows[1][2]))
    found = texts(spark, rows)
    for i in range(12):
        assert found[i] == f"Story {i} begins here.\nIt has several paragraphs, number {i * 7}."
    assert found[100].startswith("Follow us\nStory 0") and found[100].endswith("All rights, 0")
    assert found[101].startswith("Follow us\n")
    assert texts(spark, rows, least=7)[0].endswith("All rights, 0")  # that box is on six pages


def test_copies_of_a_page_are_no_template(spark):
    one = host_page("<div><p>Only one story, told at many addresses.</p><div>In a box.</div></div>")
    rows = [(i, f"http://user@WWW.A.example:80/{i}?q#f", one) for i in range(20)]
    # The same story in another frame each time: the frame recurs, the story is one content.
    rows += [(50 + i, f"http://a.example/f{i}", one.replace("</body>", f"<div>frame {i // 3}</div></body>")) for i in range(30)]
    found = texts(spark, rows)
    assert set(found.values()) == {"Only one story, told at many addresses.\nIn a box."} | {
        f"Only one story, told at many addresses.\nIn a box.\nframe {i}" for i in range(10)
    }


def test_common_lines_of_an_article_stay_and_boxes_in_it_go(spark):
    rows = [
        (i, "http://a.example/", host_page(f"<article><p>Text {i}</p><p>A common line.</p><div>Read more!</div><ul><li><a href=x>one</a><li><a href=y>two</a></ul></article>"))
        for i in range(10)
    ]
    assert texts(spark, rows) == {i: f"Text {i}\nA common line." for i in range(10)}
    flat = [(i, "http://a.example/", host_page(f"<h1>Title {i}</h1><p>Text {i}</p><p>{'Often' if i < 4 else 'Notice on most pages'}</p>")) for i in range(10)]
    found = texts(spark, flat)
    assert found[0] == "Title 0\nText 0\nOften" and found[9] == "Title 9\nText 9"


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "", ""), (None, "x", "<p>a</p>"), (3, "http://h", " \n "), (3, "http://h", "<p>b</p>"),
        (3, "http://h", "<p>b</p>"), (4, "http://h", "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>"),
        (5, "http://h", "<p>" + "long " * 200_000 + "</p>"), (6, "//", "a\u0000b"), (7, "http://[::1]/x", "<p>&#xD800;</p>"),
    ]
    found = sorted(P.main_text(frame(spark, rows)).collect(), key=lambda r: (r["page_id"] or 0, r["text"]))
    assert [(r["page_id"], r["url"]) for r in found][:3] == [(None, "x"), (1, None), (2, "")]
    by_id = {r["page_id"]: r["text"] for r in found}
    assert by_id[None] == "a" and by_id[1] == "" and by_id[2] == "" and by_id[4] == "deep\nafter"
    assert by_id[5] == ("long " * 200_000).strip() and by_id[6] == "a\u0000b" and by_id[7] == "�"
    assert sorted(r["text"] for r in found if r["page_id"] == 3) == ["", "b", "b"]
    assert P.main_text(frame(spark, [])).count() == 0


def test_given_pages_hold_the_lines_of_their_documents(spark):
    """Each page shows a document under its title; its address ends in the document's id."""
    folder = "/root/testdata/sf0.01"
    pages, docs = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("pages", "documents"))
    lines = {r["doc_id"]: [x for x in (" ".join(y.split()) for y in r["text"].split("\n")) if x] for r in docs.where("text is not null").collect()}
    found = P.main_text(pages).selectExpr("text", "cast(regexp_extract(url, '/([0-9]+)', 1) as long) as doc").collect()
    shown = [r for r in found if r["doc"] in lines]
    assert len(found) == pages.count() and len(shown) > 200
    assert all(r["text"].split("\n")[1:] == lines[r["doc"]] for r in shown)
