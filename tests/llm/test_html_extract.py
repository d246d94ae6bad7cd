"""Main-text extraction: known articles inside several page designs, broken markup, edge rows."""

import html
import random
import re

from shoplens.llm import html_extract as H

SCHEMA = "page_id long, url string, html string, text string"
RNG = random.Random(8)
WORDS = "river mill harbour stone light winter market garden letter window engine valley paper song road".split()


def prose(n):
    out = [RNG.choice(WORDS) for _ in range(n)]
    for k in range(6, n, 9):
        out[k] += RNG.choice([",", ".", "."])
    return " ".join(out).capitalize() + "."


def designs():
    h, ps = prose(6), [prose(RNG.randint(25, 90)) for _ in range(5)]
    body = "".join(f"<p>{p}</p>" for p in ps)
    nav = "<nav><ul>" + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in WORDS) + "</ul></nav>"
    menu = "<div class='main-menu'>" + " | ".join(f"<a href='/{w}'>{w}</a>" for w in WORDS) + "</div>"
    remarks = "".join(f"<div class='comment'><b>{w}</b><p>{prose(30)}</p></div>" for w in WORDS[:4])
    foot = f"<footer><p>{prose(20)}</p></footer>"
    want = " ".join([h, *ps])
    yield f"<html><body>{nav}<article><h1>{h}</h1>{body}<section id=comments>{remarks}</section></article>{foot}</body></html>", want
    yield (f"<body>{menu}<div id=wrap><div class='post-body'><h2>{h}</h2>{body}<form><p>{prose(12)}</p></form></div>"
           f"<div class='right sidebar'><h3>{prose(4)}</h3><p>{prose(60)}</p></div></div><div id='footer'>{prose(9)}</div></body>"), want
    yield (f"<body class='no-sidebar'><header><h1>{prose(5)}</h1></header><main><h1>{h}</h1>{body}<aside>{prose(50)}</aside></main>"
           f"<div role='contentinfo'>{prose(15)}</div><div class=cookie-notice><p>{prose(40)}</p></div>"), want
    yield (f"<table><tr><td>{menu}</td><td><h1>{h}</h1>{body}</td></tr></table>", want)
    yield f"<div class=ad><p>{prose(50)}</p></div><article><h1>{h}<p>" + "<p>".join(ps) + "</article>", want


def test_known_articles():
    for page, want in designs():
        assert H.main_text(page) == want, page


def test_short_blocks_and_lists_of_the_article_stay():
    ps = [prose(60), prose(70)]
    page = (f"<body><div class='nav'>{prose(4)}</div><article><h1>One</h1><p>{ps[0]}</p><h2>Two</h2><ul><li>three<li>four</ul>"
            f"<p>{ps[1]}</p><p>End.</p></article></body>")
    assert H.main_text(page) == f"One {ps[0]} Two three four {ps[1]} End."


def test_references_white_space_and_inline_elements():
    page = "<article><p>Fish &amp; chips&nbsp;&#8364;5 &lt;b&gt; &unknown; &copy 2<br>a<b>b</b>c\n\t d</p></article>"
    assert H.main_text(page) == "Fish & chips €5 <b> &unknown; © 2 abc d"
    text = "x &amp;amp; y <!-- no --> z"
    assert H.main_text(f"<p>{text}</p>") == "x &amp; y z"


def test_scripts_styles_and_broken_markup():
    keep = prose(40)
    assert H.main_text(f"<script>var t = '</p>' + \"<p>{prose(60)}</p>\";</script><p>{keep}</p><style>p{{a:b}}</style>") == keep
    assert H.main_text(f"<p>{keep}<!-- open {prose(50)}") == keep
    assert H.main_text(f"<p title='a > b'>{keep}</p") .startswith(keep)
    assert H.main_text(f"<div><p>{keep}</div></div></p></b>") == keep
    assert H.main_text("a < b and b > c") == "a < b and b > c"
    assert H.main_text("<") == "<" and H.main_text("<p") == "<p" and H.main_text("<>") == "<>"


def test_never_fails_on_random_markup():
    parts = ["<p>", "</p>", "<div class='", "'>", "text, ", "<a href=x>", "</a>", "<!--", "-->", "<script>", "</script>", "<li", "&", "&#x", "<td>",
             "</div", "\"", "<br/>", "\x00", "<ARTICLE>", "</article>", "<![CDATA[", "]]>", "é"]
    for seed in range(300):
        rng = random.Random(seed)
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        got = H.main_text(page)
        assert got == got.strip() and "\n" not in got


def test_long_pages_take_linear_time():
    assert len(H.main_text("<p>" + "word, " * 300_000)) == 1_799_999
    assert H.main_text("<" * 200_000).startswith("<<")
    assert H.main_text("<p a='" * 20_000) is not None


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>Some text.</p>", None), (3, "u", "plain", "x"), (3, "u", "plain", "x")]
    out = H.extract(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((str(r.page_id), r.url, r.text, r.n_chars) for r in out.collect())
    assert got == [("1", "u", "", 0), ("2", None, "", 0), ("3", "u", "plain", 5), ("3", "u", "plain", 5), ("None", "u", "Some text.", 10)]
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages_equal_their_article_elements(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in H.extract(pages).collect():
        inner = re.search("<article>(.*)</article>", source[r.page_id], re.S).group(1)
        inner = re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split()) and r.n_chars == len(r.text)


def test_without_article_element_one_long_paragraph_is_not_the_article():
    h, intro, long = "Old mill", "A short start", prose(300)
    for page in (f"<body><div><h1>{h}</h1><p>{intro}</p><p>{long}</p></div></body>",
                 f"<body><h1>{h}</h1><p>{intro}</p><p>{long}</p></body>",
                 f"<body><nav>{prose(9)}</nav><div><div><h1>{h}</h1><p>{intro}</p><p><span>{long}</span></p></div></div></body>"):
        assert H.main_text(page) == f"{h} {intro} {long}", page


def test_without_article_element_a_lead_beside_the_body_stays():
    lead, ps = prose(60), [prose(90) for _ in range(4)]
    body = "".join(f"<p>{p}</p>" for p in ps)
    menu = "".join(f"<a href='/{w}'>{w}</a> " for w in WORDS)
    for inner in (f"<div><p>{lead}</p></div>", f"<div>{lead}</div>"):
        page = f"<body><div id=all><div>{menu}</div>{inner}<div>{body}</div><div>{menu}</div></div></body>"
        assert H.main_text(page) == " ".join([lead, *ps])


def test_a_class_word_on_a_wrapper_does_not_empty_the_page():
    h, ps = prose(6), [prose(80) for _ in range(4)]
    body = f"<h1>{h}</h1>" + "".join(f"<p>{p}</p>" for p in ps)
    side = f"<div class=sidebar><p>{prose(30)}</p></div>"
    want = " ".join([h, *ps])
    for name in ("class='layout sidebar-right'", "id='content-related'", "class='site-banner-layout'"):
        assert H.main_text(f"<body><div {name}><div>{body}</div>{side}</div><footer>{prose(9)}</footer></body>") == want
        assert H.main_text(f"<body><p>{prose(70)}</p><div {name}><article>{body}{side}</article></div></body>").endswith(want)
        assert H.main_text(f"<body>{side}<article><div {name}>{body}</div>{side}</article></body>") == want
    many = "".join(f"<div class=comment><article><p>{prose(80)}</p></article></div>" for _ in range(9))
    assert H.main_text(f"<body><article>{body}</article><section class=comments>{many}</section></body>") == want
    inline = f"<article><p><span class=ad>Ad</span>{ps[0]} <span class=share>Share</span></p><p>{ps[1]}</p></article>"
    assert H.main_text(inline) == f"{ps[0]} {ps[1]}"
