"""HTML extraction on pages written by hand: layouts, names and wordings that label_pages() doesn't make."""

import time

import late_pages
import pytest

from quillspark.llm import html_extract

A = "The harbour froze over in the second week of January, and for nine days no boat could leave the inner basin."
B = "Fishermen carried their nets across the ice on sledges, while children skated between the hulls until dark."
C = "By the end of the month a warm wind had broken the ice, and the first trawlers went out past the lighthouse again."
T = "Nine days of ice"
LIST = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/a">About</a></li></ul>'
ARTICLE = f"<h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p>"
ALL = [T, A, B, C]

PAGES = {
    "quote inside an unquoted value": (f"<body><article><p title=don't>{A}</p><p>It's late. {B}</p></article>", [A, "It's late. " + B]),
    "unclosed select": (f"<body><form><select><option>One<option>Two</form><article>{ARTICLE}</article>", ALL),
    "unclosed select before paragraphs": (f"<article><h1>{T}</h1><select><option>One<option>Two<p>{A}</p><p>{B}</p><p>{C}</p></article>", ALL),
    "options of a datalist": (f"<article><h1>{T}</h1><datalist id=x><option value=a><option value=b></datalist><p>{A}</p><p>{B}</p></article>", [T, A, B]),
    "unclosed svg": (f"<article><h1>{T}</h1><div><svg><path d='M0'></div><p>{A}</p><p>{B}</p></article>", [T, A, B]),
    "unclosed iframe": (f"<article><h1>{T}</h1><iframe src=x><p>{A}</p><p>{B}</p></article>", [T, A, B]),
    "math in a paragraph": (f"<article><h1>{T}</h1><p>{A} <math><mi>x</mi></math></p><p>{B}</p></article>", [T, A + " x", B]),
    "object with other text": (f"<article><h1>{T}</h1><p>{A}</p><object data=x><p>{B}</p></object><p>{C}</p></article>", ALL),
    "divisions without names": (f"<html><body><div>{LIST}</div><div><h1>{T}</h1><p>{A} {B}</p><p>{C} {A}</p></div><div>&copy; 2024 Harbour News. All rights reserved.</div></body></html>", [T, f"{A} {B}", f"{C} {A}"]),
    "divisions in divisions": (f"<body><div><div>{LIST}</div><div><div><h1>{T}</h1><div><p>{A}</p><p>{B}</p><p>{C}</p></div></div></div></div></body>", ALL),
    "text in bare divisions": (f"<body><div><a href=/>Home</a> <a href=/n>News</a> <a href=/a>About</a></div><div><div>{A} {B}</div><div>{C} {B}</div></div>", [f"{A} {B}", f"{C} {B}"]),
    "line breaks for paragraphs": (f"<body><div><a href=/>Home</a> | <a href=/n>News</a> | <a href=/a>About</a></div><div>{A} {B}<br><br>{C} {B}</div>", [f"{A} {B} {C} {B}"]),
    "preformatted text": (f"<article><h1>{T}</h1><p>{A}</p><pre>ice = 9\n  boats = 0</pre><p>{B}</p></article>", [T, A, "ice = 9 boats = 0", B]),
    "caption of a figure": (f"<article><h1>{T}</h1><figure><img src=x><figcaption>The basin, seen from the pier.</figcaption></figure><p>{A}</p><p>{B}</p></article>", [T, "The basin, seen from the pier.", A, B]),
    "a table for the layout": (f"<body><table><tr><td>{LIST}</td><td><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p></td></tr></table></body>", ALL),
    "a table without end tags": (f"<body><table width=100%><tr><td width=20%><a href=/>Home</a><br><a href=/a>About</a><td><h1>{T}</h1><p>{A} {B}<p>{C} {A}</table>", [T, f"{A} {B}", f"{C} {A}"]),
    "unknown names": (f'<body><div class="zz1">{LIST}</div><div class="zz2"><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p></div><div class="zz3">Copyright Harbour News. All rights reserved.</div></body>', ALL),
    "utility names": (f'<body class="no-js has-sidebar"><div class="mt-4 px-2 flex">{LIST}</div><div class="mt-8 max-w-prose">{ARTICLE}</div></body>', ALL),
    "compound names": (f'<body><div class="site-header__inner"><a href=/>Harbour News</a></div><div class="article__text">{ARTICLE}</div><div class="article-footer-links">{LIST}</div><div class="post-comments"><p>{B}</p></div></body>', ALL),
    "upper case": (f'<HTML><BODY><NAV>{LIST}</NAV><ARTICLE><H1>{T}</H1><P>{A}</P><P>{B}</P></ARTICLE><FOOTER>Harbour News</FOOTER></BODY></HTML>', [T, A, B]),
    "nothing but paragraphs": (f"<p>{A}</p><p>{B}</p><p>{C}</p>", [A, B, C]),
    "no body": (f"<html><nav>{LIST}</nav><main>{ARTICLE}</main></html>", ALL),
    "unclosed paragraphs and items": (f"<article><h1>{T}</h1><p>{A}<ul><li>Nets<li>Sledges</ul><p>{B}<p>{C}</article>", [T, A, "Nets", "Sledges", B, C]),
    "formatting over paragraphs": (f"<article><h1>{T}</h1><b><p>{A}</b></p><i><p>{B}</p></i></article>", [T, A, B]),
    "stray end tags": (f"</div></p><article></section><h1>{T}</h1></span><p>{A}</b></p></table><p>{B}</p></article>", [T, A, B]),
    "heading closed by another": (f"<article><h1>{T}</h2><p>{A}</p><p>{B}</p></article>", [T, A, B]),
    "comments of all kinds": (f"<!--><article><!-- <p>no</p> --><h1>{T}</h1><!-- a --!><p>{A}</p><![CDATA[x]]><p>{B}</p><?php x ?></article>", [T, A, B]),
    "angle brackets in text": (f"<article><h1>{T}</h1><p>{A} 3 < 4 and 5 > 4.</p><p>{B}</p></article>", [T, A + " 3 < 4 and 5 > 4.", B]),
    "greater-than in a value": (f'<article><h1>{T}</h1><p data-x="a > b" class=\'x>y\'>{A}</p><p>{B}</p></article>', [T, A, B]),
    "a script with markup": (f"<article><h1>{T}</h1><script>document.write('<p>no</p>');if(a<b){{}}</script><p>{A}</p><style>p > b {{}}</style><p>{B}</p></article>", [T, A, B]),
    "noscript, template, button": (f"<article><h1>{T}</h1><noscript><p>Turn it on.</p></noscript><p>{A}</p><template><p>no</p></template><p>{B} <button>Share</button></p></article>", [T, A, B]),
    "character references": (f"<article><h1>Nine &amp; days &#8211; of &eacute;t&#xE9;</h1><p>{A}&nbsp;&hellip;</p><p>{B}</p></article>", ["Nine & days – of été", A + " …", B]),
    "white space": (f"<article>\n\n  <h1>\n {T}\t</h1>\r\n<p> {A[:40]}\n\n   {A[40:].strip()} </p><p>{B}</p></article>", [T, A[:40].strip() + " " + A[40:].strip(), B]),
    "search box and login": (f'<body><form action=/s><input name=q><label>Search the site</label></form><main>{ARTICLE}</main><form><p>Log in to comment.</p></form></body>', ALL),
    "cookie bar": (f'<body><div id="cookie-bar"><p>We use cookies to make this site better for you.</p><button>Accept</button></div><main>{ARTICLE}</main></body>', ALL),
    "cards of other stories": (f'<body><main>{ARTICLE}</main><div class="related-stories"><h3>More</h3><a href=/1><div>Storm over the bay</div></a><a href=/2><div>A new pier</div></a></div></body>', ALL),
    "reader comments": (f'<body><article>{ARTICLE}</article><ol class="comment-list"><li class="comment"><p>{B}</p></li><li class="comment reply"><p>I was there too, it was cold.</p></li></ol></body>', ALL),
    "an advert within": (f'<body><article><h1>{T}</h1><p>{A}</p><div class="advert-slot"><p>Warm boots at half price, this week only.</p></div><p>{B}</p></article></body>', [T, A, B]),
    "an aside within": (f"<body><article><h1>{T}</h1><p>{A}</p><aside><h2>See also</h2>{LIST}</aside><p>{B}</p><p>{C}</p></article></body>", ALL),
    "links in prose": (f'<body><main><h1>{T}</h1><p>{A} See <a href="/x">the archive</a>.</p><p><a href="/y">Fishermen</a> {B[10:]}</p></main></body>', [T, A + " See the archive.", B]),
    "data in a table": (f"<article><h1>{T}</h1><p>{A}</p><table><thead><tr><th>Day<th>Ice</thead><tbody><tr><td>1<td>4 cm</tbody></table><p>{B}</p></article>", [T, A, "Day", "Ice", "1", "4 cm", B]),
    "a quotation": (f"<article><h1>{T}</h1><p>{A}</p><blockquote>{B}</blockquote><p>{C}</p></article>", ALL),
    "anchors without links": (f'<body><a name="top"><main>{ARTICLE}</main></body>', ALL),
    "two articles": (f"<body><main><article><h2>{T}</h2><p>{A}</p></article><article><h2>Thaw</h2><p>{C}</p></article></main><nav>{LIST}</nav></body>", [T, A, "Thaw", C]),
    "a page that was cut": (f"<body><nav>{LIST}</nav><article><h1>{T}</h1><p>{A}</p><p>{B[:50]}", [T, A, B[:50].strip()]),
    "a page cut in a tag": (f'<body><article><h1>{T}</h1><p>{A}</p><p>{B}</p><div class="x', [T, A, B]),
    "menus only": (f"<body><nav>{LIST}</nav><footer>{LIST}</footer></body>", []),
}


@pytest.fixture(scope="module")
def found():
    model = html_extract.trained()
    return {name: html_extract.extract(page, model)[0].split("\n\n") for name, (page, _) in PAGES.items()}


@pytest.mark.parametrize("name", PAGES)
def test_page(found, name):
    assert [x for x in found[name] if x] == PAGES[name][1]


@pytest.mark.parametrize("name,page,want", [(k, *v) for k, v in (late_pages.PAGES | late_pages.REPORTED).items()])
def test_late_page(name, page, want):
    assert [x for x in html_extract.extract(page, html_extract.trained())[0].split("\n\n") if x] == want


@pytest.mark.parametrize("attributes,hidden", [(" hidden", True), (' hidden="until-found"', False), (' class="x hidden"', False), (" style='color:red; Display : None'", True), (' data-x="display:none"', False), (" data-hidden=1", False), (" style=visibility:hidden", True)])
def test_what_is_not_shown(attributes, hidden):
    page = f"<article><h1>{T}</h1><p>{A}</p><div{attributes}><p>{B}</p><p>{C}</p></div></article>"
    got = html_extract.extract(page, html_extract.trained())[0].split("\n\n")
    assert got == ([T, A] if hidden else ALL)


def test_an_article_is_given_where_none_is_seen():
    """Not where menus, notices or comments alone have prose."""
    model = html_extract.trained()
    for page in (f"<nav><p>{A}</p></nav>", f'<div class="comments"><p>{A}</p></div>', f"<div hidden><p>{A}</p></div>", "<article><a href=/>x</a></article>", "<main></main>", ""):
        assert html_extract.extract(page, model)[0] == ""
    nodes, _ = html_extract.parse(f'<nav><p>{A}</p></nav><div><div><p>{A}</p></div><p>{B}</p></div><footer><p>{C}</p></footer>')
    assert (nodes[html_extract.holder(nodes)].tag, nodes[html_extract.holder(nodes)].parent) == ("div", 1)


def test_tables(spark):
    """An empty table, null and repeated rows, columns with the result's names, a very long page, a tie-free order of rows."""
    schema = "page_id long, url string, html string, text string, n_chars long"
    assert html_extract.extract_pages(spark.createDataFrame([], schema)).count() == 0
    long = f"<article><h1>{T}</h1>" + f"<p>{A}</p>" * 20000 + "</article>"
    page = PAGES["character references"][0]
    rows = [(1, "u", page, "x", 5), (1, "u", page, "x", 5), (None, None, page, None, None), (2, "u", None, "x", 1), (3, "u", long, "x", 1)]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_pages(spark.createDataFrame(rows, schema)).collect()]
    want = "\n\n".join(PAGES["character references"][1])
    assert sorted(got, key=repr) == sorted([(1, want, len(want))] * 2 + [(None, want, len(want)), (2, "", 0), (3, x := "\n\n".join([T] + [A] * 20000), len(x))], key=repr)


@pytest.mark.parametrize("part", ["<b>", "</i>", "<div>", "<p>", "<td>", "<h1>", "<select>", "<textarea>", "<a href=x>", "<!--", "<x y='", "</p>", "< ", "<li><b>"])
def test_linear_in_the_page(part):
    began = time.time()
    html_extract.parse(part * 100_000 + "<p>end</p>" + "</i></b></select>" * 1000)
    assert time.time() - began < 8


def test_many_unclosed_then_closed():
    began = time.time()
    html_extract.extract("<b>" * 100_000 + "</i>" * 100_000 + "text", html_extract.trained())
    html_extract.extract("<div><b>x" * 50_000 + "</div>" * 50_000, html_extract.trained())
    assert time.time() - began < 20
