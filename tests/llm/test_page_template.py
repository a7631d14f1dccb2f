"""Main texts and templates of small sites."""

import pytest

from pageloom.llm import page_template as pt

SCHEMA = "page_id long, url string, html string, host string, fixed string, text string"


def _site(n, host="a.example"):
    """Pages in plain divs: menu, fixed notice and varying text, nothing named."""
    rows = []
    for i in range(n):
        body = "".join(f"<div class=c><p>Text {i} of part {j}, long enough to be more than the rest.</div>" for j in range(1 + i % 3))
        rows.append(
            (i, f"https://{host}/{i}",
             "<html><head><title>T</title><style>a{}</style></head><body><div><a href=/>Home</a> "
             f"<a href=/x>About {i}</a></div><div>All rights reserved.</div>{body}<script>f('<p>no</p>')</script>"
             "<div><span>Printed on paper.</span></div></body></html>")
        )
    return rows


def _run(spark, rows, **limits):
    pages = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)
    return pt.main_text(pages.repartition(3), **limits).collect()


def test_slots_of_a_site_without_named_parts(spark):
    rows = _site(9)
    got = {r.page_id: r for r in _run(spark, rows)}
    for i, _, _ in rows:
        expected = " ".join(f"Text {i} of part {j}, long enough to be more than the rest." for j in range(1 + i % 3))
        assert (got[i].text, got[i].n_chars) == (expected, len(expected))


def test_template_of_a_site(spark):
    pages = spark.createDataFrame([(*r, "", "", "") for r in _site(9)], SCHEMA)
    found = pt.deduce_templates(pt.keyed_pages(pages)).collect()
    (root,) = [r for r in found if r.parent_id is None]
    assert (root.n_pages, root.n_occurrences) == (9, 9)
    assert {"html", "body", "span"} <= set(root.tags)
    assert {"Home", "All rights reserved.", "Printed on paper."} <= set(root.texts)
    (inner,) = [r for r in found if "div.c" in r.tags]
    assert inner.parent_id == root.class_id and inner.n_occurrences == sum(1 + i % 3 for i in range(9))
    assert not any("Text" in t for r in found for t in r.texts)


def test_few_pages_have_no_template(spark):
    got = _run(spark, _site(3))
    assert all("All rights reserved." in r.text and "Home" not in r.text for r in got)


def test_copies_are_not_a_template(spark):
    """A host of nothing but copies keeps its text; a text on all other pages too goes."""
    one = "<body><article><h1>Title</h1><p>The same long text on every page.</p></article></body>"
    rows = [(i, f"http://b.example/{i}", one) for i in range(8)]
    assert {r.text for r in _run(spark, rows)} == {"Title The same long text on every page."}
    rows += [(8 + i, f"http://b.example/{8 + i}", one.replace("same", f"{i}")) for i in range(8)]
    got = {r.page_id: r.text for r in _run(spark, rows)}
    assert got[0] == "The same long text on every page."


def test_fixed_notice_in_articles_goes(spark):
    rows = [
        (i, f"http://c.example/{i}",
         f"<article><h1>Title {i}</h1><p>Support us.</p><p>What page {i} says about its matter.</p></article>")
        for i in range(6)
    ]
    got = {r.page_id: r.text for r in _run(spark, rows)}
    assert got[2] == "Title 2 What page 2 says about its matter."


CASES = [
    ("<article><p><b>One<br>two<p>three &amp;lt; &copy; &#x41;&notit;</p></article>", "One two three &lt; © A¬it;"),
    ("<nav>m</nav><main><header><h1>H</h1></header><p>a<i>b</i> \n c</p><aside>s</aside></main><footer>f", "H ab c"),
    ("<header>site</header><article>x<section class='comments'><article>bad</article></section>y</article>", "x y"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form>q</form></article>", "a b c d"),
    ("<article>a<script>b</script><!-- c --><style>d</style><noscript>e</noscript>f</article>", "af"),
    ("<article>a<div class='post-ad'>b</div><div class=advice>c</div><div id='cookie-bar'>d</div></article>", "a c"),
    ("<article><p title='>x' class=\"lead\">a > b < c</p><pre>d\n  e</pre></article>", "a > b < c d e"),
    ("<body><div role=navigation>n</div>plain text<div><a href=x>l</a></div></body>", "plain text"),
    ("<article>a<!-- never closed", "a"),
    ("<article>a<script>never closed", "a"),
    ("<ARTICLE><P>a</P><BR/>b</ARTICLE>c", "a b"),
    ("<article>&nbsp;　a b&nbsp;</article>", "a b"),
    ("<article><p>a<", "a<"),
    ("</div></p></article>a</b><article>b</i></article>", "b"),
    ("", ""), (None, ""), ("no markup", "no markup"), ("   ", ""),
]


def test_single_pages(spark):
    rows = [(i, f"http://h{i}.example/", html) for i, (html, _) in enumerate(CASES)]
    got = {r.page_id: r.text for r in _run(spark, rows)}
    assert [got[i] for i in range(len(CASES))] == [text for _, text in CASES]


def test_awkward_rows(spark):
    one = "<article>x</article>"
    rows = [(None, None, one), (1, "not an address", one), (1, "not an address", one), (2, None, None)]
    rows += [(3, "http://d.example", "<article>" + "long <b>text</b> " * 60_000 + "</article>")]
    rows += [(4, "http://D.example:80/x?y", "<div>" * 30_000 + "deep" + "</section></div>" * 30_000)]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in _run(spark, rows)), key=repr)
    assert len(got) == len(rows)
    texts = {(r[0], r[1]): r[2] for r in got}
    assert texts[None, None] == texts[1, "not an address"] == "x" and texts[2, None] == ""
    assert texts[3, "http://d.example"] == ("long text " * 60_000).strip()
    assert texts[4, "http://D.example:80/x?y"] == "deep"
    assert _run(spark, []) == []


@pytest.mark.parametrize("broken", ["<a " * 100_000, '<a "' * 100_001, "<!--" * 100_000, "<i></b>" * 50_000, "<" * 200_000])
def test_broken_markup_takes_linear_time(broken):
    roles = pt._Roles()
    pt._parse(f"<p>{broken}", roles)
