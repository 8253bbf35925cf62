"""Main texts against hand cases and a plain reading of the generated pages."""

import html
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimweave.llm import wrapper

SCHEMA = "page_id long, url string, html string"
SF_DIR = "/root/testdata/sf0.01"


def texts(spark, tables, rows, schema=SCHEMA):
    folder = tables(pages=(rows, schema))
    return {r.page_id: r.text for r in wrapper.op9_html_extraction(spark, folder).collect()}


def test_generated_pages(spark):
    def article(page):
        inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        return "\n\n".join(b for b in blocks if b)

    found = {r.page_id: r for r in wrapper.op9_html_extraction(spark, SF_DIR).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_DIR}/pages.parquet'").fetchall()
    assert len(found) == len(pages)
    for page, url, source in pages:
        assert (found[page].url, found[page].text) == (url, article(source))
        assert found[page].n_chars == len(found[page].text)


def test_parts_that_are_no_article(spark, tables):
    page = (
        "<!doctype html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>"
        "<div id='cookie-notice'>We use cookies</div><nav><ul><li><a href=/>Home</a></ul></nav><article class=post>"
        "<h1>Head &amp; line</h1><p>One&nbsp;two<br>three <i>fo</i>ur<p>Five<aside>no</aside><form><input><p>no</form>"
        "<div class='share-buttons'>no</div><script>if (a < b) '<p>no</p>'</script><ul><li>six<li>seven</ul>"
        "<table><tr><td>eight<td>nine</table><!-- <p>no --><section class=comments><p>no</section></article>"
        "<div class='sidebar widget'><p>no</div><div role=complementary>no</div><footer>no</footer></body></html>"
    )
    want = "\n\n".join(["Head & line", "One two three four", "Five", "six", "seven", "eight", "nine"])
    assert texts(spark, tables, [(1, "http://a/1", page)]) == {1: want}


def test_constant_blocks_are_template_where_no_article_is_marked(spark, tables):
    page = "<body><div class=top>Welcome to the site</div><div class=x><p>Text number {0} of many</p><p>and more {0}</p></div><div class=end>All rights</div>"
    rows = [(i, f"http://same.example/{i}", page.format(i)) for i in range(6)]
    rows.append((9, "http://other.example/", page.format(9)))  # nothing to compare with
    found = texts(spark, tables, rows)
    assert found[3] == "Text number 3 of many\n\nand more 3"
    assert found[9] == "Welcome to the site\n\nText number 9 of many\n\nand more 9\n\nAll rights"


def test_copies_keep_their_article(spark, tables):
    page = "<body><nav>m</nav><article><p>The same text</article><footer>f</footer>"
    found = texts(spark, tables, [(i, f"http://a/{i}", page) for i in range(20)])
    assert set(found.values()) == {"The same text"}


@pytest.mark.parametrize(
    "page",
    [
        "<article class='post no-sidebar'><p>Kept</article>", "<main class='with-sidebar'><p>Kept</main>",
        "<div class='layout has-sidebar'><article><p>Kept</article></div>", "<article class=sponsored><p>Kept</article>",
        "<form id=all><article><p>Kept<section class=comments><article class=comment>no</article></section></article></form>",
        "<article><div style='overflow:hidden'><p>Kept</div></article>", "<article aria-hidden='false'><p>Kept</article>",
        "<main><div data-role='banner'><p>Kept</div></main>", "<main><div class=widget-area><article><p>Kept</article></div></main>",
        "<article><p>Kept</article><div class='related'><article><p>no</article></div>", "<article title='a hidden one'><p>Kept</article>",
    ],
)
def test_marks_of_asides_do_not_hide_an_article(spark, tables, page):
    chrome = "<body><div class=top>Welcome</div>{}<div class=site-footer>no</div><p hidden>no"
    assert texts(spark, tables, [(1, "http://a/1", chrome.format(page))]) == {1: "Kept"}


def test_several_fixed_blocks_of_one_node_are_template(spark, tables):
    page = "<body><div class=x><p>Text {0}<p>more {0}<p>Follow us</div><div class=end><p>All rights<p>Imprint</div><ul><li>One<li>Two</ul>"
    rows = [(i, f"http://a/{i}", page.format(i)) for i in range(8)]
    rows += [(100 + i, f"http://b/{i}", page.format(1)) for i in range(8)]  # copies: one page
    found = texts(spark, tables, rows)
    assert all(found[i] == f"Text {i}\n\nmore {i}" for i in range(8))
    assert found[100].startswith("Text 1\n\nmore 1")


def test_constant_blocks_inside_an_article_are_template(spark, tables):
    page = "<body><{1}><h1>Head {0}</h1><p>Text {0}<p>Get our letter<div class=y><p>Follow us</div></{1}>"
    rows = [(i, f"http://{m}/{i}", page.format(i, m)) for m, k in (("article", 0), ("main", 10)) for i in range(k, k + 8)]
    rows += [(100 + i, "http://article/", page.format(3, "article")) for i in range(60)]  # copies of one page
    found = texts(spark, tables, rows)
    assert all(found[i] == f"Head {i}\n\nText {i}" for i in [*range(8), *range(10, 18)])
    assert found[100] == "Head 3\n\nText 3"


def test_shapes_of_a_host_are_aligned_in_chunks(spark, tables, folder, monkeypatch):
    names = ["".join(chr(97 + int(d)) for d in str(i)) for i in range(60)]
    page = "<body><div class=top>Welcome</div><div class=u{1}><p>Text {0}</div><div class=x><p>More {0}<p>Follow us</div>"
    rows = [(i, None, page.format(i, names[i])) for i in range(60)]
    monkeypatch.setattr(wrapper, "CHUNK", 8)
    wrapper.main_texts(spark.createDataFrame(rows, SCHEMA), folder).collect()
    tasks = spark.read.parquet(f"{folder}/merged-0").where("skeleton is null").groupBy("chunk").count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 30
    assert spark.read.parquet(f"{folder}/merged-1").where("skeleton is not null").count() == 1
    assert texts(spark, tables, rows) == {i: f"Text {i}\n\nMore {i}" for i in range(60)}


def test_odd_pages(spark, tables):
    long = "<article>" + "<p>word &lt; " * 20_000
    rows = [
        (1, "http://a/", None, 5), (2, None, "", 5), (3, "no host", "plain text &amp; no tags", 5), (4, "http://a/", "<article><p>cut <b", 5),
        (5, "http://b/", long, 5), (6, "http://a/", "<p>" + "<div>" * 3000 + "deep", 5), (7, "http://a/", "<article>a < b <3 c</article>", 5),
        (8, "HTTP://User@A.example:80/x", "<main><p title=\"x>y\" class='q'>z<p>it's <a href=it's>x</a></main>", 5), (8, "http://a/", None, 5),
    ]
    folder = tables(pages=(rows, f"{SCHEMA}, n_chars int"))
    found = wrapper.op9_html_extraction(spark, folder).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r.text for r in found if r.page_id != 8}
    assert by_id == {
        1: "", 2: "", 3: "plain text & no tags", 4: "cut", 5: "\n\n".join(["word <"] * 20_000), 6: "deep", 7: "a < b <3 c",
    }
    assert sorted(r.text for r in found if r.page_id == 8) == ["", "z\n\nit's x"]


def test_no_pages(spark, tables):
    assert texts(spark, tables, []) == {}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='a'", ">", "<", "</div>", "x", "&amp;", "<!--", "-->", "<li>", "</ul>", '"', "<script>", "</script>", " "]), max_size=30).map("".join))
def test_any_string_can_be_read(page):
    skeleton, blocks = wrapper.parse(page)
    tree = wrapper.tree_of(skeleton)
    count = skeleton.count("(") + 1
    assert tree.at == 0 and all(0 <= node < count and text for node, text, _ in blocks)


@pytest.mark.parametrize(
    "a, b, size",
    [("r ( x ) ( y )", "r ( x ) ( y )", 3), ("r ( x ) ( y )", "r ( y ) ( x )", 2), ("r ( x ( z ) )", "r ( w ) ( x ( z ) )", 3), ("r", "s", 0)],
)
def test_simple_tree_matching(a, b, size):
    found, pairs = wrapper.simple_tree_matching(wrapper.tree_of(a), wrapper.tree_of(b))
    assert found == size == len(pairs)
    assert all(x.label == y.label for x, y in pairs)
