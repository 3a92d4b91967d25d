"""Main text: the article of every page, and differencing itself."""

import html
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import html_diff, html_lines, queries

SF = "/root/testdata/sf0.01"


def _article(page):
    inside = re.search("<article>(.*)</article>", page or "", re.DOTALL)
    blocks = re.split(r"</?(?:p|h1|br)\b[^>]*>", inside[1]) if inside else []
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
    return " ".join(filter(None, texts))


def test_query_gives_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op1_html_diff(spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for row in rows:
        assert row["url"] == pages[row["page_id"]]["url"]
        assert row["text"] == _article(pages[row["page_id"]]["html"])
        assert row["n_chars"] == len(row["text"])
    counts = html_diff.extract(spark.read.parquet(f"{SF}/pages.parquet")).agg({"n_shared": "sum", "n_marked": "sum"})
    shared, marked = counts.select("sum(n_shared)", "sum(n_marked)").first()
    assert shared > 10 * marked


def test_plain_pages_by_differencing_alone(spark):
    def page(body):
        return f"<html><body><div>Site name</div><div>Home</div><div>{body}</div><div>Imprint</div></body></html>"

    rows = [(1, "http://a.b/x/1", page("One<br>same &amp; same")), (2, "http://a.b/x/2", page("Two")), (3, "http://c.d/x/3", page("Three"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_diff.extract(pages).collect()}
    assert found == {1: "One same & same", 2: "Two", 3: "Site name Home Three Imprint"}


def test_the_nearest_path_is_the_pair(spark):
    rows = [
        (1, "http://a.b/news/1", "<p>News menu</p><p>a</p>"),
        (2, "http://a.b/news/2", "<p>News menu</p><p>b</p>"),
        (3, "http://a.b/shop/1", "<p>Shop menu</p><p>a</p>"),
        (4, "http://a.b/shop/2", "<p>Shop menu</p><p>b</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_diff.extract(pages).collect()}
    assert found == {1: "a", 2: "b", 3: "a", 4: "b"}


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (2, "no url", "", "x"), (None, "http://a/b", "text", "x"), (4, "http://a/b", "<p>same</p>", "x"), (4, "http://a/b", "<p>same</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in html_diff.extract(pages).collect()]
    # Repeated rows are never each other's pair.
    assert sorted(found, key=str) == sorted([(1, "", 0), (2, "", 0), (None, "text", 4), (4, "same", 4), (4, "same", 4)], key=str)
    assert html_diff.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article>A<b>B</b> c</article>", "AB c"),
        ("<article><p>a\n b<p>c&nbsp;d &lt;e&gt; &#233;</article>", "a b c d <e> é"),
        ("<nav>m</nav><article>a<aside>s</aside><form>f</form><footer>x</footer>b</article><footer>y</footer>", "a b"),
        ("<header>h</header><main><h1>T</h1><p>a</p><div class='ad x'>buy</div></main>", "T a"),
        ("<article>a<div class=comments><p>c<div>d</div></div>z</article>", "a z"),
        ("<article>a</article><section id='comments'><article class=comment>c</article></section>", "a"),
        ("<script>var a='<article>no</article>';</script><style>p{}</style><article>a<!-- <p>b</p> --></article>", "a"),
        ("<body class='has-sidebar'><form><article>a</article></form><div class='cookie-notice'>ok</div>", "a"),
        ("<article>1 < 2 and <3 a</article>", "1 < 2 and <3 a"),
        ("<article title='a>b' data=\"x'>y\">t</article>", "t"),
        ("<head><title>t</title></head><body><article>a", "a"),
        ("<article><p class='ad'>x<p>y</article>", "y"),
        ("<article>a<script>never closed", "a"),
        ("", ""),
    ],
)
def test_one_page(page, text):
    assert html_diff.main_text(html_lines.lines(page), None)["text"] == text


def _longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=20))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    found = sorted(html_diff.shared(a, b))
    assert len(found) == _longest(a, b)
    rest = iter(b)
    assert all(a[n] in rest for n in found)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("<>/!-ap \"'=&;x\n"), max_size=60))
def test_any_markup_ends(page):
    assert all(line.text == " ".join(line.text.split()) != "" for line in html_lines.lines(page))


def _longest(one, other):
    row = [0] * (len(other) + 1)
    for x in one:
        before = row
        row = [0]
        for j, y in enumerate(other):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_alignment_is_longest():
    draw = random.Random(1)
    for _ in range(500):
        one = [draw.randrange(5) for _ in range(draw.randrange(30))]
        other = [draw.randrange(6) for _ in range(draw.randrange(30))]
        found = sorted(html_diff.shared(one, other))
        assert len(found) == _longest(one, other)
        rest = iter(other)
        assert all(one[n] in rest for n in found)


def test_thousands_of_equal_lines_and_deep_nesting_take_seconds():
    started = time.monotonic()
    assert len(html_diff.shared([1] * 20_000, [1] * 20_000)) == 20_000
    assert len(html_diff.shared([1, 2] * 10_000, [2, 2, 1] * 10_000)) >= 10_000
    assert [line.text for line in html_lines.lines("<div>" * 50_000 + "x" + "</div>" * 50_000)] == ["x"]
    html_lines.lines("<div>" * 50_000 + "x" + "</span>" * 50_000)
    html_lines.lines("<p><button>a" * 50_000)
    assert time.monotonic() - started < 20


def test_elements_without_an_end_tag():
    def texts(page):
        return [line.text for line in html_lines.lines(page)]

    assert texts("<button>go<article><p>The story</p></article>") == ["The story"]
    assert texts("<div><video src=x>no video</div><p>after</p>") == ["after"]
    assert texts("<object>a<object>b</object>c<p>d") == ["c", "d"]
    assert texts("<p>before<script>var x = '<p>no</p>'") == ["before"]
