"""The pair of a page among exact copies."""

import pytest

from clickloom.llm import html_diff


@pytest.mark.parametrize("ranges", [1, 40])
def test_copies_are_passed_over(spark, monkeypatch, ranges):
    monkeypatch.setattr(html_diff, "RANGES", ranges)
    body = ["One", *["Two"] * 9, "Three"]
    rows = [(n, f"http://a.b/x/{n:02}", f"<div>Menu</div><div>{b}</div>") for n, b in enumerate(body)]
    rows += [(50 + n, f"http://c.d/x/{n}", "<div>Menu</div><div>Only</div>") for n in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_diff.extract(pages).collect()}
    assert found == dict(enumerate(body)) | {50 + n: "Menu Only" for n in range(3)}
