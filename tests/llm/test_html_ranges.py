"""Pages dealt over ranges: hot rows, copies, and every page's nearest unlike pages, against plain Python."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

from clickloom.llm import html_diff, html_lines
from clickloom.llm.url_rules import host_of, path_of

SCHEMA = "page_id long, url string, html string"


def _reference(spark, rows):
    url = F.col("url")
    keys = spark.createDataFrame(rows, SCHEMA).select("*", host_of(url).alias("h"), path_of(url).alias("p")).collect()
    pages = []
    for r in keys:
        tie = "" if r["page_id"] is None else str(r["page_id"])
        _, content = html_diff._written(r["html"] or "")
        pages.append((r["h"], r["p"], tie, content, r["page_id"], r["url"], r["html"] or ""))
    pages.sort(key=lambda page: page[:4])
    made = Counter()
    for n, page in enumerate(pages):
        nearest = []
        for side in (reversed(pages[:n]), pages[n + 1 :]):
            other = next((x for x in side if x[3] != page[3]), None)
            if other is not None and other[0] == page[0]:
                nearest.append((len(os.path.commonprefix([page[1], other[1]])), other))
        pair = max(nearest, key=lambda found: found[0])[1] if nearest else None
        known = html_diff.keys_of(html_lines.lines(pair[6])) if pair else None
        found = html_diff.main_text(html_lines.lines(page[6]), known)
        made[page[4], page[5], found["text"], found["n_shared"]] += 1
    return made


def _found(spark, rows):
    found = html_diff.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return Counter((r["page_id"], r["url"], r["text"], r["n_shared"]) for r in found)


def _pages(draw, count):
    def page():
        return "".join(f"<p>{draw.choice('abcde')}{draw.randrange(3)}</p>" for _ in range(draw.randrange(5)))

    def url():
        return draw.choice(["http://a.b/", "http://a.b/x/", "http://c.d/", "no url "]) + str(draw.randrange(9))

    return [
        (draw.choice([None, draw.randrange(40)]), draw.choice([None, url(), url()]), draw.choice([None, page(), page(), page()]))
        for _ in range(count)
    ]


def test_nearest_pages_over_ranges(spark):
    draw = random.Random(7)
    for count in (3, 60, 400):
        rows = _pages(draw, count)
        rows += rows[: count // 3]
        assert _found(spark, rows) == _reference(spark, rows)


def test_copies_of_two_neighbouring_pages(spark):
    draw = random.Random(8)
    rows = _pages(draw, 120)
    rows += [(7, "http://a.b/x/5", "<p>a0</p><p>hot</p>")] * 150 + [(7, "http://a.b/x/51", "<p>a0</p><p>too</p>")] * 150
    rows += [(8, "http://a.b/x/52", "<p>a0</p><p>too</p>")] * 100
    draw.shuffle(rows)
    assert _found(spark, rows) == _reference(spark, rows)


def test_rows_alike_are_spread_and_guests_are_few(spark):
    rows = [(n, f"http://a.b/{n}", f"<p>menu</p><p>{n}</p>") for n in range(250)]
    rows += [(7, "http://a.b/7", "<p>menu</p><p>7</p>")] * 3_000
    made = html_diff.dealt(spark.createDataFrame(rows, SCHEMA).repartition(12))
    counted = made.groupBy("range").agg(F.count_if(~F.col("guest")).alias("own"), F.count_if("guest").alias("guests")).collect()
    assert sum(r["own"] for r in counted) == len(rows)
    assert len(counted) > 20
    assert max(r["own"] for r in counted) < len(rows) / 8
    assert max(r["guests"] for r in counted) <= 4
