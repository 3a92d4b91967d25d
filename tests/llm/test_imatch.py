"""Fingerprints of odd rows, likeness, and each row beside the next."""

from collections import Counter

from clickloom.llm import imatch, neighbours


def test_fingerprints_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "alpha beta", "x"), (3, "alpha beta", "x"), (None, "Alpha, beta!", "x")]
    rows += [(n, f"filler{n}", "x") for n in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, term string")
    found = {}
    for row in imatch.fingerprints(docs).collect():
        found.setdefault(row["doc_id"], []).append(row["fingerprint"])
    assert found[1] == found[2] and found[1][0].startswith("text:")
    assert found[3] == found[3][:1] * 2 == found[None] * 2
    assert len({f for fs in found.values() for f in fs}) == 52
    assert imatch.fingerprints(docs.limit(0)).collect() == []


def test_likeness():
    assert imatch.likeness("text:0", "text:1") == 0
    assert imatch.likeness("0|a.b.|a..", "0|a.c.|a..") == 2 / 3
    assert imatch.likeness("0|a|a", "5|a|a") == 0
    assert imatch.likeness("0|a|b", "1|b|") == 1


def test_next_row_over_any_ranges(spark, monkeypatch):
    rows = [(n * 3, f"text {n}") for n in range(200)] + [(30, "again"), (30, "again"), (None, "null"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def pair(row, following):
        return {k: row[k] for k in ("doc_id", "text", "guest")} | {"following": following}

    schema = "doc_id long, text string, guest boolean, following string"
    for count in (1, 3):
        monkeypatch.setattr(neighbours, "RANGES", count)
        made, n = neighbours.with_next(docs, pair, schema)
        found = [r for r in made.collect() if not r["guest"]]
        assert n == len(found) == len(rows)
        # A single cycle through all texts, by descending id.
        texts = Counter(r["text"] for r in found)
        assert texts == Counter(r["following"] for r in found) == Counter(t or "" for _, t in rows)
        by_text = {r["text"]: r["following"] for r in found if r["text"].startswith("text")}
        assert all(by_text[f"text {n}"] == f"text {n - 1}" for n in range(1, 200) if n not in (10, 11))
        assert sum(r["text"] == r["following"] == "again" for r in found) == 1
    single, _ = neighbours.with_next(docs.filter("doc_id = 0"), pair, schema)
    assert [(r["text"], r["following"]) for r in single.collect() if not r["guest"]] == [("text 0", "text 0")]
    assert neighbours.with_next(docs.limit(0), pair, schema)[0].collect() == []
