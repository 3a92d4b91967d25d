"""Jaccard join against comparing every two sets."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickloom.llm import jaccard, queries
from clickloom.llm.components import components

SCHEMA = "doc_id long, text string, leaf long, component string, n_links int"


def _set(text, words=5):
    tokens = (text or "").lower().split()
    if not tokens:
        return frozenset()
    return frozenset(tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1)))


def _brute(docs, words=5):
    """class_id and n_links of each (doc_id, text), for ids without repeats."""
    sets = {doc_id: _set(text, words) for doc_id, text in docs}
    holders = defaultdict(list)
    for doc_id, found in sets.items():
        for gram in found or [None]:
            holders[gram].append(doc_id)
    parent = {doc_id: doc_id for doc_id in sets}
    links = Counter()

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc_id, found in sets.items():
        common = Counter(other for gram in found or [None] for other in holders[gram] if other > doc_id)
        for other, n in common.items():
            if not found or 9 * n >= 4 * (len(found) + len(sets[other])):
                links[doc_id] += 1
                links[other] += 1
                a, b = top(doc_id), top(other)
                parent[max(a, b)] = min(a, b)
    return {doc_id: (top(doc_id), links[doc_id]) for doc_id in sets}


def _found(frame):
    return {row["doc_id"]: (row["class_id"], row["n_links"]) for row in frame.collect()}


def _near_copies(n, edits, seed, length=60):
    pick = random.Random(seed)
    base = [f"w{pick.randrange(10_000)}" for _ in range(length)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(pick.randint(0, edits)):
            words[pick.randrange(length)] = f"x{pick.randrange(10_000)}"
        texts.append(" ".join(words))
    return texts


@pytest.fixture(scope="module")
def docs():
    pick = random.Random(1)
    texts = [None, "", "  \n", "one", "One", "a b c d e", "A B  C D e"]
    texts += _near_copies(40, 3, 2) + _near_copies(20, 1, 3, 12)
    passage = " ".join(f"p{n}" for n in range(55))
    texts += [f"{' '.join(f'u{pick.randrange(10**6)}' for _ in range(80))} {passage}" for _ in range(40)]
    texts += [" ".join(f"v{pick.randrange(10**6)}" for _ in range(50)) for _ in range(30)]
    texts += ["word " * 30_000, "word " * 20_000, " ".join(f"l{n}" for n in range(30_000))]
    return list(enumerate(texts))


@pytest.mark.parametrize(("limit", "block"), [(512, 512), (8, 7)])
def test_against_brute_force(spark, docs, monkeypatch, limit, block):
    # Small limits make buckets split and leaves fall into blocks.
    monkeypatch.setattr(jaccard, "LIMIT", limit)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    frame = spark.createDataFrame([(n, text, 0, "x", 0) for n, text in docs], SCHEMA).repartition(4)
    assert _found(jaccard.classes(frame)) == _brute(docs)


def test_query_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert _found(queries.op10_jaccard(spark, sf_dir)) == _brute([(r["doc_id"], r["text"]) for r in rows])


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (1, "other words here"), (None, None), (7, None)]
    frame = spark.createDataFrame([(*row, 0, "x", 0) for row in rows], SCHEMA)
    found = sorted(
        ((r["doc_id"], r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard.classes(frame).collect()), key=str
    )
    assert found == sorted(
        [(1, None, 3, 2), (1, None, 3, 2), (None, None, 3, 2), (1, 1, 1, 0), (None, None, 2, 1), (7, None, 2, 1)],
        key=str,
    )
    kept = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(frame).collect()]
    assert sorted(kept, key=str) == sorted([(None, "a b c d e f"), (1, "other words here"), (None, None)], key=str)
    assert jaccard.one_of_each(frame).columns == frame.columns


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert jaccard.classes(frame).collect() == []
    assert jaccard.one_of_each(frame).collect() == []


def test_recall_asked_for_sets_the_runs():
    assert jaccard.runs_for(0.8, 0.9) < jaccard.runs_for(0.8, 0.9999)
    assert jaccard.runs_for(0.8, 0.9999) == 8


def test_intersections():
    pick = np.random.default_rng(0)
    sets = [np.unique(pick.integers(0, 9000, n).astype(np.uint64)) for n in (1, 50, 6000, 8000, 0)]
    found = jaccard.intersections(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert found[i, j] == len(np.intersect1d(a, b))


def test_components_of_paths_and_cycles(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 300), (200, 300)]
    random.Random(2).shuffle(edges)
    frame = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in edges], "a long, b long")
    found = {row["node"]: row["component"] for row in components(frame).collect()}
    assert found == dict.fromkeys(range(41), 0) | dict.fromkeys((100, 101, 102), 100) | {200: 200, 300: 200}
    assert components(frame.limit(0)).collect() == []


def test_a_third_of_all_rows_alike(spark, monkeypatch):
    base = " ".join(f"w{n}" for n in range(60))
    rows = [(7, base, n % 5, "x") for n in range(3000)] + [(8, base + " more", 1, "x"), (9, base, 2, "y")]
    rows += [(100 + n, " ".join(f"v{n}x{k}" for k in range(30)), 0, "z") for n in range(3000)]
    schema = "doc_id long, text string, n int, __id string"
    docs = spark.createDataFrame(rows, schema).repartition(6)
    groups = []
    given = jaccard._with_grams

    def seen(*args):
        made = given(*args)
        groups.append(made.groupBy("leaf", "i", "j", "digest").count().agg({"count": "max"}).first()[0])
        return made

    monkeypatch.setattr(jaccard, "_with_grams", seen)
    found = {(r["doc_id"], r["class_id"], r["n_copies"], r["n_links"]) for r in jaccard.classes(docs).collect()}
    assert groups[0] <= 6
    assert found >= {(7, 7, 3001, 3001), (9, 7, 3001, 3001), (8, 7, 1, 3001), (100, 100, 1, 0)}
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    first = sorted(map(tuple, kept.collect()))
    assert len(first) == 3001 and first[0][:2] == (7, base)
    assert sorted(map(tuple, jaccard.one_of_each(docs.repartition(3)).collect())) == first
