"""Packing: every piece once, nothing overlaps, few sequences."""

import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickloom.llm import bpe, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _used(steps):
    used = Counter()
    for times, lengths in steps:
        assert times > 0
        for length in lengths:
            used[length] += times
    return used


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 1000), max_size=32))
def test_plan_uses_every_piece_once(counts):
    steps = packing.plan(counts, 32)
    assert _used(steps) == Counter(counts)
    assert all(sum(lengths) <= 32 for _, lengths in steps)


@pytest.mark.parametrize(
    ("counts", "sequences"),
    [
        ({10: 4}, 4),
        ({7: 5, 3: 5}, 5),
        ({5: 2, 3: 2, 2: 2}, 2),
        ({4: 3, 3: 3, 2: 3, 1: 3}, 3),
        ({6: 1, 5: 1}, 2),
        ({}, 0),
    ],
)
def test_exact_complements(counts, sequences):
    assert sum(times for times, _ in packing.plan(counts, 10)) == sequences


def test_plan_is_small_and_near_the_bound_at_any_size():
    drawn = np.random.default_rng(3).integers(1, 2048, 4000)
    counts = Counter(drawn.tolist())
    small = packing.plan(counts)
    large = packing.plan({length: n * 1_000_000 for length, n in counts.items()})
    assert len(large) < 3 * len(counts)
    for steps, factor in ((small, 1), (large, 1_000_000)):
        bound = math.ceil(factor * drawn.sum() / 2048)
        assert sum(times for times, _ in steps) <= 1.01 * bound + 1


def _check(rows, capacity=2048):
    by_sequence = defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    rows = [row.asDict() for row in queries.op4_packing(spark, sf_dir).collect()]
    sequences = _check(rows)
    total = 0
    pieces = defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(pieces) == len(docs)
    for doc in docs:
        ids = np.array([*library.encode(doc["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        own = sorted(pieces[doc["doc_id"]], key=lambda row: row["piece"])
        assert [row["piece"] for row in own] == list(range(-(-len(ids) // 2048)))
        start = 0
        for row in own:
            assert row["start"] == start
            assert row["ids_crc32"] == zlib.crc32(ids[start : start + row["length"]].tobytes())
            start += row["length"]
        assert start == len(ids)
        assert all(row["length"] == 2048 for row in own[1:])
    assert sequences <= 1.02 * math.ceil(total / 2048) + 1


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, 9), (1, None, 9), (None, "", 9), (4, "word " * 9000, 9), (4, "word " * 9000, 9)],
        "doc_id long, text string, length int",
    )
    made = packing.pieces(docs, PATH, keep_ids=True)
    rows = [row.asDict() for row in packing.pack(made).collect()]
    assert sum(row["length"] for row in rows) == sum(len(row["ids"]) for row in rows)
    assert Counter(row["doc_id"] for row in rows if row["length"] == 1)[1] == 2
    _check(rows)
    assert packing.pack(packing.pieces(docs.limit(0), PATH)).collect() == []
    assert packing.pieces(docs.filter("text is null"), PATH, end=None).count() == 0


def test_small_capacity_with_many_equal_pieces(spark):
    made = spark.range(3000).selectExpr(
        "id as doc_id", "0 as piece", "0L as start", "3L as length", "7L as ids_crc32"
    )
    rows = [row.asDict() for row in packing.pack(made, capacity=10).collect()]
    assert len(rows) == 3000
    assert _check(rows, 10) == 1000


@pytest.mark.parametrize("space", [" ", "\n", "\t", " \n", "\u3000", "\x1c"])
def test_long_white_space_has_the_librarys_ids(space):
    library = Tokenizer.from_file(PATH)
    for before, after in (("a", "b"), ("", ""), ("x ", " y"), ("q", "\n"), ("<|endoftext|>", "<|endoftext|>")):
        for n in (packing.LONG_RUN - 1, packing.LONG_RUN, packing.LONG_RUN + 1, 30_000):
            text = before + (space * n)[:n] + after
            assert packing.token_ids(text, PATH).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("space", [" ", "\n", "\t"])
def test_two_million_blanks_do_not_stop_a_job(spark, space):
    text = "a" + space * 2_000_000 + "b"
    started = time.monotonic()
    ids = packing.token_ids(text, PATH)
    assert time.monotonic() - started < 30
    assert ids.tolist() == bpe.encoder(PATH).encode(text)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert sum(row["length"] for row in packing.pack(packing.pieces(docs, PATH)).collect()) == len(ids) + 1
