"""Mixture packing against the round robin itself, token by token, and against the tokenizers library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import mixture, queries
from clickloom.llm.mixture import PARTS, Schedule

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def _round_robin(counts, shares, window):
    """(queue, token) in the order sent: every queue in turn, window after window, deficits carried."""
    left, sent, deficit, out = list(counts), [0] * len(counts), [0] * len(counts), []
    while any(left):
        weights = [(n if shares is None else shares[q]) if n else 0 for q, n in enumerate(left)]
        parts = mixture._parts(np.array(weights if any(weights) else left, float)).tolist()
        dry = False
        while not dry:
            for q, part in enumerate(parts):
                if part:
                    deficit[q] += window * part
                    n = min(left[q], deficit[q] // PARTS)
                    deficit[q] -= n * PARTS
                    out += [(q, sent[q] + i) for i in range(n)]
                    sent[q] += n
                    left[q] -= n
                    dry = dry or not left[q]
    return out


@pytest.mark.parametrize("seed", range(40))
def test_places_are_those_of_the_round_robin(seed):
    rng = np.random.default_rng(seed)
    queues = int(rng.integers(1, 7))
    counts = rng.integers(0, 400, queues).tolist()
    shares = None if seed % 2 else rng.integers(0, 5, queues).astype(float).tolist()
    capacity = int(rng.choice([4, 16, 1024]))
    window = capacity * int(rng.choice([1, 4]))
    rows = []
    for q, n in enumerate(counts):
        at = 0
        while at < n:
            length = min(int(rng.integers(1, 60)), n - at)
            rows.append((q, at, length))
            at += length
    rng.shuffle(rows)
    queue, at, length = (np.array([row[i] for row in rows], np.int64) for i in range(3))
    found = Schedule.of(counts, shares, capacity, window).places(queue, at, length)
    got = {}
    for row, skipped, n, sequence, offset in zip(*(found[x].tolist() for x in found), strict=True):
        for i in range(n):
            assert (sequence, offset + i) not in got
            got[sequence, offset + i] = rows[row][0], rows[row][1] + skipped + i
    assert [got[place] for place in sorted(got)] == _round_robin(counts, shares, window)
    for n in Counter(sequence for sequence, _ in got).values():
        assert n == capacity or n & (n - 1) == 0


def test_any_size_is_exact():
    counts = [2**44, 2**43 + 7, 5, 2**30]
    schedule = Schedule.of(counts)
    assert schedule.sent[-1].tolist() == counts
    last = schedule.places(np.array([0]), np.array([2**44 - 1]), np.array([1]))
    assert last["length"].tolist() == [1]
    with pytest.raises(ValueError):
        Schedule.of([mixture.MOST])


def _ids(rows):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return {key: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0] for key, text in rows}


def _check(rows, ids, capacity=1024):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        own = ids[row["doc_id"]]
        part = np.array(own[row["start"] : row["start"] + row["length"]], "<u4")
        assert row["doc_tokens"] == len(own) and row["length"] == len(part) > 0
        assert row["ids_crc32"] == zlib.crc32(part.tobytes())
        pieces[row["doc_id"]].append((row["start"], row["length"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert pieces.keys() == ids.keys()
    for parts, size in [(p, len(ids[key])) for key, p in pieces.items()] + [(s, None) for s in sequences.values()]:
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end = start + length
        assert end == size if size is not None else end == capacity or end & (end - 1) == 0 and end < capacity


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = queries.op13_mixture(spark, SF).collect()
    _check(rows, _ids([(r["doc_id"], r["text"]) for r in docs]))


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def _shares(rows, window):
    """Tokens of each source in each window of the stream."""
    found = defaultdict(Counter)
    for row in rows:
        place = row["sequence_id"] * 64 + row["offset"]
        for i in range(row["length"]):
            found[(place + i) // window][row["source"]] += 1
    return found


def test_windows_hold_the_proportions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "word " * int(rng.integers(1, 60)), "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    docs = _docs(spark, rows).repartition(7)
    found = mixture.pack(docs, PATH, capacity=64, window=512).collect()
    _check(found, _ids([row[:2] for row in rows]), 64)
    total = Counter()
    for row in found:
        total[row["source"]] += row["length"]
    windows = _shares(found, 512)
    everything = sum(total.values())
    for number in range(everything // 512 - 1):
        for source, n in total.items():
            assert abs(windows[number][source] - 512 * n / everything) <= 2 * len(total) + 1


def test_targets_hold_until_a_source_runs_dry(spark):
    rows = [(i, "word " * 20, "ab"[i % 2]) for i in range(400)] + [(i, "word " * 20, None) for i in range(400, 450)]
    found = mixture.pack(_docs(spark, rows), PATH, targets={"a": 0.75, "b": 0.25}, capacity=64, window=512).collect()
    _check(found, _ids([row[:2] for row in rows]), 64)
    windows = _shares(found, 512)
    a_tokens = sum(r["length"] for r in found if r["source"] == "a")
    for number in range(int(a_tokens / 0.75 / 512) - 1):
        assert abs(windows[number]["a"] - 384) <= 5 and windows[number][None] == 0
    with pytest.raises(ValueError):
        mixture.pack(_docs(spark, rows), PATH, targets={"a": -1}).collect()


def test_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(mixture, "QUEUES", 4)
    rows = [(i, "word " * (i % 30), f"s{i % 11}") for i in range(330)]
    found = mixture.pack(_docs(spark, rows).repartition(5), PATH, capacity=64, window=256).collect()
    _check(found, _ids([row[:2] for row in rows]), 64)


def test_nulls_copies_long_texts_and_other_columns(spark, monkeypatch):
    monkeypatch.setattr(mixture, "IDS", 100)
    rows = [(1, None, "a"), (2, "", None), (3, "one two " * 5000, "a"), (None, "null id", "b")]
    docs = _docs(spark, rows).withColumns({name: F.lit(1) for name in ("part", "queue", "length", "before", "at", "ids")})
    found = mixture.pack(docs, PATH, keep_ids=True).collect()
    _check(found, _ids([row[:2] for row in rows]))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    twice = mixture.pack(_docs(spark, [(7, "the same row", "a")] * 300), PATH).collect()
    assert sum(r["length"] for r in twice) == 300 * len(_ids([(7, "the same row")])[7])


def test_nothing_to_pack(spark):
    assert mixture.pack(_docs(spark, []), PATH).collect() == []
    assert mixture.pack(_docs(spark, [(1, None, "a"), (2, "", "b")]), PATH, end=None).collect() == []
