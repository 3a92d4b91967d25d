"""Spelling variants against plain Python: all words, all edits, one dictionary."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import queries, spelling

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALPHABET = [chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100))]


def _vocabulary(rows, damage=97):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if damage and h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def _expected(words):
    found = {}
    for word, n in words.items():
        edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
        edits |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in ALPHABET}
        edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in ALPHABET}
        near = sorted((edits - {word}) & words.keys(), key=lambda w: (-words[w], w))
        form = near[0] if near and words[near[0]] >= 2 * n else None
        found[word] = (form, n, len(near), words[form] if form else None)
    def root(word):
        while found[word][0]:
            word = found[word][0]
        return word
    return {word: (form, root(word), n, near, form_n) for word, (form, n, near, form_n) in found.items()}


def _rows(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = _expected(_vocabulary(docs))
    assert _rows(queries.op11_spelling(spark, SF)) == expected
    assert any(form for form, *_ in expected.values())


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 3000])
def test_random_words_in_one_round_and_in_many(spark, filter_bytes):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcÀÿ"), int(rng.integers(4, 8)))) for _ in range(3000)]
    docs = [(i, " ".join(words[i::40])) for i in range(40)]
    assert _rows(spelling.variants(_docs(spark, docs), filter_bytes=filter_bytes)) == _expected(_vocabulary(docs))


def test_chains_of_forms_and_ties(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "zzzzz": 6, "zzzzy": 12, "zzzzx": 12}
    docs = [(1, " ".join(word for word, n in counts.items() for _ in range(n)))]
    found = _rows(spelling.variants(_docs(spark, docs), damage=None))
    assert found == _expected(_vocabulary(docs, None))
    assert found["aaaaa"][:2] == ("aaaab", "bbbbb")
    assert found["zzzzz"][0] == "zzzzx"


def test_long_words_nulls_copies_and_other_columns(spark):
    long = "ab" * 100
    rows = [(1, f"{long} {long} {long[:-1]} {long[:-1]} x{long[1:]}", 1), (2, None, 2), (None, "Hello HELLO hellO Éllos", 3)]
    rows += [(3, f"{long} {long[:-1]} x{long[1:]} {'y' * 70} {'y' * 69} Éllos ellos", 4)] * 3 + [(4, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    plain = [(key, text) for key, text, _ in rows]
    found = _rows(spelling.variants(docs, damage=None))
    assert found == _expected(_vocabulary(plain, None))
    assert found["y" * 70][2:4] == (3, 1)
    assert _rows(spelling.variants(docs)) == _expected(_vocabulary(plain))


def test_a_word_of_ten_thousand_letters(spark):
    long = "ab" * 5000
    docs = [(1, f"{long} {long} {long} {long[:-1]} {long[:-1]} {long[:-1]} x{long[1:]} x{long[1:]} x{long[1:]} {long[:-2]}")]
    found = _rows(spelling.variants(_docs(spark, docs), damage=None))
    assert {word: row[2:4] for word, row in found.items()} == {long: (3, 2), long[:-1]: (3, 1), f"x{long[1:]}": (3, 1)}


def test_no_words(spark):
    assert spelling.variants(_docs(spark, [])).collect() == []
    assert spelling.variants(_docs(spark, [(1, "a bc 1234567 ..."), (2, None)])).collect() == []


def test_filters_know_every_word_and_little_else():
    rng = np.random.default_rng(1)
    words = sorted({"".join(map(chr, rng.choice(spelling.LETTERS, 8))) for _ in range(20_000)})
    known, others = words[::2], words[1::2]
    filters = spelling.Filters({8: len(known)})
    array = np.zeros(filters.total, np.uint64)
    def looked_up(some):
        return filters.slots(spelling._codes(some) @ spelling._powers(8), 8)[1:]
    block, bits = looked_up(known)
    np.bitwise_or.at(array, block, bits)
    assert (array[block] & bits == bits).all()
    block, bits = looked_up(others)
    assert (array[block] & bits == bits).mean() < 0.005


def test_a_text_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RUNS", 50)
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcd"), 5)) for _ in range(2000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:300]))]
    found = {r["word"]: r["n"] for r in spelling.counted(_docs(spark, docs)).filter("n >= 3 AND length(word) >= 5").collect()}
    assert found == _vocabulary(docs)
