"""Fingerprints against looking up every term of every text, with nothing sampled before the band is known."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from clickloom.llm import imatch, queries

SF = "/root/testdata/sf0.001"


def _fingerprint(band, text_hash):
    """Every term in the band in its lexicon of two levels, each lexicon's terms hashed in order."""
    if not band:
        return f"text:{text_hash % 2**64:016x}"
    level = 0
    while len(band) > 2 * 16 << level:
        level += 1
    written = [str(level)]
    for lexicons in (8 << level, 16 << level):
        parts = [sorted(t for t in band if t % lexicons == n) for n in range(lexicons)]
        assert sum(map(len, parts)) == len(band)
        written.append(".".join(xxhash.xxh32_hexdigest(b"".join(t.to_bytes(8, "big") for t in part))[:6] if part else "" for part in parts))
    return "|".join(written)


def _reference(texts):
    """Fingerprint function by the lexicon of ``texts``."""
    counts = Counter(term for text in texts for term in imatch.terms(text).tolist())
    most = max(0.1 * len(texts), 2)

    def of(text):
        band = [t for t in imatch.terms(text).tolist() if 2 <= counts[t] <= most]
        return _fingerprint(band, imatch.text_hash(text))

    return of, counts


@pytest.mark.parametrize("held", [1_000_000, 0])
def test_query_against_all_terms(spark, monkeypatch, held):
    monkeypatch.setattr(imatch, "HELD", held)
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    order = sorted(docs, reverse=True)
    of, counts = _reference(list(docs.values()))
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    rows = queries.op6_imatch(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for row in rows:
        text, following = docs[row["doc_id"]], docs[after[row["doc_id"]]]
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        assert row["fingerprint"] == of(text)
        assert row["edited_fingerprint"] == of(changed)
        assert row["near_edited"] == imatch.likeness(of(text), of(changed))
        assert row["near_next"] == imatch.likeness(of(text), of(following))
        band = [t for t in imatch.terms(text).tolist() if 2 <= counts[t] <= 0.1 * len(docs)]
        assert row["fingerprint"].startswith("text:") == (not band)
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
    near = [r["near_edited"] for r in rows]
    assert sum(near) / len(near) > 0.2 > 0.05 > sum(r["near_next"] for r in rows) / len(rows)


@pytest.mark.parametrize("held", [1_000_000, 0])
def test_long_text_of_mostly_other_terms_keeps_its_band(spark, monkeypatch, held):
    monkeypatch.setattr(imatch, "HELD", held)
    shared = " ".join(f"shared{n}" for n in range(40))
    rows = [(n, f"{shared} " + " ".join(f"own{n}x{k}" for k in range(20_000))) for n in (1, 2)]
    rows += [(n, f"filler{n}") for n in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs).collect()}
    assert not found[1].startswith("text:")
    assert found[1] == found[2]


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 64, 65, 1000, 5000])
def test_every_term_counts_and_lexicons_hold_several(n):
    draw = random.Random(n)
    found = np.array([draw.getrandbits(64) for _ in range(n)], np.uint64)
    written = imatch.fingerprint(found, 7)
    assert written == _fingerprint(found.tolist(), 7)
    level, coarse, fine = written.split("|")
    used = [sum(map(bool, parts.split("."))) for parts in (coarse, fine)]
    if n > 32:
        # more than one term in a lexicon on average, and twice as many in one of the coarser level
        assert n / used[1] > 1.1 and n / used[0] > 1.8
        assert n <= 2 * (imatch.LEXICONS << int(level) + 1)
    changed = found.copy()
    changed[draw.randrange(n)] ^= np.uint64(1 << 63)
    assert imatch.fingerprint(changed, 7) != written
    assert imatch.likeness(imatch.fingerprint(changed, 7), written) >= 1 - 6 / max(1, sum(used))


def test_a_small_table_has_a_band(spark):
    rows = [(n, f"alpha beta{n // 2} gamma{n // 2} own{n}") for n in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs).collect()}
    assert not any(f.startswith("text:") for f in found.values())
    assert all(found[n] == found[n + 1] for n in range(0, 12, 2)) and len(set(found.values())) == 6
