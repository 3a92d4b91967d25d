"""Personal data: the base patterns exactly, and what the labelers add."""

import hashlib
import re
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import pii, queries

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits):
    doubled = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _plain(text):
    found = []
    for number, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((number, *m.span()))
    return found


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ0159.-_%+@ ()é\n"), max_size=60))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == _plain(text)


def test_tricky_texts():
    for text in (
        "a@b@c.de.f@g.h", "x@y.z@w.v", "@@a.b@c.d", "a.b@-.-", "4111 1111 1111 1111 1", "4111-1111-1111-1111",
        "+1 (415) 555-0100", "+1234567890123456", "001.002.003.0004 256.1.1.1 1.2.3.4.5", "٣٣@a.b ５.５.５.５",
        "1" * 4000, "a" * 50_000 + "@", "@" * 5000, "+1 " * 5000,
    ):
        assert pii.base_spans(text) == _plain(text), text[:40]


def test_query_base_and_added(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    secrets = 0
    for row in queries.op8_pii(spark, sf_dir).collect():
        base = _plain(docs[row["doc_id"]])
        written = [f"{PATTERNS[k][0]}:{a}:{b}" for k, a, b in base]
        assert row["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [row[f"n_{k}"] for k, _ in PATTERNS] == [sum(s[0] == n for s in base) for n in range(4)]
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(written) <= set(spans)
        order = [(pii.ALL_KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)
        planted = re.findall(r'token = "[0-9a-f]{40}"', docs[row["doc_id"]])
        added = [s for s in spans if s.startswith("secret")]
        assert len(added) == len(planted)
        secrets += len(added)
    assert secrets


def test_em_learns_who_is_reliable():
    kind = pii.ALL_KINDS.index("secret")

    def code(*votes):
        number = kind
        for vote in votes:
            number = 3 * number + vote
        return 4 * number

    yes, no, none = pii.YES, pii.NO, pii.NOTHING
    # The first two labelers agree; the third says anything.
    counts = {
        code(yes, yes, yes): 200, code(yes, yes, no): 200, code(no, no, yes): 300, code(no, no, no): 300,
        code(yes, none, no): 20, code(no, none, yes): 20,
    }
    p = pii.reliabilities(counts)
    assert p[code(yes, yes, no)] > 0.9 and p[code(no, no, yes)] < 0.1
    assert p[code(yes, none, no)] > 0.5 > p[code(no, none, yes)]
    kept = pii.accepted(counts)
    assert code(yes, yes, no) in kept and code(no, no, yes) not in kept
    assert pii.accepted({}) == []


def test_redact(spark):
    hexes = hashlib.sha1(b"x").hexdigest()
    text = f'write to ann@b.example.com or +1 (415) 555-0100. token = "{hexes}" é'
    rows = [(1, text, len(text), "k"), (2, "clean 42 text", 13, "k"), (3, None, None, "k"), (4, "", 0, None), (None, text, 0, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    found = {(r["doc_id"], r["spans"]): r for r in pii.redact(docs).collect()}
    clean = found[1, "k"]["text"]
    assert "ann@" not in clean and "<email>" in clean and "<phone>" in clean
    assert found[1, "k"]["n_chars"] == len(clean)
    assert found[2, "k"]["text"] == "clean 42 text" and found[3, "k"]["text"] is None and found[4, None]["text"] == ""
    assert found[None, "k"]["text"] == clean
    assert pii.redact(docs).schema == docs.schema
    assert pii.redact(docs.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123.. a+", max_size=60))
def test_ip_matches_are_those_of_the_pattern(text):
    assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in pii.IP.finditer(text)]


@pytest.mark.parametrize(
    "text",
    ["1" * 2_000_000, "1." * 1_000_000, "1 " * 1_000_000, "1-" * 1_000_000, "a" * 2_000_000, "+1" * 1_000_000, "+1(" + "(" * 2_000_000,
     "a.b@" * 500_000, "A1" * 1_000_000, "é" * 2_000_000],
    ids=range(10),
)
def test_two_million_characters_take_seconds(text):
    started = time.monotonic()
    base = pii.base_spans(text)
    pii.further_spans(text, base)
    assert time.monotonic() - started < 20


def _further(text, base):
    """Whole tokens with a digit that touch no base span, tried one by one."""
    found = []
    for m in re.finditer("[A-Za-z0-9_-]+", text):
        token, (start, end) = m[0], m.span()
        if not re.search("[0-9]", token) or any(a < end and start < b for _, a, b in base):
            continue
        if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", token):
            kind = "ssn"
        elif re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", token):
            kind = "iban"
        elif len(token) >= 16 and not token.isdigit():
            kind = "secret"
        else:
            continue
        found.append((pii.ALL_KINDS.index(kind), start, end))
    return found


def masks(texts):
    """For each text its spans, base and accepted, with the model trained on the votes of all of them."""
    plain = [(text, _plain(text), _further(text, _plain(text))) for text in texts]
    votes = Counter(pii.signature(k, text, a, b) for text, base, more in plain for k, a, b in base + more)
    kept = set(pii.accepted(dict(votes)))
    return [sorted(base + [s for s in more if pii.signature(s[0], text, *s[1:]) in kept]) for text, base, more in plain]


def test_all_spans_against_trying_every_token(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = {
        r["doc_id"]: ",".join(f"{pii.ALL_KINDS[k]}:{a}:{b}" for k, a, b in spans)
        for r, spans in zip(docs, masks([r["text"] or "" for r in docs]), strict=True)
    }
    assert {r["doc_id"]: r["spans"] for r in queries.op8_pii(spark, sf_dir).collect()} == expected
    assert any("secret" in spans for spans in expected.values())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ019-_ .@+é"), max_size=80))
def test_further_spans_are_whole_tokens(text):
    base = pii.base_spans(text)
    assert pii.further_spans(text, base) == _further(text, base)
