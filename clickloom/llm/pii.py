"""Personal data by weak supervision: labelers vote, EM weighs them, and a classifier trained on that decides.

Spans come from fixed patterns (email, ip, card, phone; these always stay) and from wider ones: numbers and tokens
the fixed patterns leave out. On each span labelers vote yes, no or nothing: patterns, gazetteers, and words in the
context. A span's votes and shape make one of a fixed number of signatures. The corpus is counted by
signature, so that EM (Dawid and Skene, two classes) and the training of the final logistic model run over all spans
in a few thousand numbers. The model accepts or rejects signatures; accepted spans are added to the base.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import map_rows

# The base kinds in their order, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: IP's matches in time linear in the text: none starts within a run of digits, since a run that no dot follows has
#: none at any place, and each run is taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")

#: Kinds only the method finds.
FURTHER = ["secret", "ssn", "iban"]
ALL_KINDS = [*KINDS, *FURTHER]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9_-]+")
_TOKEN_LETTERS = _LOCAL - frozenset(".%+") | {"_"}
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")

# Gazetteers and context words; plain lists, in natural order.
TOP_LEVELS = {"com", "net", "org", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "eu"}
CARD_STARTS = ("2", "34", "37", "36", "38", "4", "5", "6")
IBAN_COUNTRIES = {"AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "NL", "NO", "PL", "PT", "SE"}
PRIVATE_NETS = ("0.", "10.", "127.", "192.168.", "255.")
CONTEXT = {
    "email": ("mail", "contact", "@", "write to"),
    "ip": ("ip", "server", "host", "address", "addr"),
    "card": ("card", "visa", "payment", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "secret": ("token", "secret", "key", "password", "passwd", "bearer", "auth"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
#: Characters before a span in which context words count.
REACH = 24

YES, NO, NOTHING = 1, 2, 0


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) << (place & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping EMAIL matches. Each has its first ``@`` after local characters only, so that only
    the characters before an ``@`` need a look."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the fixed patterns, by kind, then start."""
    found = [(0, start, end) for start, end in emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    at = text.find("+")
    if at >= 0:
        for m in PHONE.finditer(text, at):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, *m.span()))
    return found


def further_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of tokens with a digit that may be secrets, numbers of persons or accounts, outside ``base``."""
    found, taken = [], sorted((start, end) for _, start, end in base)
    place, n = 0, 0
    while m := _DIGIT.search(text, place):
        start = m.start()
        while start > place and text[start - 1] in _TOKEN_LETTERS:
            start -= 1
        end = _TOKEN.match(text, start).end()
        place = end
        while n < len(taken) and taken[n][1] <= start:
            n += 1
        if n < len(taken) and taken[n][0] < end:
            continue
        token = text[start:end]
        if _SSN.fullmatch(token):
            found.append((ALL_KINDS.index("ssn"), start, end))
        elif _IBAN.fullmatch(token):
            found.append((ALL_KINDS.index("iban"), start, end))
        elif end - start >= 16 and not token.isdigit():
            found.append((ALL_KINDS.index("secret"), start, end))
    return found


def _by_pattern(kind: str, span: str) -> int:
    if kind in KINDS:
        return YES
    if kind == "secret":
        letters = sum(c.isalpha() for c in span)
        mixed = 0.15 <= letters / len(span) <= 0.95
        return YES if mixed and len(set(span)) >= 8 and "-" not in span else NO
    if kind == "ssn":
        return NO if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" else YES
    rotated = "".join(str(int(c, 36)) for c in span[4:] + span[:4])
    return YES if int(rotated) % 97 == 1 else NO


def _by_gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        return YES if span.rpartition(".")[2].lower() in TOP_LEVELS else NO
    if kind == "ip":
        return NO if span.startswith(PRIVATE_NETS) else YES
    if kind == "card":
        return YES if span.startswith(CARD_STARTS) else NO
    if kind == "iban":
        return YES if span[:2] in IBAN_COUNTRIES else NO
    if kind == "secret":
        return YES if len(span) in (32, 40, 64) and re.fullmatch("[0-9a-f]+", span) else NOTHING
    return NOTHING


def _by_context(kind: str, text: str, start: int) -> int:
    before = text[max(0, start - REACH) : start].lower()
    if any(word in before for word in CONTEXT[kind]):
        return YES
    others = (w for k in FURTHER for w in CONTEXT[k] if k != kind)
    return NO if any(word in before for word in others) else NOTHING


def _shape(span: str) -> int:
    """0 to 3: length under or from 24 characters, and few or many different ones."""
    return 2 * (len(span) >= 24) + (len(set(span)) >= 12)


LABELERS = 3
SIGNATURES = len(ALL_KINDS) * 3**LABELERS * 4


def signature(kind: int, text: str, start: int, end: int) -> int:
    """Votes and shape of a span as one number under SIGNATURES."""
    name, span = ALL_KINDS[kind], text[start:end]
    number = kind
    for vote in (_by_pattern(name, span), _by_gazetteer(name, span), _by_context(name, text, start)):
        number = 3 * number + vote
    return 4 * number + _shape(span)


def _unpack(number: int) -> tuple[int, list[int], int]:
    number, shape = divmod(number, 4)
    votes = []
    for _ in range(LABELERS):
        number, vote = divmod(number, 3)
        votes.append(vote)
    return number, votes[::-1], shape


def reliabilities(counts: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Probability of each signature to be personal data, from its votes alone, by EM.

    Each kind has a prior, and each labeler of a kind a distribution of its votes among true and false spans; both start
    from the majority of votes and are smoothed by one count, so that an unseen vote is never impossible.
    """
    found: dict[int, float] = {}
    for kind in range(len(ALL_KINDS)):
        rows = [(s, *_unpack(s), n) for s, n in counts.items() if _unpack(s)[0] == kind]
        if not rows:
            continue
        n = np.array([row[4] for row in rows], float)
        votes = np.array([row[2] for row in rows])
        yes, no = (votes == YES).sum(1), (votes == NO).sum(1)
        p = (1 + 2 * yes) / (2 + 2 * yes + 2 * no)
        for _ in range(rounds):
            weight = np.stack([n * (1 - p), n * p])
            prior = (weight.sum(1) + 1) / (n.sum() + 2)
            logs = np.log(prior)[:, None] * np.ones(len(rows))
            for labeler in range(LABELERS):
                table = np.stack(
                    [np.bincount(votes[:, labeler], weight[c], 3) for c in (0, 1)]
                ) + np.array([[1 / 3, 1 / 3, 2 / 3], [1 / 3, 2 / 3, 1 / 3]])
                table /= table.sum(1, keepdims=True)
                logs += np.log(table[:, votes[:, labeler]])
            new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
            done = np.abs(new - p).max() < 1e-9
            p = new
            if done:
                break
        found |= {row[0]: float(q) for row, q in zip(rows, p, strict=True)}
    return found


def _features(number: int) -> np.ndarray:
    kind, votes, shape = _unpack(number)
    x = np.zeros(1 + len(ALL_KINDS) + 2 * LABELERS + 4)
    x[0] = x[1 + kind] = 1
    for labeler, vote in enumerate(votes):
        if vote != NOTHING:
            x[1 + len(ALL_KINDS) + 2 * labeler + (vote == YES)] = 1
    x[1 + len(ALL_KINDS) + 2 * LABELERS + shape] = 1
    return x


def train(counts: dict[int, int], ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model on kind, votes and shape, by Newton's method, for the labels EM gives."""
    soft = reliabilities(counts)
    width = len(_features(0))
    if not soft:
        return np.zeros(width)
    x = np.stack([_features(s) for s in soft])
    y = np.array(list(soft.values()))
    n = np.array([counts[s] for s in soft], float)
    w = np.zeros(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge * w
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + ridge * np.eye(width), slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def accepted(counts: dict[int, int], threshold: float = 0.5) -> list[int]:
    """Signatures among ``counts`` that the trained model takes for personal data."""
    w = train(counts)
    least = math.log(threshold / (1 - threshold))
    return sorted(s for s in counts if float(_features(s) @ w) >= least)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base and further spans (kind, start, end, signature) of each row of ``docs`` (doc_id, text).

    A null text is empty and has none. Offsets are code points, ends exclusive. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:int,start:bigint,stop:bigint,signature:int>>"

    def rows(slice_: list[dict]) -> list[dict]:
        return [
            {"doc_id": row["doc_id"], "base": with_signatures(row["text"], base := base_spans(row["text"]))}
            | {"further": with_signatures(row["text"], further_spans(row["text"], base))}
            for row in slice_
        ]

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_rows(source, rows, f"doc_id {kind}, base {span}, further {span}")


def with_signatures(text: str, spans: Iterable[tuple[int, int, int]]) -> list[dict]:
    return [
        {"kind": k, "start": start, "stop": end, "signature": signature(k, text, start, end)}
        for k, start, end in spans
    ]


def signature_counts(found: DataFrame) -> dict[int, int]:
    """How many spans of ``candidates`` have each signature: SIGNATURES rows at most."""
    counted = (
        found.select(F.explode(F.concat("base", "further")["signature"]).alias("signature"))
        .groupBy("signature")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return {row["signature"]: row["n"] for row in counted.collect()}


def find(found: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``found`` (written ``candidates``) with ``spans``: the base, and what the model accepts of the rest."""
    kept = accepted(signature_counts(found), threshold)
    chosen = F.filter("further", lambda s: s["signature"].isin(kept)) if kept else F.filter(
        "further", lambda s: F.lit(False)
    )
    return found.withColumn("spans", F.array_sort(F.concat("base", chosen)))


def redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by its kind in angle brackets, and n_chars kept in step.

    Spans that overlap are replaced together, under the name of the first. Rows without spans, and null texts, come
    back as they are, and so do all other columns. The votes are counted in a first pass over the texts; the
    second looks again, so that no text is shuffled or written in between.
    """
    kept = frozenset(accepted(signature_counts(candidates(docs)), threshold))

    def masked(text: str) -> str:
        base = base_spans(text)
        rest = [s for s in further_spans(text, base) if signature(s[0], text, s[1], s[2]) in kept]
        spans = sorted((start, end, kind) for kind, start, end in base + rest)
        if not spans:
            return text
        parts, free = [], 0
        for start, end, kind in spans:
            if start >= free:
                parts += [text[free:start], f"<{ALL_KINDS[kind]}>"]
            free = max(free, end)
        return "".join([*parts, text[free:]])

    def rows(slice_: list[dict]) -> list[dict]:
        for row in slice_:
            if row["text"] is not None:
                clean = masked(row["text"])
                if clean != row["text"]:
                    row["text"] = clean
                    if "n_chars" in row:
                        row["n_chars"] = len(clean)
        return slice_

    return map_rows(docs, rows, docs.schema)
