"""Quality by hierarchical empirical Bayes.

Each document has evidence of its own: a logistic model on the shape of its text and on telling terms, trained on a bounded sample of
labelled documents. Its site adds a prior: hosts shrink toward the global rate, paths toward their host, each with the
strength that the spread between hosts, or paths, of all documents suggests. Sparse sites so say little, large
ones speak for themselves. Two heads are judged alike: good quality, and toxicity. A document's own evidence does not
count again in its site's rate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import importable
from clickloom.sinks import scratch

#: Labelled documents the model is trained on, at most (about; chosen by hash). All others are only scored.
LABELLED = 20_000
#: Labelled documents that must hold a term, and its least deviation in standard errors, to be telling.
TERM_DOCUMENTS = 8
TERM_SIGMAS = 5.0

HEADS = ("quality", "toxic")
_MARKS = ".,;:!?\"'()[]{}<>#$%&*|@~^_=+-/\\`"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = bytes(range(ord("0"), ord("9") + 1))
_SYMBOLS = b"#$%&*|@~^_=+\\<>{}[]`"
_STOPS = b".,;:!?"
_SHAPE = 9


def shape(text: str, words: list[str], distinct: int) -> list[float]:
    """Figures of a text that do not depend on its language."""
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))

    def share(of: bytes) -> float:
        return (len(raw) - len(raw.translate(None, of))) / size

    n = max(1, len(words))
    return [
        math.log1p(len(words)),
        math.log(distinct / n) if distinct else 0.0,
        math.log1p(100 * share(_UPPER)),
        math.log1p(100 * share(_DIGITS)),
        math.log1p(100 * share(_SYMBOLS)),
        math.log1p(100 * share(_STOPS)),
        math.log(size / n),
        math.log1p(100 * raw.count(b"|") / n),
        math.log1p(100 * raw.count(b"\n") / n),
    ]


def terms_of(text: str) -> tuple[list[str], set[str]]:
    """Words between white space, and the distinct ones in lower case without marks around them."""
    words = text.lower().split()
    return words, {word.strip(_MARKS) for word in set(words)}


@dataclass
class Model:
    """Weights of both heads: on the shape, and on the summed log odds of the telling terms."""

    terms: dict[str, tuple[float, float]] = field(default_factory=dict)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(_SHAPE + 2))
    scale: np.ndarray = field(default_factory=lambda: np.ones(_SHAPE + 2))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((2, 1 + 2 * (_SHAPE + 2))))
    #: Share of labelled documents with each label.
    prior: np.ndarray = field(default_factory=lambda: np.full(2, 0.5))

    def features(self, text: str) -> tuple[list[float], int]:
        words, distinct = terms_of(text)
        sums = [0.0, 0.0]
        for term in distinct & self.terms.keys():
            for head, odds in enumerate(self.terms[term]):
                sums[head] += odds
        limited = [max(-12.0, min(12.0, s)) for s in sums]
        return [*shape(text, words, len(set(words))), *limited], len(words)

    def design(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return np.hstack([np.ones((len(x), 1)), x, np.minimum(x * x, 25)])

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of both heads, and the number of words."""
        if not texts:
            return np.zeros((0, 2)), np.zeros(0, np.int64)
        found = [self.features(text) for text in texts]
        x = self.design(np.array([f for f, _ in found]))
        return np.clip(x @ self.weights.T, -20, 20), np.array([n for _, n in found])


def _newton(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x.T * (p * (1 - p))) @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """text, quality and toxic (0 or 1) of about ``most`` labelled documents at most, one row for each.

    Labels with a null are left out; of several for a document the majority holds. Of several rows with one doc_id the text with
    the smallest hash stands for all. The label side has a known bound, so it may be broadcast; tasks reduce their rows to one
    text for each chosen document, and only these are shuffled.
    """
    each = (
        labels.dropna(subset=["doc_id", *HEADS])
        .groupBy("doc_id")
        .agg(*((F.avg(head) >= 0.5).cast("int").alias(head) for head in HEADS))
    )
    share = min(1.0, most / max(1, each.count()))
    chosen = each.filter(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    single = rows.groupBy("doc_id", *HEADS).agg(least.alias("least"))
    return single.select(F.col("least.text").alias("text"), *HEADS)


def telling_terms(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Terms whose documents differ from the rest in a label, with their log odds ratio for each head."""
    split = F.array_distinct(
        F.transform(
            F.split(F.lower("text"), r"\s+"), lambda w: F.btrim(w, F.lit(_MARKS))
        )
    )
    counted = (
        rows.select(*HEADS, F.explode(split).alias("term"))
        .filter(F.col("term") != "")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(head).alias(head) for head in HEADS))
        .filter(F.col("n") >= TERM_DOCUMENTS)
    )
    total = rows.agg(F.count(F.lit(1)).alias("n"), *(F.sum(head).alias(head) for head in HEADS)).first()
    if not total["n"]:
        return {}

    def rate(head: str) -> float:
        return (total[head] + 1) / (total["n"] + 2)

    def deviation(head: str) -> Column:
        p = rate(head)
        return F.abs(F.col(head) - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))

    telling = counted.filter(F.greatest(*map(deviation, HEADS)) >= TERM_SIGMAS)

    def odds(row, head: str) -> float:
        p = rate(head)
        q = (row[head] + 2 * p) / (row["n"] + 2)
        certain = abs(row[head] - row["n"] * p) >= TERM_SIGMAS * math.sqrt(row["n"] * p * (1 - p))
        return math.log(q / (1 - q)) - math.log(p / (1 - p)) if certain else 0.0

    return {row["term"]: (odds(row, "quality"), odds(row, "toxic")) for row in telling.collect()}


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Model:
    """The document model; without labels all log odds are 0."""
    importable(docs.sparkSession)
    rows = labelled(docs, labels, most)
    model = Model(terms=telling_terms(rows))
    features = _features_udf(model)
    drawn = rows.select(features(F.col("text")).alias("x"), *HEADS).collect()
    if not drawn:
        return model
    x = np.array([row["x"] for row in drawn])
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    design = model.design(x)
    targets = [np.array([row[head] for row in drawn], float) for head in HEADS]
    model.weights = np.stack([_newton(design, y) for y in targets])
    model.prior = np.array([(y.sum() + 1) / (len(y) + 2) for y in targets])
    return model


def _features_udf(model: Model):
    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([model.features(text)[0] for text in texts])

    return features


def evidence(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``__evidence``: log odds of both heads and the number of words of each text."""
    importable(docs.sparkSession)

    @F.pandas_udf("quality double, toxic double, words int")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = []
            for start in range(0, len(texts), 512):
                logits, words = model.logits(texts.iloc[start : start + 512].tolist())
                parts.append(pd.DataFrame({"quality": logits[:, 0], "toxic": logits[:, 1], "words": words}))
            yield pd.concat(parts) if parts else pd.DataFrame({"quality": [], "toxic": [], "words": []})

    return docs.withColumn("__evidence", scores(F.coalesce(text, F.lit(""))))


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def sites(scored: DataFrame, host: str, path: str) -> DataFrame:
    """__host, __path and for each head: sum and number below the path, rate of its host, strength of the path's prior.

    ``scored`` has ``__evidence``. Everything is a grouped sum, combined before the shuffle. Strengths come from the spread of
    rates by moments: between hosts for the hosts, between the paths of a host for the paths.
    """
    sums = [F.sum(_probability(F.col(f"__evidence.{head}"))).alias(f"s_{head}") for head in HEADS]
    paths = (
        scored.groupBy(F.col(host).alias("__host"), F.col(path).alias("__path"))
        .agg(F.count(F.lit(1)).alias("n"), *sums)
    )
    # Written, so that the texts are scored once for all the figures below.
    paths = scratch.written(paths, "sites")
    hosts = paths.groupBy("__host").agg(
        F.sum("n").alias("host_n"), *(F.sum(f"s_{head}").alias(f"host_{head}") for head in HEADS)
    )
    whole = hosts.agg(
        F.sum("host_n").alias("n"), *(F.sum(f"host_{head}").alias(f"all_{head}") for head in HEADS)
    ).first()
    total = whole["n"] or 0
    rates = [((whole[f"all_{head}"] or 0) + 0.5) / (total + 1) for head in HEADS]

    def strength(spread: float | None, p: float) -> float:
        """Of a Beta prior with mean ``p`` whose variance is the spread beyond chance; from 1 to 10,000."""
        variance = max(spread or 0.0, 1e-9)
        return min(1e4, max(1.0, p * (1 - p) / variance - 1))

    def spread(n: Column, s: Column, p: Column) -> Column:
        """Mean squared deviation of the rates, weighted by n, less what chance explains."""
        return F.sum(n * ((s / n - p) ** 2) - p * (1 - p)) / F.sum(n)

    between = hosts.agg(
        *(
            spread(F.col("host_n"), F.col(f"host_{head}"), F.lit(p)).alias(head)
            for head, p in zip(HEADS, rates, strict=True)
        )
    ).first()
    for head, p in zip(HEADS, rates, strict=True):
        s = strength(between[head], p)
        hosts = hosts.withColumn(f"rate_{head}", (F.col(f"host_{head}") + s * p) / (F.col("host_n") + s))
    both = paths.join(hosts, paths["__host"].eqNullSafe(hosts["__host"])).drop(hosts["__host"])
    within = both.agg(
        *(spread(F.col("n"), F.col(f"s_{head}"), F.col(f"rate_{head}")).alias(head) for head in HEADS)
    ).first()
    for head, p in zip(HEADS, rates, strict=True):
        both = both.withColumn(f"strength_{head}", F.lit(strength(within[head], p)))
    names = [f"{part}_{head}" for part in ("s", "rate", "strength") for head in HEADS]
    return both.select("__host", "__path", "n", *names)


VERDICT = ("__quality", "__toxic", "__keep")


def judged(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """``docs`` with __quality, __toxic (posterior probabilities) and __keep.

    A document is rejected if good quality is less likely than not, or toxicity at least as likely as not; or if its text, null or
    empty, has no words. A null host or path is a site like others. Repeated rows are judged alike. Without labels no document with
    words is rejected. All other columns come back as they are, whatever their names; only columns that have the
    names of the three new ones are replaced by these.

    The texts are read twice, once for the sites and once for the verdicts, and never shuffled as long as Spark finds the table
    of sites small enough to broadcast; beyond that it joins by shuffle.
    """
    rest = [name for name in docs.columns if name.lower() not in VERDICT]
    return _judged(docs.select(*map(_quoted, rest)), labels, host, path)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _judged(docs: DataFrame, labels: DataFrame, host: str, path: str) -> DataFrame:
    # Inside, the input's columns are called by number, and so clash with nothing.
    names = [name.lower() for name in docs.columns]
    numbered = docs.toDF(*(f"c{n}" for n in range(len(names))))

    def own(name: str) -> str:
        return f"c{names.index(name.lower())}"

    texts = numbered.select(F.col(own("doc_id")).alias("doc_id"), F.col(own("text")).alias("text"))
    model = train(texts, labels)
    scored = evidence(numbered, model, own("text"))
    prior = sites(scored.select(own(host), own(path), "__evidence"), own(host), own(path))
    met = scored.join(
        prior,
        scored[own(host)].eqNullSafe(prior["__host"]) & scored[own(path)].eqNullSafe(prior["__path"]),
    )
    out = {}
    for head, p in zip(HEADS, model.prior, strict=True):
        logit = F.col(f"__evidence.{head}")
        strength = F.col(f"strength_{head}")
        others = F.greatest(F.col(f"s_{head}") - _probability(logit), F.lit(0.0))
        rate = (others + strength * F.col(f"rate_{head}")) / (F.col("n") - 1 + strength)
        rate = F.least(F.greatest(rate, F.lit(1e-4)), F.lit(1 - 1e-4))
        out[f"__{head}"] = _probability(logit + _logit(rate) - math.log(p / (1 - p)))
    keep = (F.col("__quality") >= 0.5) & (F.col("__toxic") < 0.5) & (F.col("__evidence.words") > 0)
    if not model.weights.any():
        keep = F.col("__evidence.words") > 0
    found = met.withColumns(out).withColumn("__keep", keep)
    return found.select(*numbered.columns, *VERDICT).toDF(*docs.columns, *VERDICT)


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, all columns as they are."""
    names = [name.lower() for name in docs.columns]
    used = {"doc_id", "text", host.lower(), path.lower()}
    numbered = docs.toDF(*(name if name in used else f"__c{n}" for n, name in enumerate(names)))
    found = _judged(numbered, labels, host, path).filter("__keep")
    return found.select(*numbered.columns).toDF(*docs.columns)
