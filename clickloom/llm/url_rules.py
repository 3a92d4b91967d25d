"""Allow and block rules on URLs, by a sort-merge range join.

A host's labels in reverse order, each closed by a dot, make a key under which a host and all its subdomains are one interval:
``net.example.`` starts every key from there to ``net.example.`` followed by the highest character. Both sides are cut
into ranges of that key order. In each range one sweep goes over the sorted URLs and rule starts, with a stack
of the rule hosts open at that point; since intervals nest, the stack is the chain of a URL's parents.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import importable

#: Sampled keys for each range: they only balance the ranges and change no result.
SAMPLED = 64

_HIGHEST = "\U0010ffff"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def host_key(host: Column) -> Column:
    """``net.example.`` for ``example.net``; every key starts with the keys of its parents."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Host:
    """The rules of one host by path."""

    def __init__(self, key: str, host: str) -> None:
        self.key, self.host = key, host
        self.verdicts: dict[str, str] = {}
        self.lengths: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        if path not in self.verdicts or verdict == "block":
            self.verdicts[path] = verdict
            self.lengths = sorted({len(p) for p in self.verdicts}, reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if path[:n] in self.verdicts), None)


def _hosts(rules: Iterable[tuple[str, str, str, str]]) -> list[_Host]:
    """Rules (key, host, path, verdict), sorted by key, by host."""
    found: list[_Host] = []
    for key, host, path, verdict in rules:
        if not found or found[-1].key != key:
            found.append(_Host(key, host))
        found[-1].add(path, verdict)
    return found


def sweep(
    urls: Iterable[tuple[str, str]], rules: Iterable[tuple[str, str, str, str]]
) -> Iterator[tuple[str, str] | None]:
    """For each (key, path), sorted by key: its (rule, verdict), or None."""
    waiting = iter(_hosts(rules))
    coming = next(waiting, None)
    stack: list[_Host] = []
    for key, path in urls:
        while coming is not None and coming.key <= key:
            while stack and not coming.key.startswith(stack[-1].key):
                stack.pop()
            stack.append(coming)
            coming = next(waiting, None)
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        best = None
        for level, at in enumerate(stack):
            fitting = at.longest(path)
            if fitting is not None:
                rank = (len(at.host) + len(fitting), level)
                if best is None or rank > best[0]:
                    best = rank, (at.host + fitting, at.verdicts[fitting])
        yield best and best[1]


def _bounds(keys: DataFrame, ranges: int) -> list[str]:
    """At most ``ranges`` - 1 cut points of the sort key, from a sample of about SAMPLED keys a range."""
    share = min(1.0, SAMPLED * ranges / max(1, keys.count()))
    drawn = sorted(row[0] for row in keys.sample(share, seed=7).select("sort_key").collect())
    return sorted({drawn[len(drawn) * n // ranges] for n in range(1, ranges)}) if drawn else []


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, host, path, the key of the host, and the key by which rows are cut into ranges, which none share."""
    urls = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("key", host_key(F.col("host")))
    return urls.withColumn(
        "sort_key",
        F.concat_ws(
            "\0",
            "key",
            "path",
            F.coalesce(F.col("page_id").cast("string"), F.lit("")),
            F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0"),
        ),
    )


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None
) -> DataFrame:
    """page_id, host, path, rule and verdict for each row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and the subdomains, for paths that start with its
    own; of those that fit the one with the longest host and path together wins, then the one with the longer host;
    where one host and path has both verdicts, block wins. Rules with a null count as absent. Without a rule
    ``rule`` is null and the verdict ``default``. A null URL, or one without ``://``, has an empty host and path. Repeated rows are judged
    one by one; other columns are not read. A frequent host is cut between its paths and page ids, and rows alike in all of them
    by a number of their own. A rule reaches
    each range its interval meets: its own, and of the broader ones at most one chain of parents a range.
    """
    importable(pages.sparkSession)
    ranges = ranges or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = pages.schema["page_id"].dataType.simpleString()
    urls = keyed(pages)
    bounds = _bounds(urls, ranges)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, key) for key in keys], dtype="int32")

    lowered = F.translate("host", _UPPER, _UPPER.lower())
    dealt = (
        rules.select("host", "path", "verdict")
        .dropna()
        .withColumn("host", lowered)
        .withColumn("key", host_key(F.col("host")))
        .select(
            "*",
            F.explode(
                F.sequence(
                    range_of(F.col("key")), range_of(F.concat(F.col("key"), F.lit(_HIGHEST)))
                )
            ).alias("range"),
        )
    )

    def merge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("key", kind="stable")
        right = right.sort_values(["key", "path"], kind="stable")
        found = sweep(
            zip(left["key"], left["path"], strict=True),
            right[["key", "host", "path", "verdict"]].itertuples(index=False, name=None),
        )
        pairs = [pair or (None, default) for pair in found]
        return left[["page_id", "host", "path"]].assign(
            rule=[rule for rule, _ in pairs], verdict=[verdict for _, verdict in pairs]
        )

    return (
        urls.withColumn("range", range_of(F.col("sort_key")))
        .select("page_id", "host", "path", "key", "range")
        .groupBy("range")
        .cogroup(dealt.groupBy("range"))
        .applyInPandas(merge, f"page_id {kind}, host string, path string, rule string, verdict string")
    )
