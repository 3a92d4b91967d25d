"""Main text by differencing each page with the page of the nearest URL.

Pages are sorted by host and path; of the nearest pages on either side on its host, exact copies passed over, the one
with the longer common path is a page's pair. The lines of both are aligned by their longest common subsequence, and shared lines are deleted. A line is known by its
text, except in furniture (menus, adverts, footers and the like, found by element or class name), where the words change from page to page
but the place does not: there it is known by its slot and number. Two things differencing alone gets wrong, and are set
right after it: an article line that the nearest page shares (a mirrored article, a repeated sentence) is restored, and furniture the
nearest page lacks is deleted too. On pages that mark no article, what is neither shared nor furniture is the text.
"""

from __future__ import annotations

import json
import os
import random
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import map_rows, map_sorted
from clickloom.llm.html_lines import ANYWHERE, ARTICLE, FURNITURE, Line, lines
from clickloom.llm.url_rules import host_of, path_of
from clickloom.sinks import scratch

#: Ranges for each shuffle partition, and sampled keys for each range, which only balance them.
RANGES = 4
SAMPLED = 32


def keys_of(page: list[Line]) -> list[int]:
    """What each line is known by."""
    seen: Counter[str] = Counter()
    keys = []
    for line in page:
        if line.part == FURNITURE:
            seen[line.slot] += 1
            keys.append(xxhash.xxh3_64_intdigest(f"\0{line.slot}\0{seen[line.slot]}"))
        else:
            keys.append(xxhash.xxh3_64_intdigest(line.text))
    return keys


def _lengths(one: list[int], other: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of ``one`` and every start of ``other``, by bits of one long number."""
    places: dict[int, int] = {}
    for n, key in enumerate(other):
        places[key] = places.get(key, 0) | 1 << n
    full = (1 << len(other)) - 1
    unmatched = full
    for key in one:
        if hits := places.get(key, 0):
            found = unmatched & hits
            unmatched = (unmatched + found | unmatched - found) & full
    data = (full ^ unmatched).to_bytes(len(other) // 8 + 1, "little")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: len(other)]
    return np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])


def shared(one: list[int], other: list[int]) -> set[int]:
    """Indices in ``one`` of a longest common subsequence with ``other``.

    Equal lines at both ends are taken off, lines the other side lacks cost nothing, and the rest is halved until it is
    trivial: memory is linear, and time a small part of a second for thousands of equal lines.
    """
    there, here = set(other), set(one)
    first = [(n, key) for n, key in enumerate(one) if key in there]
    found: set[int] = set()
    waiting = [(first, [key for key in other if key in here])]
    while waiting:
        left, right = waiting.pop()
        start, stop, end = 0, len(left), len(right)
        while start < min(stop, end) and left[start][1] == right[start]:
            found.add(left[start][0])
            start += 1
        while stop > start and end > start and left[stop - 1][1] == right[end - 1]:
            stop, end = stop - 1, end - 1
            found.add(left[stop][0])
        left, right = left[start:stop], right[start:end]
        if not left or not right:
            continue
        if len(left) == 1:
            if left[0][1] in right:
                found.add(left[0][0])
            continue
        half = len(left) // 2
        keys = [key for _, key in left]
        ahead = _lengths(keys[:half], right)
        behind = _lengths(keys[half:][::-1], right[::-1])[::-1]
        cut = int(np.argmax(ahead + behind))
        waiting += [(left[:half], right[:cut]), (left[half:], right[cut:])]
    return found


def main_text(page: list[Line], pair: list[int] | None) -> dict:
    """text of a page whose pair has lines known by ``pair``; and how many lines differencing and the corrections decided.

    n_shared lines are deleted as shared, n_restored are shared and yet of the article, n_marked are furniture the
    pair lacks, n_outside stand outside an article that the page marks.
    """
    common = shared(keys_of(page), pair) if pair else set()
    has_article = any(line.part == ARTICLE for line in page)
    counts = Counter(n_shared=0, n_restored=0, n_marked=0, n_outside=0)
    kept = []
    for n, line in enumerate(page):
        if line.part == ARTICLE:
            counts["n_restored"] += n in common
            kept.append(line.text)
        elif n in common:
            counts["n_shared"] += 1
        elif line.part == FURNITURE:
            counts["n_marked"] += 1
        elif has_article and line.part == ANYWHERE:
            counts["n_outside"] += 1
        else:
            kept.append(line.text)
    return {"text": " ".join(kept), **counts}


def beyond(ends: Iterable[tuple]) -> Iterator[tuple]:
    """For each range of ``ends`` (number, last place, last place with other lines or None), in order: the number, the nearest
    place before the range, and the nearest with other lines than that one. A place ends with its content."""
    near = other = None
    for number, last, second in ends:
        yield number, near, other
        other = second or (near if near and near[-1] != last[-1] else other)
        near = last


def _placed(pages: DataFrame) -> DataFrame:
    """The pages with what they are sorted by, and a number of each row."""
    url = F.col("url")
    return pages.select(
        "page_id",
        "url",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("tie"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    )


def _written(html: str) -> tuple[bytes, int]:
    """The lines of a page, and what they are known by."""
    made = json.dumps(lines(html)).encode()
    return made, xxhash.xxh3_64_intdigest(made) - (1 << 63)


def _packed(html: str) -> dict:
    plain, content = _written(html)
    return {"content": content, "packed": zstandard.ZstdCompressor(level=3).compress(plain)}


def guests_of(cuts: list[tuple], keys: DataFrame) -> dict[tuple, tuple]:
    """For each place in ``cuts``, which are places of ``keys`` in order: the nearest place before it and the nearest after it
    with other lines, None where there is none. A place is (host, path, tie, content)."""
    numbered = map_rows(
        keys,
        lambda slice_: [
            r | {"range": bisect_right(cuts, (r["host"], r["path"], r["tie"], r["content"]))} for r in slice_
        ],
        "host string, path string, tie string, content bigint, range int",
    )
    key = F.struct("host", "path", "tie", "content")
    # One row for each range at most, here and below.
    found = numbered.groupBy("range").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    ends = {row["range"]: (tuple(row["low"]), tuple(row["high"])) for row in found}
    contents = {at: (low[-1], high[-1]) for at, (low, high) in ends.items()}
    unlike = map_rows(
        numbered,
        lambda slice_: [
            r | {"l": r["content"] != contents[r["range"]][0], "h": r["content"] != contents[r["range"]][1]}
            for r in slice_
        ],
        "host string, path string, tie string, content bigint, range int, l boolean, h boolean",
    )
    others = {
        row["range"]: [row[side] and tuple(row[side]) for side in ("low", "high")]
        for row in unlike.groupBy("range")
        .agg(F.min(F.when(F.col("l"), key)).alias("low"), F.max(F.when(F.col("h"), key)).alias("high"))
        .collect()
    }
    order = sorted(ends)
    before = {n: places for n, *places in beyond((n, ends[n][1], others[n][1]) for n in order)}
    after = {n: places for n, *places in beyond((n, ends[n][0], others[n][0]) for n in reversed(order))}

    def unlike_of(cut: tuple, places: list) -> tuple | None:
        return next((place for place in places if place and place[-1] != cut[-1]), None)

    # A cut is the first place of its range.
    return {
        cut: (unlike_of(cut, before[n]), others[n][0] or unlike_of(cut, after[n]))
        for n, cut in enumerate(cuts, 1)
    }


def dealt(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, tie, content, packed, range, guest: the lines of all pages, dealt over ranges of their order.

    A range also gets, as guests, the places it is cut at and the nearest with other lines than these, so that every page finds its
    nearest unlike pages in its own range. Rows alike in everything are cut by a number of their own; a guest is
    sent once to a range, however many copies of it there are.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    source = _placed(pages)
    keyed = map_rows(
        source.select("host", "path", "tie", "html"),
        lambda slice_: [r | {"content": _written(r.pop("html"))[1]} for r in slice_],
        "host string, path string, tie string, content bigint",
    )
    keys = scratch.written(keyed, "page-keys")
    ranges = max(1, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = min(1.0, SAMPLED * ranges / max(1, keys.count()))
    number = random.Random(3)
    drawn = sorted((*row, number.getrandbits(32)) for row in keys.sample(share, seed=3).collect())
    bounds = sorted({drawn[len(drawn) * n // ranges] for n in range(1, ranges)}) if drawn else []

    cuts = sorted({bound[:-1] for bound in bounds})
    near = guests_of(cuts, keys) if cuts else {}
    guests: dict[tuple, set[int]] = {}
    for n, (*cut, _) in enumerate(bounds):
        cut = tuple(cut)
        before, after = near[cut]
        for at, neighbour, beside in ((n, after, n - 1), (n + 1, before, n + 1)):
            # Between two cuts at one place there are only copies of it.
            if not 0 <= beside < len(bounds) or bounds[beside][:-1] != cut:
                guests.setdefault(cut, set()).add(at)
            if neighbour:
                guests.setdefault(neighbour, set()).add(at)

    def owned(slice_: list[dict]) -> list[dict]:
        for row in slice_:
            row |= _packed(row.pop("html"))
            place = row["host"], row["path"], row["tie"], row["content"]
            own = xxhash.xxh32_intdigest(str(row.pop("row")))
            row |= {"range": bisect_right(bounds, (*place, own)), "guest": False}
        return slice_

    def invited(slice_: list[dict]) -> list[dict]:
        made = []
        for row in slice_:
            row |= _packed(row.pop("html")) | {"page_id": None, "url": None, "guest": True}
            place = row["host"], row["path"], row["tie"], row["content"]
            made += [row | {"range": at} for at in guests.get(place, ())]
        return made

    schema = (
        f"page_id {kind}, url string, host string, path string, tie string, content bigint, packed binary, range int, guest boolean"
    )
    own = map_rows(source, owned, schema)
    if not guests:
        return own
    # Four places for each range at most.
    places = spark.createDataFrame(sorted({place[:3] for place in guests}), "host string, path string, tie string")
    asked = source.drop("page_id", "url", "row").join(F.broadcast(places), ["host", "path", "tie"], "left_semi")
    asked = asked.groupBy("host", "path", "tie", F.sha2("html", 256)).agg(F.first("html").alias("html"))
    return own.unionByName(map_rows(asked.select("host", "path", "tie", "html"), invited, schema))


def differences(rows: Iterable[dict]) -> Iterator[dict]:
    """The results of pages that come in order, range by range. Of the pages with the same lines only what tells them apart is held."""
    open_ = zstandard.ZstdDecompressor()

    def read(row: dict) -> list[Line]:
        return [Line(*line) for line in json.loads(open_.decompress(row["packed"]))]

    def alike(row: dict, other: dict | None) -> int:
        """Characters of the common path, or -1 on another host or without another page."""
        if other is None or row["host"] != other["host"]:
            return -1
        return len(os.path.commonprefix([row["path"], other["path"]]))

    def results(run: list[dict], before: dict | None, after: dict | None) -> Iterator[dict]:
        made: dict[str, dict] = {}
        page = None
        for row in run:
            if row["guest"]:
                continue
            back, ahead = alike(row, before), alike(row, after)
            side = "none" if max(back, ahead) < 0 else "before" if back >= ahead else "after"
            if side not in made:
                page = page or read(run[0])
                pair = {"none": None, "before": before, "after": after}[side]
                made[side] = main_text(page, None if pair is None else keys_of(read(pair)))
            found = made[side]
            yield {"page_id": row["page_id"], "url": row["url"], "n_chars": len(found["text"])} | found

    run: list[dict] = []
    before = None
    for row in rows:
        if run and (row["range"] != run[0]["range"] or row["content"] != run[0]["content"]):
            same = row["range"] == run[0]["range"]
            yield from results(run, before, row if same else None)
            # The last page of a run has the run's lines.
            before = run[-1] | {"packed": run[0]["packed"]} if same else None
            run = []
        if run:
            row["packed"] = None
        run.append(row)
    if run:
        yield from results(run, before, None)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, and the counts of ``main_text``, for each row of ``pages`` (page_id, url, html).

    A null html is empty and gives the empty text. A null url, or one without ``://``, has an empty host and path; such pages are
    compared among themselves. Repeated rows are pages like others, but a page with all the same lines is never a pair, as
    nothing would be left. A page without unlike pages on its host has no pair. Other columns are not read.

    The lines travel once, compressed. A task walks through its ranges in order and holds two pages and one run of copies, of
    which the lines are held and aligned once; a frequent host is cut between its paths and page ids, and copies of one row between
    each other.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    return map_sorted(
        dealt(pages),
        ["range"],
        ["host", "path", "tie", "content"],
        differences,
        f"page_id {kind}, url string, text string, n_chars bigint, "
        "n_shared bigint, n_restored bigint, n_marked bigint, n_outside bigint",
    )
