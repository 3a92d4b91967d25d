"""Byte-level BPE: a priority queue of merge ranks over a doubly linked symbol list.

Every piece of text that the pattern cuts out becomes a linked list of byte symbols. All adjacent pairs that
have a merge wait in a heap by rank, then by place; merging one pair changes its two neighbours, whose new pairs
join the heap, and entries whose pair has changed meanwhile are skipped when they come up. Decoding concatenates
the vocabulary's byte strings. Pieces repeat a lot, so each Python worker keeps the ones it met last.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import map_rows

# Fixed value: how the published byte-level vocabularies cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces a worker remembers: twice this many at most, none longer than LONGEST characters.
REMEMBERED = 400_000
LONGEST = 64

_PLACE = (1 << 40) - 1


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    spare = iter(range(256, 512))
    return [chr(byte if byte in shown else next(spare)) for byte in range(256)]


class _Memory(dict):
    """Pieces to ids. Full, it becomes the older generation, from which pieces in use come back."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]) -> None:
        self.encode = encode
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class BytePairEncoder:
    """Vocabulary, merges and special tokens of one ``tokenizers`` JSON file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary = stored["model"]["vocab"]
        symbols = byte_symbols()
        of_symbol = {symbol: byte for byte, symbol in enumerate(symbols)}
        self.byte_ids = [vocabulary[symbol] for symbol in symbols]
        self.strings = [b""] * (1 + max(vocabulary.values()))
        for token, number in vocabulary.items():
            self.strings[number] = bytes(of_symbol[symbol] for symbol in token)
        #: Pair of ids, as one number, to rank and resulting id, as one number.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(stored["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = vocabulary[left] << 20 | vocabulary[right]
            self.merges[key] = rank << 20 | vocabulary[left + right]
        self.special: dict[str, int] = {}
        for token in stored.get("added_tokens", []):
            self.special[token["content"]] = token["id"]
            missing = token["id"] + 1 - len(self.strings)
            self.strings.extend([b""] * max(0, missing))
            self.strings[token["id"]] = token["content"].encode()
        self.decimals = [str(number) for number in range(len(self.strings))]
        self.pieces = regex.compile(PIECES)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
            if longest_first
            else None
        )
        self.memory = _Memory(self.merge)

    def merge(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece."""
        byte_ids, merges = self.byte_ids, self.merges
        ids = [byte_ids[byte] for byte in piece.encode("utf-8")]
        n = len(ids)
        following = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for place in range(n - 1):
            found = merges.get(ids[place] << 20 | ids[place + 1])
            if found is not None:
                heap.append((found >> 20) << 40 | place)
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            place = entry & _PLACE
            right = following[place]
            if right >= n or ids[place] < 0:
                continue
            found = merges.get(ids[place] << 20 | ids[right])
            if found is None or found >> 20 != entry >> 40:
                continue
            ids[place] = merged = found & 0xFFFFF
            ids[right] = -1
            after = following[place] = following[right]
            if after < n:
                before[after] = place
                found = merges.get(merged << 20 | ids[after])
                if found is not None:
                    heapq.heappush(heap, (found >> 20) << 40 | place)
            left = before[place]
            if left >= 0:
                found = merges.get(ids[left] << 20 | merged)
                if found is not None:
                    heapq.heappush(heap, (found >> 20) << 40 | left)
        return tuple(number for number in ids if number >= 0)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; a special token's string in it becomes that token."""
        if self.specials is None or not any(token in text for token in self.special):
            return self._ordinary(text)
        ids: list[int] = []
        for part in self.specials.split(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self._ordinary(part)
        return ids

    def _ordinary(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memory.__getitem__, self.pieces.findall(text))))

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> BytePairEncoder:
    """One encoder for each file and Python worker."""
    return BytePairEncoder(path)


def apply(
    df: DataFrame,
    path: str,
    function: Callable[[BytePairEncoder, dict], dict],
    schema: str,
) -> DataFrame:
    """``function(encoder, row)`` over every row, with the encoder of ``path``."""

    def rows(slice_: list[dict]) -> list[dict]:
        tokens = encoder(path)
        return [function(tokens, row) for row in slice_]

    return map_rows(df, rows, schema)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``, one row for each row of ``docs``.

    A null text is the empty text, which has no ids. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    return apply(
        docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text")),
        path,
        lambda tokens, row: {"key": row["key"], "ids": tokens.encode(row["text"])},
        f"key {kind}, ids array<int>",
    ).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text``; null ids give the empty text, ids beyond the vocabulary are refused."""
    kind = encoded.schema[key].dataType.simpleString()
    return apply(
        encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")),
        path,
        lambda tokens, row: {"key": row["key"], "text": tokens.decode(row["ids"] or [])},
        f"key {kind}, text string",
    ).withColumnRenamed("key", key)
