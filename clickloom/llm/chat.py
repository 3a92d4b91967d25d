"""Prefix-target expansion of conversations into training examples.

Every assistant turn becomes an example of its own: all turns before it are the context, and only its text is under the loss
mask. Turns are written as ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed. A text may hold these
very strings: in ``<|``, and in ``<`` with backslashes before a bar, one backslash is added, and taken away when reading
back. After that no text holds ``<|``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.arrow import importable, map_rows

# The public chat template's marks.
START = "<|im_start|>"
END = "<|im_end|>"

#: Characters of examples a task holds before it hands them on.
FLUSH = 8_000_000

_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\+)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: f"<{found[1][1:]}|", text)


def _role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _read_role(written: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(written))


def examples_of(turns: list[tuple[str, str]]) -> Iterator[tuple[str, int, int]]:
    """(text, loss start, loss end) of each example of one conversation's (role, text) turns."""
    context = ""
    closed = False
    for role, text in turns:
        head, body = f"{START}{_role(role)}\n", escape(text)
        if closed := role == "assistant":
            begin = len(context) + len(head)
            yield f"{context}{head}{body}{END}\n", begin, begin + len(body)
        context = f"{context}{head}{body}{END}\n"
    if not closed:
        yield context, len(context), len(context)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns = []
    for block in text.split(f"{END}\n")[:-1]:
        role, _, body = block.removeprefix(START).partition("\n")
        turns.append((_read_role(role), unescape(body)))
    return turns


def expand(conversations: DataFrame) -> DataFrame:
    """One row for each example: conv_id, example, text, loss_start, loss_end, is_last.

    ``conversations`` has conv_id, turn, role and text; other columns are not read. Turns are ordered by turn, nulls first, then
    role, then text; repeated rows are turns like others. A null text or role is empty, and the rows with a null
    conv_id form one conversation. ``text[loss_start:loss_end]`` is the escaped reply, in code points. If a
    conversation does not end with an assistant turn, a last example without loss holds the whole of it, so that ``is_last``
    always marks one row with all turns. An example is one string, so a conversation is gathered in one task; rows are
    handed on after FLUSH characters.
    """
    importable(conversations.sparkSession)
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    gathered = conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("example", pa.int32()),
            ("text", pa.string()),
            ("loss_start", pa.int64()),
            ("loss_end", pa.int64()),
            ("is_last", pa.bool_()),
        ]
    )

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        size = 0
        for batch in source:
            for conversation, turns in zip(batch.column(0), batch.column(1), strict=True):
                pairs = [(t["role"], t["text"]) for t in turns.as_py()]
                last = len(pairs) and sum(role == "assistant" for role, _ in pairs)
                last -= pairs[-1][0] == "assistant"
                for number, (text, begin, stop) in enumerate(examples_of(pairs)):
                    made.append(
                        {
                            "conv_id": conversation.as_py(),
                            "example": number,
                            "text": text,
                            "loss_start": begin,
                            "loss_end": stop,
                            "is_last": number == last,
                        }
                    )
                    size += len(text)
                    if size >= FLUSH:
                        yield pa.RecordBatch.from_pylist(made, schema=schema)
                        made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=schema)

    return gathered.select(F.col("conv_id").cast("bigint"), "turns").mapInArrow(
        batches,
        "conv_id bigint, example int, text string, loss_start bigint, loss_end bigint, is_last boolean",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What each example of ``expand`` says: conv_id, example, chars, reply (unescaped) and, on the last one, turns."""

    def rows(slice_: list[dict]) -> list[dict]:
        return [
            {
                "conv_id": row["conv_id"],
                "example": row["example"],
                "chars": len(row["text"]),
                "reply": unescape(row["text"][row["loss_start"] : row["loss_end"]]),
                "turns": [{"role": r, "text": t} for r, t in read_turns(row["text"])]
                if row["is_last"]
                else None,
            }
            for row in slice_
        ]

    return map_rows(
        examples,
        rows,
        "conv_id bigint, example int, chars bigint, reply string, turns array<struct<role:string,text:string>>",
    )
