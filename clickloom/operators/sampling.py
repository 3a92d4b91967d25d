"""Exact, seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import events as E
from clickloom.operators import ranking

# Hex digits of a digest that fit a BIGINT.
_DIGITS = 15


def sample_exact(df: DataFrame, size: int, key: str, seed: int = 42) -> DataFrame:
    """``size`` rows, each as likely as any other; all rows if there are no more.

    The rows with the lowest seeded digest of ``key`` are taken, so the sample
    is the same however the table is partitioned. ``key`` must identify a row:
    copies of one key are drawn together, so rows that may be alike need a
    number of their own as the key.
    """
    digest = E.seeded_md5(F.col(key), seed)
    ranked = df.withColumns({"_draw": E.hex_prefix(digest, _DIGITS), "_digest": digest})
    order, bounds = ["_draw", "_digest", key], (0, 16**_DIGITS - 1)
    return ranking.first_n(ranked, order, size, bounds).drop("_draw", "_digest")
