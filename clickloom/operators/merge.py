"""Upsert as a pure function of two DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    when_newer: str | None = None,
    delete_unmatched: Column | None = None,
    replaces: DataFrame | None = None,
) -> DataFrame:
    """``target`` with the rows of ``source`` put over those with equal keys.

    ``source`` must hold each key once (see ``require_unique``). With
    ``when_newer`` a source row wins only if that column is not older than the
    target's. With ``delete_unmatched`` target rows it holds for are dropped
    unless the source has their key, and with ``replaces`` all target rows with
    one of its keys. No join side is hinted: Spark broadcasts
    the source where its measured size allows and shuffles on the keys otherwise.
    """
    winners = source
    if when_newer:
        held = target.select(*keys, when_newer).alias("r")
        beaten = _same_keys(keys) & (F.col(f"r.{when_newer}") > F.col(f"l.{when_newer}"))
        winners = source.alias("l").join(held, beaten, "left_anti")

    survivors = anti_join(target, winners, keys)
    if replaces is not None:
        survivors = anti_join(survivors, replaces, keys)
    if delete_unmatched is not None:
        unmatched = F.coalesce(delete_unmatched, F.lit(False))
        if when_newer:
            # a beaten source row still matches its target row
            kept = semi_join(survivors.filter(unmatched), source, keys)
            survivors = survivors.filter(~unmatched).unionByName(kept)
        else:
            survivors = survivors.filter(~unmatched)
    return survivors.unionByName(winners.select(target.columns))


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    left, right = left.alias("l"), right.select(*keys).alias("r")
    return left.join(right, _same_keys(keys), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    left, right = left.alias("l"), right.select(*keys).alias("r")
    return left.join(right, _same_keys(keys), "left_semi")


def _same_keys(keys: Sequence[str]) -> Column:
    # Null-safe: a row with a NULL in its key is updated rather than inserted
    # again by each run. Spark still plans this as an equi-join.
    return reduce(
        lambda a, b: a & b, [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    )


def matched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows the source will replace."""
    return semi_join(target, source, keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Refuse an ambiguous source, as MERGE does."""
    found = duplicate_keys(source, keys).take(3)
    if found:
        examples = [row.asDict() for row in found]
        raise ValueError(f"merge source holds duplicate keys {list(keys)}: {examples}")
