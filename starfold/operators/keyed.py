"""Keyed writes as set operations: upserts and inserts of a batch into a table.

Each merges by aggregation, which Spark starts before the shuffle, so a key with many versions
shrinks to one row per input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators.dims import first_per_key, latest_per_key

__all__ = ["absent_rows", "first_per_key", "in_time_of", "insert_if_absent", "latest_per_key", "upsert_full", "upsert_partial"]


def _both(base: DataFrame, delta: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Base and delta rows; ``__side`` tells them apart, base rows first."""
    return base.select(*columns, F.lit(0).alias("__side")).unionByName(
        delta.select(*columns, F.lit(1).alias("__side"))
    )


def upsert_partial(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str],
    last_wins: Sequence[str], first_wins: Sequence[str],
) -> DataFrame:
    """Insert new keys; for known keys update only the ``last_wins`` columns.

    ``first_wins`` columns keep the value a key was first inserted with. ``last_wins`` columns are those
    of the latest row by ``order``, so a late batch of older rows does not undo newer ones; on equal order
    the delta wins. The latest ``order`` values are kept, so the result can be the base of the next batch.
    Applying a batch twice changes nothing.
    """
    kept = [*last_wins, *[c for c in order if c not in (*keys, *first_wins, *last_wins)]]
    both = _both(base, delta, [*keys, *first_wins, *kept])
    inserted, when = F.struct("__side", *order), F.struct(*order, "__side")
    return (
        both.groupBy(*keys)
        .agg(
            F.min_by(F.struct(*first_wins), inserted).alias("__first"),
            F.max_by(F.struct(*kept), when).alias("__last"),
        )
        .select(
            *keys,
            *[F.col(f"__first.{c}").alias(c) for c in first_wins],
            *[F.col(f"__last.{c}").alias(c) for c in kept],
        )
    )


def upsert_full(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert new keys; of known keys keep the latest row by ``order``, the delta's on equal order."""
    both = _both(base, delta, base.columns)
    return latest_per_key(both, keys, [*order, "__side"]).drop("__side")


def absent_rows(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first delta row of each key that ``base`` lacks.

    Only the base's keys are moved, not its rows. Null keys are equal, so a batch applied twice adds
    nothing the second time.
    """
    incoming = first_per_key(delta, keys, order)
    known = base.select(*[F.col(k).alias(f"__known_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__known_{k}")) for k in keys]
    return incoming.join(known, same, "left_anti").select(*delta.columns)


def in_time_of(base: DataFrame, delta: DataFrame, time: str) -> DataFrame:
    """The rows of ``base`` from the span of time of ``delta``, and those without a time.

    No other row of the base can have a key of the delta that holds ``time``, so a merge needs none. The span is two
    values known before the base is read, and reaches its scan: batches of other times are skipped by
    the extremes in their files.
    """
    first, last = delta.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    timeless = F.col(time).isNull()
    if first is None:
        return base.where(timeless)
    return base.where(timeless | F.col(time).between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))))


def insert_if_absent(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Base with the first delta row of each key that it lacks; base rows stay as they are."""
    return base.unionByName(absent_rows(base, delta, keys, order).select(*base.columns))
