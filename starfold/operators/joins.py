"""Equi-joins and counts through a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big`` to ``small`` on equally named columns (``inner``, ``left``, ``left_semi`` or ``left_anti``).

    The join is left to Spark, so filters and columns still reach the scans. A side within the broadcast limit
    is broadcast by its measured size; else the adaptive skew join, which ``session.prepare`` turns on,
    splits the partition of a hot key, or of the null keys of a left join, over many tasks.
    """
    return big.join(small, [on] if isinstance(on, str) else list(on), how)


def count_through(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, by: Sequence[str], name: str = "n"
) -> DataFrame:
    """Rows of ``fact`` per ``by`` columns of ``dim``.

    The fact is counted per key before it is joined, so the join moves one row per key.
    """
    per_key = fact.filter(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias(dim_key)).agg(
        F.count("*").alias("__n")
    )
    joined = spread_join(per_key, dim.select(dim_key, *by), dim_key)
    return joined.groupBy(*by).agg(F.sum("__n").alias(name))
