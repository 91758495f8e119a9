"""Dimension tables: distinct rows, one row per key, calendars and calendar means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.dates import time_parts


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Choose and rename: target name -> source column."""
    return df.select(*[(F.col(s) if isinstance(s, str) else s).alias(t) for t, s in mapping.items()])


def distinct_dim(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """The distinct rows of a projection. A key may repeat if its other columns differ."""
    return project(df, mapping).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``: a deterministic drop of duplicates."""
    return _pick(df, keys, F.min_by, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``."""
    return _pick(df, keys, F.max_by, order)


def _pick(df: DataFrame, keys: Sequence[str], pick, order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = pick(F.struct(*rest), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns]
    )


def time_dimension(
    df: DataFrame, ts_col: str, weekday: str = "name", distinct: bool = True
) -> DataFrame:
    """``start_time`` and its calendar columns, per distinct time unless ``distinct`` is off."""
    times = df.select(F.col(ts_col).alias("start_time"))
    if distinct:
        times = times.distinct()
    return times.select("start_time", *[c.alias(n) for n, c in time_parts(F.col("start_time"), weekday).items()])


def calendar_mean(
    df: DataFrame, date_col: str, by: Sequence[str], value: str, alias: str, scale: int | None = None
) -> DataFrame:
    """Mean of ``value`` per month, day and ``by`` columns; nulls do not count.

    With ``scale`` the values are summed as decimals of that scale, so the mean does not depend on
    the order in which tasks finish.
    """
    v = F.col(value)
    mean = F.avg(v) if scale is None else F.sum(v.cast(f"decimal(18,{scale})")).cast("double") / F.count(v)
    return df.groupBy(F.month(date_col).alias("month"), F.dayofmonth(date_col).alias("day"), *by).agg(
        mean.alias(alias)
    )
