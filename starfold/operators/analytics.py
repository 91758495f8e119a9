"""Analyst questions: top-k, lookups, counts, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators.joins import count_through, spread_join


def top_k(df: DataFrame, measure: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``measure``; equal measures in ``tie`` order. No full sort."""
    return df.orderBy(F.desc(measure), *tie).limit(k)


def top_played(plays: DataFrame, songs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most played titles. ``plays`` are counted per song before they are joined."""
    counted = count_through(
        plays.filter(F.col("songplay_id").isNotNull()), "song_id", songs, "song_id", ["title"], "played_freq"
    )
    return top_k(counted.withColumnRenamed("title", "song_title"), "played_freq", k, ["song_title"])


def topk_then_join(
    fact: DataFrame, key: str, dim: DataFrame, dim_key: str, dim_filter: Column, count: str,
    k: int = 10, n_fact: str = "n_fact", n_dim: str = "n_dim",
) -> DataFrame:
    """The ``k`` most frequent ``key`` values of the fact, with the number of matching dimension rows.

    Values without a matching dimension row are dropped after the top-k is taken.
    """
    top = top_k(fact.groupBy(key).agg(F.count("*").alias(n_fact)), n_fact, k, [key])
    # the top side has k rows
    matched = dim.filter(dim_filter).select(F.col(dim_key).alias(key), F.col(count).alias("__c"))
    return (
        matched.join(F.broadcast(top), key)
        .groupBy(key, n_fact)
        .agg(F.count("__c").alias(n_dim))
        .orderBy(F.desc(n_fact), key)
    )


def fact_by_place(
    fact: DataFrame, dim: DataFrame, place: str, measures: Mapping[str, Column], month: str | None = None,
    n_fact: str = "n_fact", weight: str | None = None,
) -> DataFrame:
    """Fact counts next to a dimension's measures, per place and optionally month.

    Both sides are aggregated on the join keys first, so the join is one row to one row. A fact that
    was already counted per some finer key gives its counts as ``weight``.
    """
    keys = [place, month] if month else [place]
    counted = fact.groupBy(*keys).agg((F.sum(weight) if weight else F.count("*")).alias(n_fact))
    measured = dim.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    return counted.join(measured, keys)


def point_lookup(
    df: DataFrame, keys: Mapping[str, object], cols: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of one key. On a table clustered by the key the scan skips the other row groups."""
    hit = df.filter(reduce(Column.__and__, [F.col(k) == F.lit(v) for k, v in keys.items()]))
    if order:
        hit = hit.orderBy(*order)
    return hit.select(*cols)


def keyed_lookup(
    df: DataFrame, wanted: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of many keys at once: the point lookup for a whole table of keys."""
    hit = spread_join(df, wanted.select(*keys).distinct(), list(keys), "left_semi")
    if order:
        hit = hit.orderBy(*order)
    return hit.select(*cols)


def describe_long(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, a row each; one pass."""
    stats = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.round(F.avg(c), digits),
        "stddev": lambda c: F.round(F.stddev_samp(c), digits),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
    }
    one = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{c}__{s}") for c in cols for s, f in stats.items()]
    )
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_ratio(df: DataFrame, col: str, alias: str = "null_ratio") -> DataFrame:
    """Share of rows without a value; null for an empty table."""
    return df.agg((F.count_if(F.col(col).isNull()) / F.nullif(F.count("*"), F.lit(0))).alias(alias))


def min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(DataFrame.unionByName, parts)
