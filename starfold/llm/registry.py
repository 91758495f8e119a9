"""The queries of this subpackage: name to function of (spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starfold.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(table: str, sql: str | None = None):
    """Register a function that is given whole tables (names joined by commas)."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(*(spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in table.split(",")))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = " ".join(sql.split())
        return fn

    return register
