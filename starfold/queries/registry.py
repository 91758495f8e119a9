"""Registration of queries: a function over the given tables and the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starfold.session import prepare, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Staged copies of the given tables in other file formats, written once per session.
_staged: dict[tuple[str, str, str], str] = {}


class Tables:
    """The given Parquet tables, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)

    def staged(self, label: str, write: Callable[[str], None]) -> str:
        """The folder that ``write`` filled from these tables, written on first use."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key not in _staged:
            path = self.scratch(label)
            write(path)
            _staged[key] = path
        return _staged[key]


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its name, with its SQL if SQL can express it."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(prepare(spark), sf_dir))
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return register
