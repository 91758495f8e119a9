"""Table-level quality checks.

Each check is a frame of ``(table_name, check_name, column_name, failing_rows, passed)``, so checks
can be unioned, stored and asserted together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.analytics import union_parts
from starfold.operators.joins import spread_join


class QualityError(ValueError):
    """A quality check found failing rows."""


def _result(table: str, check: str, column: str, failing: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
        failing.alias("failing_rows"), (failing == 0).alias("passed"),
    )


def _rows(one: DataFrame, results: Sequence[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """No nulls in any of ``cols``; all columns in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _rows(one, [_result(table, "not_null", c, F.col(c)) for c in cols])


def enforce_not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """The same rows, but reading a null in one of ``cols`` fails the job.

    Put before a write it enforces the constraint in the pass that writes; a failed write commits nothing.
    """
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{table}.{c} must not be null"))) for c in cols}
    )


def unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """No key occurs twice; ``failing_rows`` counts the keys that do."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("__n")).agg(F.count_if(F.col("__n") > 1).alias("n"))
    return _rows(repeated, [_result(table, "unique_key", ",".join(keys), F.col("n"))])


def allowed(df: DataFrame, table: str, col: str, values: Sequence[object]) -> DataFrame:
    """A column holds only allowed values; null is not one of them."""
    bad = df.agg(F.count_if(F.col(col).isNull() | ~F.col(col).isin(list(values))).alias("n"))
    return _rows(bad, [_result(table, "allowed_values", col, F.col("n"))])


def referential(child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Every non-null ``child.col`` is a key of the parent; ``failing_rows`` counts child rows.

    Child rows are counted per key before the join, which then moves one row per key.
    """
    per_key = child.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("k")).agg(F.count("*").alias("n"))
    missing = spread_join(per_key, parent.select(F.col(parent_col).alias("k")), "k", "left_anti")
    one = missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return _rows(one, [_result(table, "referential", col, F.col("n"))])


def not_empty(df: DataFrame, table: str) -> DataFrame:
    """The table has rows; an empty one fails with one failing row."""
    one = df.agg(F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint").alias("n"))
    return _rows(one, [_result(table, "not_empty", "*", F.col("n"))])


def present(spark: SparkSession, name: str) -> DataFrame:
    """The table ``name`` exists; a missing one fails with one failing row instead of an error."""
    return _rows(spark.range(1), [_result(name, "present", "*", F.lit(0 if spark.catalog.tableExists(name) else 1).cast("bigint"))])


def layout(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Files, bytes and rows of a Parquet table, from the files' own metadata and row counts."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    per_file = files.groupBy("file", "size").agg(F.count("*").alias("rows"))
    return per_file.agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.max("size"), F.lit(0)).alias("largest_file"),
    ).select(F.lit(table).alias("table_name"), "*")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` of each table."""
    return union_parts(
        [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    )


def profile(df: DataFrame, table: str, distinct: bool | str = False) -> DataFrame:
    """Rows, nulls, smallest and largest text of each column in one pass.

    ``distinct`` adds an estimated number of distinct values, ``"exact"`` the number itself, which reads each
    column once more and shuffles its values.
    """
    cols = df.columns
    aggs = [F.count("*").alias("__rows")]
    for i, c in enumerate(cols):
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{i}_nulls"),
            F.min(c).cast("string").alias(f"{i}_min"),
            F.max(c).cast("string").alias(f"{i}_max"),
        ]
        if distinct and distinct != "exact":
            aggs.append(F.approx_count_distinct(c).alias(f"{i}_distinct"))
    rows = []
    for i, c in enumerate(cols):
        fields = [
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col("__rows").alias("n_rows"),
            F.col(f"{i}_nulls").alias("n_nulls"), F.col(f"{i}_min").alias("min_value"),
            F.col(f"{i}_max").alias("max_value"),
        ]
        if distinct:
            fields.append(F.col(f"{i}_distinct").alias("n_distinct" if distinct == "exact" else "n_distinct_estimate"))
        rows.append(F.struct(*fields))
    one = df.agg(*aggs)
    if distinct == "exact":
        # apart from the extremes of texts, beside which Spark would sort a copy of each row for every column
        for i, c in enumerate(cols):
            one = one.crossJoin(df.agg(F.count_distinct(c).alias(f"{i}_distinct")))
    return _rows(one, rows)


def assert_quality(checks: DataFrame) -> None:
    """Raise if any check failed. Only check rows reach the driver, one per checked column."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.table_name}.{r.column_name}: {r.check_name} fails on {r.failing_rows} rows" for r in failed)
        )
