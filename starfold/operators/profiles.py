"""Profiles that add up: each batch of a table is described once, and the whole from these descriptions alone.

A batch's description is one row. Rows, nulls, sums and extremes of batches add up exactly; the number of
distinct values is kept as a sketch of bounded size, whose union counts a value of several batches once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType

# 2 ** 14 places: one standard error is 0.8 % of the number of distinct values, in 16 KB a column.
SKETCH_BITS = 14


def _total(c: str, kind: DataType) -> Column | None:
    """The sum of a column of numbers, exact but for floating point; None of other columns."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return F.sum(F.col(c).cast("decimal(38,0)"))
    if isinstance(kind, DecimalType):
        return F.sum(c).cast(f"decimal(38,{kind.scale})")
    if isinstance(kind, (FloatType, DoubleType)):
        return F.sum(F.col(c).cast("double"))
    return None


def describe_batch(df: DataFrame, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row that describes ``df``: ``n_rows``, and for each column its nulls, extremes, sum and sketch.

    One pass, summed up before the shuffle, which moves a row per task. An empty table has a description too.
    Columns of maps have no order and are refused by Spark.
    """
    parts = [F.count("*").alias("n_rows")]
    for f in df.schema.fields:
        c = f"`{f.name}`"
        # by hash, so that every type can be counted; null counts as no value
        value = F.when(F.col(c).isNotNull(), F.xxhash64(c))
        total = _total(c, f.dataType)
        parts.append(
            F.struct(
                F.count_if(F.col(c).isNull()).alias("n_nulls"),
                F.min(c).alias("min_value"),
                F.max(c).alias("max_value"),
                *([] if total is None else [total.alias("total")]),
                F.hll_sketch_agg(value, F.lit(sketch_bits)).alias("sketch"),
            ).alias(f"of_{f.name}")
        )
    return df.agg(*parts)


def store_profile(df: DataFrame, path: str, batch: str | int, sketch_bits: int = SKETCH_BITS) -> None:
    """Describe the batch ``df`` and store that below ``path``. A batch that is loaded again replaces its description."""
    describe_batch(df, sketch_bits).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def stored_profile(spark: SparkSession, path: str, table: str, batches: Sequence[str | int] | None = None) -> DataFrame:
    """The profile of all ``batches`` together (all stored ones if none are given), a row per column.

    Reads the descriptions, a row per batch, and none of the table's rows. Extremes and sums are given as text;
    ``total`` is null where a column holds no numbers. ``n_distinct_estimate`` has the sketch's error, whatever
    the number of batches; the others are exact. The batches must have the same columns.
    """
    stored = spark.read.parquet(path)
    if batches is not None:
        stored = stored.where(F.col("batch").cast("string").isin([str(b) for b in batches]))
    described = [f for f in stored.schema.fields if f.name.startswith("of_")]
    parts = [F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")]
    for i, f in enumerate(described):
        c = f"`{f.name}`"
        sums = F.sum(f"{c}.total") if "total" in f.dataType.names else F.lit(None)
        parts += [
            F.coalesce(F.sum(f"{c}.n_nulls"), F.lit(0)).alias(f"{i}_nulls"),
            F.min(f"{c}.min_value").cast("string").alias(f"{i}_min"),
            F.max(f"{c}.max_value").cast("string").alias(f"{i}_max"),
            sums.cast("string").alias(f"{i}_total"),
            F.hll_sketch_estimate(F.hll_union_agg(f"{c}.sketch", F.lit(True))).alias(f"{i}_distinct"),
        ]
    rows = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(f.name.removeprefix("of_")).alias("column_name"), "n_rows",
            F.col(f"{i}_nulls").alias("n_nulls"), F.col(f"{i}_min").alias("min_value"), F.col(f"{i}_max").alias("max_value"),
            F.col(f"{i}_total").alias("total"), F.col(f"{i}_distinct").alias("n_distinct_estimate"),
        )
        for i, f in enumerate(described)
    ]
    return stored.agg(*parts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
