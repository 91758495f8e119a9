"""File sinks and physical layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from starfold import schemas

# Fixed value: the characters that Spark escapes in the names of partition folders.
ESCAPED = "\"#%'*/:=?\\{[]^"
# Rows of a compressed text file: some 200 MB of wide rows, which one task reads as a whole.
PACKED_ROWS = 500_000
# Compression of the tables: fewer bytes than Spark's default, most of all for texts that do not repeat, such as hash keys.
TABLE_CODEC = "zstd"
# Hashes of repeated rows (8 bytes each) that are broadcast.
MOST_SHARED = 1_000_000


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """Bring equal ``cols`` together in tasks of about the advisory size.

    Spark merges small groups and splits a group too big for one task, so one hot partition
    value neither becomes one long task nor spreads over thousands of small files.
    """
    return df.hint("rebalance", *cols)


def clustered(df: DataFrame, dist_key: str | Sequence[str], sort_keys: Sequence[str]) -> DataFrame:
    """Distribution key and sort keys: rows of a key lie together, each task's rows are sorted."""
    keys = [dist_key] if isinstance(dist_key, str) else list(dist_key)
    return rebalanced(df, *keys).sortWithinPartitions(*sort_keys)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", dynamic: bool = False,
    rebalance: bool = True, bloom: Mapping[str, int] | None = None,
) -> None:
    """Write Parquet. ``dynamic`` overwrites only the partitions that ``df`` holds rows of.

    ``rebalance`` off saves a shuffle for rows that already lie together by partition. ``bloom`` names columns
    that get a Bloom filter in each row group, with the number of distinct values expected there: a lookup of a value then
    skips the row groups that lack it, also where the rows are not sorted by that column. A filter takes
    about ten bits a value; a number set too low lets lookups read more, never less.
    """
    if partition_by and rebalance:
        df = rebalanced(df, *partition_by)
    writer = df.write.mode(mode).option("compression", TABLE_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    for column, expected in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", expected)
    writer.parquet(path)


def _partition_folder(column: str, value: object) -> str:
    """The folder that a partition of ``value`` is written to, escaped as Spark does."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    text = "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in str(value))
    return f"{column}={text}"


def replace_slice(
    df: DataFrame, path: str, within: Mapping[str, object], partition_by: Sequence[str] = (), rebalance: bool = True
) -> None:
    """Replace all rows of a partitioned table whose leading partition columns have the values ``within``.

    Further partitions of the slice (``partition_by``) that ``df`` has no rows of are gone afterwards, and with
    an empty ``df`` the slice is, unlike under a dynamic overwrite; other slices are not touched. A row of ``df`` that
    is outside the slice fails the write before the slice is changed.
    """
    wrong = [F.lit(False), *(~F.col(c).eqNullSafe(F.lit(v)) for c, v in within.items() if c in df.columns)]
    outside = F.raise_error(F.lit(f"a row is outside the slice {dict(within)}")).cast("boolean")
    checked = df.filter(F.when(reduce(or_, wrong), outside).otherwise(F.lit(True)))
    folder = "/".join([path, *(_partition_folder(c, v) for c, v in within.items())])
    write_parquet(checked.drop(*within), folder, partition_by, rebalance=rebalance)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: text files are parsed once, and later reads prune columns."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def distinct_stored(stored: DataFrame, path: str, most: int = MOST_SHARED) -> DataFrame:
    """The distinct rows of a stored table, in which few rows repeat.

    Rows are equal only if their hashes are, so the hashes are counted first, and whole rows are moved and compared
    only where a hash occurs more than once. Without any such hash the stored table itself is the result; else the distinct rows
    are written below ``path``. More than ``most`` shared hashes are not broadcast: then all rows are moved.
    """
    hashed = stored.withColumn("__hash", F.xxhash64(*stored.columns))
    counts = hashed.groupBy("__hash").agg(F.count("*").alias("__n"))
    shared = materialize(counts.filter(F.col("__n") > 1).select("__hash"), f"{path}/shared")
    found = shared.count()
    if not found:
        return stored
    if found > most:
        return materialize(stored.distinct(), f"{path}/rows")
    marks = F.broadcast(shared)
    alone, alike = hashed.join(marks, "__hash", "left_anti"), hashed.join(marks, "__hash", "left_semi")
    return materialize(alone.unionByName(alike.distinct()).drop("__hash"), f"{path}/rows")


def write_json(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True, compression: str | None = None
) -> None:
    """Write JSON lines, in nested folders if ``partition_by`` is given.

    ``rebalance`` off saves a shuffle for rows that already lie together by partition. Readers cannot split
    a file written with ``compression``, so that one holds ``PACKED_ROWS`` rows at most.
    """
    if partition_by and rebalance:
        df = rebalanced(df, *partition_by)
    writer = _packed(df.write.mode("overwrite"), compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def _packed(writer: DataFrameWriter, compression: str | None) -> DataFrameWriter:
    if compression is None:
        return writer
    return writer.option("compression", compression).option("maxRecordsPerFile", PACKED_ROWS)


def write_csv(
    df: DataFrame, path: str, quote_all: bool = True, sep: str = ",", encoding: str = "UTF-8",
    compression: str | None = None,
) -> None:
    """Write CSV with a header line; ``compression`` as in ``write_json``.

    Texts with line breaks are quoted like others; a reader must be told to expect them (``multi_line``).
    """
    (
        _packed(df.write.mode("overwrite"), compression)
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("sep", sep)
        .option("encoding", encoding)
        .csv(path)
    )


def open_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table against its declared schema.

    Columns go by name. A missing column or another type raises before any row is read.
    """
    df = spark.read.parquet(path)
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        + (found[f.name].simpleString() if f.name in found else "no such column")
        for f in schemas.struct(schema).fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{path} does not match its schema: " + "; ".join(wrong))
    return df.select(*schemas.names(schema))


def load_table(
    spark: SparkSession, path: str, schema: str, name: str, mode: str = "append", location: str | None = None
) -> DataFrame:
    """Load Parquet files into the table ``name`` and return the table.

    The files are checked against the declared schema first; then their rows are added (``append``) or
    take the place of the table's (``replace``). ``location`` keeps a new table's files outside the warehouse.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode}")
    writer = open_table(spark, path, schema).write.mode("overwrite" if mode == "replace" else "append")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return spark.table(name)
