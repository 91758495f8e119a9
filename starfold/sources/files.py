"""File sources. Every reader takes a declared schema, so no pass over the data infers one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

LATIN_1 = "ISO-8859-1"
# The files that a recursive read takes, plain or compressed.
JSON_FILES = "{*.json,*.json.gz}"


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: str | StructType, recursive: bool = False, strict: bool = False
) -> DataFrame:
    """JSON lines below ``path``: globs of fixed depth, or folders of any depth with ``recursive``.

    A malformed line is a row of nulls, or fails the read with ``strict``.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", JSON_FILES)
    return reader.json(path if isinstance(path, str) else list(path))


def spelled_keys(spark: SparkSession, path: str | Sequence[str], recursive: bool = False, most: int = 10_000) -> list[str]:
    """The distinct top-level keys of the JSON lines below ``path``, as they are spelled.

    One pass over the lines, which counts no values and keeps a row per key. More than ``most`` spellings, as
    of objects whose keys are data, raise ``ValueError``.
    """
    keys = _lines(spark, path, recursive).select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
    found = [row[0] for row in keys.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{path} has over {most} different keys")
    return sorted(found)


def _lines(spark: SparkSession, path: str | Sequence[str], recursive: bool) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", recursive)
    if recursive:
        reader = reader.option("pathGlobFilter", JSON_FILES)
    return reader.text(path if isinstance(path, str) else list(path)).filter(F.trim("value") != "")


def read_json_any_case(
    spark: SparkSession, path: str | Sequence[str], schema: str, recursive: bool = False, strict: bool = False
) -> DataFrame:
    """JSON lines of flat objects, whose keys match the schema's names whatever their case.

    The keys' spellings are collected first; then Spark's typed reader reads with these. Where a name has
    several spellings in the data, each is read and the first that is not null counts, the declared spelling
    before others and these by name. A value that is not of its declared type is null. Blank lines are
    skipped; a malformed line is a row of nulls. With ``strict`` both fail the read.
    """
    fields = StructType.fromDDL(schema).fields
    found: dict[str, list[str]] = {f.name: [] for f in fields}
    for key in spelled_keys(spark, path, recursive):
        for f in fields:
            if key.lower() == f.name.lower():
                found[f.name].append(key)
    spellings = {f.name: sorted(found[f.name] or [f.name], key=lambda k: (k != f.name, k)) for f in fields}
    if all(len(keys) == 1 for keys in spellings.values()):
        spelled = StructType([StructField(spellings[f.name][0], f.dataType) for f in fields])
        df = read_json(spark, path, spelled, recursive, strict)
        return df.toDF(*[f.name for f in fields])
    # keys that differ in case alone cannot be columns of one table, but are fields of one parsed value
    every = [(name, key, f.dataType) for f in fields for name in [f.name] for key in spellings[name]]
    kinds = StructType([StructField(key, kind) for _, key, kind in every])
    parsed = F.from_json("value", kinds, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    numbered = StructType([StructField(f"c{k}", kind) for k, (_, _, kind) in enumerate(every)])
    rows = _lines(spark, path, recursive).select(parsed.cast(numbered).alias("v"))
    places = {f.name: [k for k, (name, _, _) in enumerate(every) if name == f.name] for f in fields}
    return rows.select(*[F.coalesce(*[F.col(f"v.c{k}") for k in places[f.name]]).alias(f.name) for f in fields])


class RejectedLines(ValueError):
    """More lines were rejected than a load allows."""


def stage_with_rejects(
    spark: SparkSession, path: str | Sequence[str], schema: str, staging: str, most: int | None = None,
    recursive: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Load JSON lines and split off those that do not fit: (rows, rejects with file, line and reason).

    A line that is no JSON object is rejected as ``malformed``; one whose value is not of its column's declared
    type as ``type of`` and the columns. Blank lines are skipped. The lines are parsed once, into ``staging``;
    both results read from there. More than ``most`` rejects raise ``RejectedLines``.
    """
    kind = StructType.fromDDL(schema)
    text = _lines(spark, path, recursive).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    whole = StructType([*kind.fields, StructField("__corrupt", StringType())])
    parsed = text.withColumn("v", F.from_json("line", whole, {"columnNameOfCorruptRecord": "__corrupt"}))
    # only lines that did not parse are looked at again
    entries = F.from_json("line", "map<string,string>")

    def untyped(name: str) -> Column:
        given = F.get(F.map_values(F.map_filter(entries, lambda key, _: key == name)), F.lit(0))
        return F.when(F.col(f"v.`{name}`").isNull() & given.isNotNull(), F.lit(name))

    wrong = F.array_compact(F.array(*[untyped(f.name) for f in kind.fields]))
    malformed = F.json_object_keys("line").isNull() | entries.isNull()
    reason = F.when(malformed, "malformed").otherwise(F.concat(F.lit("type of "), F.array_join(wrong, ", ")))
    bad = F.col("v.__corrupt").isNotNull() | F.col("v").isNull()
    names = [F.col(f"v.`{f.name}`").alias(f.name) for f in kind.fields]
    # the columns' names cannot clash with the load's own, which are kept in a struct
    reject = F.when(bad, F.struct("file", "line", reason.alias("reason"))).alias("__reject")
    parsed.select(*names, reject).write.mode("overwrite").parquet(staging)
    stored = spark.read.parquet(staging)
    rejects = stored.where("__reject is not null").select("__reject.*")
    if most is not None and (count := rejects.count()) > most:
        raise RejectedLines(f"{count} lines rejected, {most} allowed")
    return stored.where("__reject is null").drop("__reject"), rejects


def stage(
    spark: SparkSession,
    path: str,
    schema: str,
    mapping: Mapping[str, str] | None = None,
    millis_cols: Sequence[str] = (),
    recursive: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Load a JSON staging table.

    ``mapping`` names each target column's source key, as it is spelled; without it columns go by name,
    ignoring case. ``millis_cols`` (target names) hold epoch milliseconds and become timestamps. With
    ``strict`` a malformed line fails the load.
    """
    if mapping:
        df = read_json(spark, path, schema, recursive, strict)
        df = df.select(*[F.col(source).alias(target) for target, source in mapping.items()])
    else:
        df = read_json_any_case(spark, path, schema, recursive, strict)
    return df.withColumns({c: F.timestamp_millis(F.col(c)) for c in millis_cols})


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    sep: str = ",",
    encoding: str = LATIN_1,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. ``multi_line`` (quoted line breaks) makes files unsplittable, so it is off."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def consolidate_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: str, keep: Sequence[str], require: str,
    encoding: str = "UTF-8", multi_line: bool = False,
) -> DataFrame:
    """Many CSV files as one frame: drop rows whose ``require`` column is empty, keep some columns.

    ``multi_line`` reads quoted line breaks, at the price of one task per file.
    """
    df = read_csv(spark, paths, schema, encoding=encoding, multi_line=multi_line)
    return df.filter(F.col(require).isNotNull() & (F.col(require) != "")).select(*keep)


def read_parquet(spark: SparkSession, *paths: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One scan over all ``paths``, pruned to ``columns``."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


# Types that a column may take on from file to file, each read as the widest that occurs.
WIDENINGS = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"))


def _wider(column: str, a: DataType, b: DataType) -> DataType:
    for chain in WIDENINGS:
        if a.simpleString() in chain and b.simpleString() in chain:
            return max((a, b), key=lambda kind: chain.index(kind.simpleString()))
    raise ValueError(f"column {column} is {a.simpleString()} in some files and {b.simpleString()} in others")


def read_widened(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One scan over Parquet folders that differ: columns missing from some, numbers narrower in some.

    A missing column is null, a number has the widest of its types; types without a common one raise
    ``ValueError``. Only one footer per folder is read beforehand, so the files of a folder must agree. Columns stand
    in the order of their first occurrence; filters and pruned columns reach all files.
    """
    kinds: dict[str, DataType] = {}
    for path in paths:
        for f in spark.read.parquet(path).schema.fields:
            kinds[f.name] = f.dataType if kinds.get(f.name, f.dataType) == f.dataType else _wider(f.name, kinds[f.name], f.dataType)
    df = spark.read.schema(StructType([StructField(name, kind) for name, kind in kinds.items()])).parquet(*paths)
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The Parquet table at ``path`` in its declared schema; an empty one if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_path(template: str, run_date: dt.date) -> str:
    """Fill a run date into a path template such as ``logs/{run_date:%Y/%m}/*.json``."""
    return template.format(run_date=run_date)


def slice_by_run_date(df: DataFrame, ts_col: str, run_date: dt.date | str) -> DataFrame:
    """Rows of one day, as a half-open range on the raw column so that it reaches the scan."""
    day = F.lit(str(run_date)).cast("date")
    kind = df.schema[ts_col].dataType
    return df.filter((F.col(ts_col) >= day.cast(kind)) & (F.col(ts_col) < F.date_add(day, 1).cast(kind)))
