"""Incremental ingest: each run takes only files it has not seen and adds them to a keyed table.

The table is a folder of batches, kept apart by the stream that wrote them. A batch holds one row per key
and is overwritten if its stream replays it, so a restarted run adds nothing twice. Several sources may
feed one table, and a stream whose progress was lost starts as a new one. Readers merge the batches by
key; ``compact`` folds them into one new table when there are many.

``merge_new_files`` merges into a table in folders by key instead: it pays for merging at once, and the number of
files and the cost of reading do not grow with the number of runs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.dims import latest_per_key
from starfold.operators.keyed import upsert_full
from starfold.sinks.buckets import KeyedTable
from starfold.sources.files import read_if_present


def ingest_new_files(
    spark: SparkSession, in_dir: str, schema: str, table_dir: str, progress_dir: str,
    keys: Sequence[str], order: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_format: str = "json", max_batch_bytes: int | None = None,
) -> None:
    """Stage all new files below ``in_dir`` and stop. ``progress_dir`` remembers what was read.

    ``max_batch_bytes`` splits a large backlog into several batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # the stream's own id, which its progress folder keeps over restarts
        stream = spark.read.schema("id STRING").json(f"{progress_dir}/metadata").first()["id"]
        merged = latest_per_key(transform(batch), keys, order)
        merged.write.mode("overwrite").parquet(f"{table_dir}/stream_id={stream}/batch_id={batch_id}")

    _take_new_files(spark, in_dir, schema, progress_dir, write, file_format, max_batch_bytes)


def merge_new_files(
    table: KeyedTable, in_dir: str, schema: str, progress_dir: str, order: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_format: str = "json", max_batch_bytes: int | None = None, archive_dir: str | None = None,
) -> None:
    """Merge all new files below ``in_dir`` into ``table`` and stop; the latest row by ``order`` of each key stays.

    A batch reads and rewrites the folders that its keys fall in. A batch that is replayed, or files that are read
    again after their progress was lost, change nothing: the rows they bring are already there. ``order`` must tell
    a key's rows apart for that. With ``archive_dir``, a folder outside ``in_dir``, files move there once a later
    batch has been planned, so those of the last batch move in the next run. One stream at a time may feed a table.
    """

    def write(batch: DataFrame, _: int) -> None:
        # the batch is read for its keys and for its rows, and merged rows replace files that are being read
        kept = latest_per_key(transform(batch), table.keys, order).persist()
        try:
            table.merge(kept, lambda old, new: upsert_full(old, new, table.keys, order))
        finally:
            kept.unpersist()

    options = {"cleanSource": "archive", "sourceArchiveDir": archive_dir} if archive_dir else {}
    _take_new_files(table.spark, in_dir, schema, progress_dir, write, file_format, max_batch_bytes, options)


def _take_new_files(
    spark: SparkSession, in_dir: str, schema: str, progress_dir: str, write: Callable[[DataFrame, int], None],
    file_format: str, max_batch_bytes: int | None, options: Mapping[str, str] | None = None,
) -> None:
    """Hand the files below ``in_dir`` that ``progress_dir`` does not know yet to ``write``, in batches, and stop."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).options(**(options or {}))
    if max_batch_bytes:
        reader = reader.option("maxBytesPerTrigger", max_batch_bytes)
    query = (
        reader.format(file_format).load(in_dir)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", progress_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_rows(
    spark: SparkSession, table_dir: str, keys: Sequence[str], order: Sequence[str], schema: str | None = None
) -> DataFrame:
    """The latest row per key over all batches; a later batch wins over an earlier one on equal order.

    With ``schema`` a table that nothing has been written to yet is empty; without it reading one fails.
    """
    if schema:
        batches = read_if_present(spark, table_dir, f"{schema}, stream_id STRING, batch_id BIGINT")
    else:
        batches = spark.read.parquet(table_dir)
    return latest_per_key(batches, keys, [*order, "batch_id", "stream_id"]).drop("batch_id", "stream_id")


def compact(spark: SparkSession, table_dir: str, out_dir: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the current rows as a new table with one batch, numbered below all later ones."""
    merged = current_rows(spark, table_dir, keys, order)
    merged.write.mode("overwrite").parquet(f"{out_dir}/stream_id=compacted/batch_id=-1")
