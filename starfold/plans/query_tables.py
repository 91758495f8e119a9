"""Query-table build: one table per question, keyed and laid out for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold import schemas
from starfold.operators.dims import latest_per_key
from starfold.sinks.files import clustered, materialize, write_parquet
from starfold.sources.files import consolidate_csv

# table -> (partition key, clustering key, columns)
TABLES = {
    "session_items": (["session_id"], ["item_in_session"], ["artist", "song_title", "length"]),
    "user_sessions": (
        ["user_id", "session_id"], ["item_in_session"], ["song_title", "artist", "first_name", "last_name"],
    ),
    "song_users": (["song_title"], ["user_id"], ["first_name", "last_name"]),
}

RENAMED = {
    "sessionId": "session_id", "itemInSession": "item_in_session", "userId": "user_id",
    "firstName": "first_name", "lastName": "last_name", "song": "song_title",
}


def keyed_table(events: DataFrame, table: str, order: Sequence[str]) -> DataFrame:
    """The rows of one query table: the last row of each key, length as a 32-bit float."""
    partition, cluster, cols = TABLES[table]
    keys = [*partition, *cluster]
    # keys hardly repeat, so their rows are brought together before they are sorted, in tasks of the shuffle's size
    rows = events.select(*keys, *cols, *[c for c in order if c not in keys + cols]).repartition(*keys)
    # the other columns break ties, so that the last row does not depend on how files are read
    rows = latest_per_key(rows, keys, [*order, *cols])
    rows = rows.select(*keys, *cols)
    return rows.withColumn("length", F.col("length").cast("float")) if "length" in cols else rows


def run_query_tables(
    spark: SparkSession, in_dir: str, out_dir: str, order: Sequence[str] = ("ts",)
) -> dict[str, DataFrame]:
    """Consolidate the event CSV files and write the query tables; return them by name."""
    kept = consolidate_csv(spark, in_dir, schemas.EVENT_CSV, [*schemas.EVENT_COLUMNS, *order], require="artist")
    events = materialize(kept.withColumnsRenamed(RENAMED), f"{out_dir}/staging/events")
    out = {}
    for table, (partition, cluster, _) in TABLES.items():
        path = f"{out_dir}/{table}"
        write_parquet(clustered(keyed_table(events, table, order), partition, [*partition, *cluster]), path)
        out[table] = spark.read.parquet(path)
    return out
