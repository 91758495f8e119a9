"""Keyed incremental build: each run adds a batch of files to the tables.

A table is a folder of batches. A run reads the keys of the batches before its own, of times only those in the
span of its own log, and writes only what it adds. The last batch may be run again and is replaced; an earlier one may not, as later ones build on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold import schemas
from starfold.operators.dims import project, time_dimension
from starfold.operators.facts import match_left_first, with_row_id
from starfold.operators.keyed import absent_rows, first_per_key, in_time_of, upsert_partial
from starfold.operators.quality import enforce_not_null
from starfold.plans import listens as L
from starfold.sinks.files import materialize, write_parquet
from starfold.sources.files import read_if_present, read_json

# A user's place in the log; level breaks ties, so equal times give equal results on every run.
USER_ORDER = ["ts", "session_id", "item", "level"]
USER_KEPT = ["first_name", "last_name", "gender"]


def _batches(spark: SparkSession, out_dir: str, table: str, before: int) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/{table}").filter(F.col("batch") < before)


def _merge_users(base: DataFrame, delta: DataFrame) -> DataFrame:
    return upsert_partial(base, delta, ["user_id"], USER_ORDER, last_wins=["level"], first_wins=USER_KEPT)


def run_keyed(
    spark: SparkSession, in_dir: str, out_dir: str, batch: int = 0, logs: Sequence[str] = ("log_data",)
) -> None:
    """Add the song files and the ``logs`` (paths below ``in_dir``) as batch 0, 1, 2, ...

    Songs, artists and times keep the row of the first batch that had them. Users keep their first
    name and gender and get the latest level (see ``users``). Every play is kept once, with null ids
    where no song matches; its number goes on from the batch before. Raises ``ValueError`` if a later
    batch exists.
    """
    done = read_if_present(spark, f"{out_dir}/songplays", "batch INT").agg(F.max("batch")).first()[0]
    if done is not None and done > batch:
        raise ValueError(f"batch {batch} cannot be replaced: batch {done} builds on it")

    def add(table: str, rows: DataFrame) -> None:
        write_parquet(rows, f"{out_dir}/{table}/batch={batch}")

    def add_absent(table: str, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        new = absent_rows(_batches(spark, out_dir, table, batch), rows, keys, order) if batch else first_per_key(rows, keys, order)
        add(table, new)
        return _batches(spark, out_dir, table, batch + 1)

    staging = f"{out_dir}/staging/batch={batch}"
    raw = materialize(
        read_json(spark, f"{in_dir}/song_data", schemas.SONG_METADATA, recursive=True), f"{staging}/songs"
    )
    songs = add_absent("songs", project(raw, L.SONGS), ["song_id"], ["title", "artist_id", "year", "duration"])
    # an artist's first row is the one that came with the lowest song
    came_with = project(raw, {**L.ARTISTS, "first_song": "song_id"})
    artists = add_absent("artists", came_with, ["artist_id"], ["first_song"])

    log = read_json(spark, [f"{in_dir}/{p}" for p in logs], schemas.LISTEN_LOG, recursive=True)
    played = L.staged_plays(log, f"{staging}/plays", distinct=True)
    times = time_dimension(L.with_start_time(played), "start_time")
    if batch:
        known = in_time_of(_batches(spark, out_dir, "time", batch), L.with_start_time(played), "start_time")
        times = absent_rows(known, times, ["start_time"], ["start_time"])
    add("time", times)

    versions = project(played, {**L.USERS, "ts": "ts", "session_id": "sessionId", "item": "itemInSession"})
    add("users", _merge_users(versions.limit(0), versions))

    fact = enforce_not_null(
        match_left_first(L.listens(played), songs, artists).select(*L.SONGPLAYS), "songplays", ["start_time", "user_id"]
    )
    # numbers are dense, so the count, which the files' footers hold, is the last one
    start = 1 + (_batches(spark, out_dir, "songplays", batch).count() if batch else 0)
    add("songplays", with_row_id(fact, L.SONGPLAYS, "songplay_id", start, f"{staging}/numbered"))


def songplays(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/songplays").select("songplay_id", *L.SONGPLAYS)


def users(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per user over all batches: name and gender of the first batch, level of the latest play."""
    versions = spark.read.parquet(f"{out_dir}/users")
    merged = versions.groupBy("user_id").agg(
        F.min_by(F.struct(*USER_KEPT), F.struct("batch", *USER_ORDER)).alias("kept"),
        F.max_by("level", F.struct(*USER_ORDER, "batch")).alias("level"),
    )
    return merged.select("user_id", "kept.*", "level")
