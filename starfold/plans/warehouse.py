"""Warehouse build: staging tables -> star schema with identity keys, laid out by its sort keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starfold import schemas
from starfold.operators.dims import time_dimension
from starfold.operators.facts import match_inner, with_row_id
from starfold.operators.quality import enforce_not_null
from starfold.plans import listens as L
from starfold.sinks.files import clustered, materialize, write_parquet
from starfold.sources.files import stage


def run_warehouse(
    spark: SparkSession, in_dir: str, out_dir: str, log_mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """Build the star schema in the order songs, artists, songplays, users, time; return ``songplays``.

    ``log_mapping`` maps staging columns to JSON keys; without it they go by name.
    """
    log = stage(spark, f"{in_dir}/log_data", schemas.LISTEN_LOG, log_mapping, millis_cols=["ts"], recursive=True)
    played = L.staged_plays(log, f"{out_dir}/staging/plays")
    staged_songs = materialize(
        stage(spark, f"{in_dir}/song_data", schemas.SONG_METADATA, recursive=True), f"{out_dir}/staging/songs"
    )

    write_parquet(clustered(L.songs(staged_songs), "song_id", ["song_id"]), f"{out_dir}/songs")
    write_parquet(clustered(L.artists(staged_songs), "artist_id", ["artist_id"]), f"{out_dir}/artists")
    songs, artists = (spark.read.parquet(f"{out_dir}/{t}") for t in ("songs", "artists"))

    fact = match_inner(L.listens(played), songs, artists).select(*L.SONGPLAYS)
    fact = enforce_not_null(fact, "songplays", L.REQUIRED)
    # numbering already sorts the fact by start_time, which is its sort key
    write_parquet(with_row_id(fact, L.SONGPLAYS, "songplay_id", 0, f"{out_dir}/staging/numbered"), f"{out_dir}/songplays")
    songplays = spark.read.parquet(f"{out_dir}/songplays").select("songplay_id", *L.SONGPLAYS)

    write_parquet(clustered(L.users(played), "user_id", ["user_id"]), f"{out_dir}/users")
    write_parquet(time_dimension(songplays, "start_time"), f"{out_dir}/time")
    return songplays
