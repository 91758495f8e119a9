"""Lake build: JSON folders -> partitioned Parquet star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold import schemas
from starfold.functions.dates import time_parts
from starfold.operators.dims import time_dimension
from starfold.operators.facts import match_inner, with_row_id
from starfold.plans import listens as L
from starfold.sinks.files import materialize, write_parquet
from starfold.sources.files import read_json


def run_lake(spark: SparkSession, in_dir: str, out_dir: str, users: str = "distinct") -> DataFrame:
    """Build ``songs, artists, users, time, songplays`` below ``out_dir`` and return ``songplays``.

    ``users`` is ``distinct`` (a row per user and level) or ``latest`` (a row per user).
    """
    raw = materialize(
        read_json(spark, f"{in_dir}/song_data", schemas.SONG_METADATA, recursive=True), f"{out_dir}/staging/songs"
    )
    # by year only: a folder per artist would be mostly tiny files
    songs, artists = L.songs(raw), L.artists(raw)
    write_parquet(songs, f"{out_dir}/songs", ["year"])
    write_parquet(artists, f"{out_dir}/artists")
    # read in the schema they were written with: a partitioned table without rows has no file to tell it
    songs = spark.read.schema(songs.schema).parquet(f"{out_dir}/songs")
    artists = spark.read.schema(artists.schema).parquet(f"{out_dir}/artists")

    log = read_json(spark, f"{in_dir}/log_data", schemas.LISTEN_LOG, recursive=True)
    played = L.staged_plays(log, f"{out_dir}/staging/plays")
    write_parquet(L.users(played) if users == "distinct" else L.latest_users(played), f"{out_dir}/users")
    write_parquet(time_dimension(L.with_start_time(played), "start_time"), f"{out_dir}/time", ["year", "month"])

    fact = match_inner(
        L.listens(played), songs.select("song_id", "title", "duration"), artists.select("artist_id", "name")
    ).select(*L.SONGPLAYS)
    # year and month follow from start_time, so the fact is not joined to the time table for them
    parts = time_parts(F.col("start_time"))
    numbered = with_row_id(fact, L.SONGPLAYS, "songplay_id", path=f"{out_dir}/staging/numbered")
    dated_fact = numbered.select("songplay_id", *L.SONGPLAYS, parts["year"].alias("year"), parts["month"].alias("month"))
    # a writer sorts its rows by folder, and a scan's task holds far more rows than a shuffle's
    write_parquet(dated_fact, f"{out_dir}/songplays", ["year", "month"])
    return spark.read.schema(dated_fact.schema).parquet(f"{out_dir}/songplays").select(*dated_fact.columns)
