"""Tables of the music star schema, as frames. The builds differ in which of these they combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators.dims import distinct_dim, latest_per_key, project
from starfold.sinks.files import distinct_stored, materialize

# Fixed value: the page of a log row that is a play.
PLAY_PAGE = "NextSong"

SONGS = {"song_id": "song_id", "title": "title", "artist_id": "artist_id", "year": "year", "duration": "duration"}
ARTISTS = {
    "artist_id": "artist_id", "name": "artist_name", "location": "artist_location",
    "latitude": "artist_latitude", "longitude": "artist_longitude",
}
USERS = {
    "user_id": "userId", "first_name": "firstName", "last_name": "lastName", "gender": "gender", "level": "level",
}
SONGPLAYS = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]
REQUIRED = ["start_time", "user_id", "song_id", "artist_id"]


def plays(log: DataFrame) -> DataFrame:
    return log.filter(F.col("page") == PLAY_PAGE)


def with_start_time(log: DataFrame) -> DataFrame:
    """Epoch milliseconds ``ts`` as the timestamp ``start_time``; a staged timestamp is only renamed."""
    if log.schema["ts"].dataType.typeName() == "long":
        return log.withColumn("start_time", F.timestamp_millis("ts"))
    return log.withColumnRenamed("ts", "start_time")


# The log columns that the star schema is built from.
PLAY_COLUMNS = [
    "ts", "userId", "firstName", "lastName", "gender", "level", "sessionId", "itemInSession", "location", "userAgent",
    "song", "artist", "length",
]


def staged_plays(log: DataFrame, path: str, distinct: bool = False) -> DataFrame:
    """The plays of a log as a staging table, which the fact, users and time are then built from."""
    if not distinct:
        return materialize(plays(log).select(*PLAY_COLUMNS), path)
    # before columns are dropped, so that only rows repeated as a whole count as one
    return distinct_stored(materialize(plays(log), path), f"{path}-once").select(*PLAY_COLUMNS)


def songs(staged: DataFrame) -> DataFrame:
    return distinct_dim(staged, SONGS)


def artists(staged: DataFrame) -> DataFrame:
    return distinct_dim(staged, ARTISTS)


def users(played: DataFrame) -> DataFrame:
    """The distinct user rows: a user who changed level has a row per level."""
    return distinct_dim(played, USERS)


def latest_users(played: DataFrame) -> DataFrame:
    """One row per user, with the level of the latest play."""
    # a row per version of a user first, by hash: picking the latest row sorts all that it is given
    dated = project(played, {**USERS, "ts": "ts"}).groupBy(*USERS).agg(F.max("ts").alias("ts"))
    return latest_per_key(dated, ["user_id"], ["ts", "level"]).drop("ts")


def listens(played: DataFrame) -> DataFrame:
    """Plays under the fact's column names, with the natural key still attached."""
    return with_start_time(played).select(
        "start_time", F.col("userId").alias("user_id"), "level", F.col("sessionId").alias("session_id"),
        "location", F.col("userAgent").alias("user_agent"), "song", "artist", "length",
    )
