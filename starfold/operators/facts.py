"""Fact tables: matching listens to songs, joining the calendar, generated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from starfold.functions.labels import hash_key
from starfold.operators.joins import spread_join
from starfold.session import scratch_dir

NATURAL_KEY = ["song", "artist", "length"]


def match_inner(events: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Keep events whose title and length are a song and whose artist name is an artist.

    Song and artist are matched apart, as the star schema's tables are: an event matches every
    song of its title and length times every artist of its name.
    """
    titles = songs.select(F.col("title").alias("song"), F.col("duration").alias("length"), "song_id")
    people = artists.select(F.col("name").alias("artist"), "artist_id")
    return spread_join(spread_join(events, titles, ["song", "length"]), people, "artist")


def match_staging(events: DataFrame, staging_songs: DataFrame) -> DataFrame:
    """Keep events that match one staged row on title, artist name and length at once."""
    lookup = staging_songs.select(
        F.col("title").alias("song"), F.col("artist_name").alias("artist"), F.col("duration").alias("length"),
        "song_id", "artist_id",
    )
    return spread_join(events, lookup, NATURAL_KEY)


def match_left_first(events: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Keep every event exactly once, with its first song and artist id or nulls.

    The first hit is the lowest (song_id, artist_id), chosen before the join.
    """
    owned = spread_join(
        songs.select("song_id", "title", "duration", "artist_id"), artists.select("artist_id", "name"), "artist_id"
    )
    lookup = (
        owned.groupBy(F.col("title").alias("song"), F.col("name").alias("artist"), F.col("duration").alias("length"))
        .agg(F.min(F.struct("song_id", "artist_id")).alias("__hit"))
        .select(*NATURAL_KEY, "__hit.song_id", "__hit.artist_id")
    )
    return spread_join(events, lookup, NATURAL_KEY, "left")


def with_time(fact: DataFrame, time: DataFrame, columns: Sequence[str] = ("year", "month")) -> DataFrame:
    """Add calendar columns from the time dimension; facts without a row there are dropped."""
    return spread_join(fact, time.select("start_time", *columns), "start_time")


def with_hash_key(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """A key computed from the row, the same on every run; null if a part is null."""
    return df.withColumn(key, hash_key(*[F.col(c) for c in cols]))


def with_row_id(
    df: DataFrame, order: Sequence[str], key: str = "row_id", start: int = 1, path: str | None = None
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in ``order``, without gaps and without one big task.

    The rows are range-partitioned and sorted in parallel, then written to the shared folder with
    their partition and position. The count of each partition gives the next one's offset; that
    little table has one row per shuffle partition. Since positions are stored, a lost executor
    cannot change them. Rows that tie on ``order`` are ranged by the input partition they come from,
    so that even a third of all rows sharing one time is split over many tasks. ``path`` is where the
    positions are kept, and overwritten by the next run; by default a new working folder.
    """
    spark = df.sparkSession
    by = [*order, "__from"]
    path = path or scratch_dir(spark, "row-id")
    (
        df.withColumn("__from", F.spark_partition_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("__from")
        .withColumn("__part", F.spark_partition_id())
        # the low 33 bits of this id count the rows of a partition
        .withColumn("__off", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .write.mode("overwrite").option("compression", "zstd").parquet(path)
    )
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("__part").agg((F.max("__off") + 1).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return (
        ranged.join(F.broadcast(offsets), "__part")
        .withColumn(key, F.col("__base") + F.col("__off") + F.lit(start))
        .drop("__part", "__off", "__base")
    )


def with_any_id(df: DataFrame, key: str = "row_id") -> DataFrame:
    """A unique number per row, neither dense nor the same on every run; costs no shuffle."""
    return df.withColumn(key, F.monotonically_increasing_id())
