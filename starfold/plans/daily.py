"""Daily load: stage one run date, load the fact, then the dimensions, then the quality gate."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starfold import schemas
from starfold.operators.dims import time_dimension
from starfold.operators.facts import match_staging, with_hash_key
from starfold.operators.quality import assert_quality, not_null
from starfold.plans import listens as L
from starfold.sinks.files import materialize, replace_slice, write_parquet
from starfold.sources.files import read_if_present, run_path, stage

# The load_date of a load without a date.
WHOLE = "all"


def run_daily(
    spark: SparkSession, in_dir: str, out_dir: str, run_date: dt.date | None = None,
    log_path: str = "log_data/{run_date:%Y/%m/%Y-%m-%d}-events.json", mode: str = "overwrite",
) -> DataFrame:
    """Load the log of ``run_date`` (all of it if none is given) and return the loaded ``songplays``.

    Tables are partitioned by ``load_date``. ``overwrite`` replaces the run date's partition, also by
    nothing, so a rerun loads nothing twice and leaves nothing stale; ``append`` adds to it. A load
    without a date takes the place of all dates, and is refused where it would add to them; a dated load
    is refused on top of it. Raises ``QualityError`` on null keys.
    """
    rel = run_path(log_path, run_date) if run_date else "log_data"
    load_date = str(run_date) if run_date else WHOLE
    staging = f"{out_dir}/staging/{load_date}"
    events = stage(spark, f"{in_dir}/{rel}", schemas.LISTEN_LOG, millis_cols=["ts"], recursive=run_date is None)
    played = L.staged_plays(events, f"{staging}/plays")
    songs = materialize(
        stage(spark, f"{in_dir}/song_data", schemas.SONG_METADATA, recursive=True), f"{staging}/songs"
    )

    dates = read_if_present(spark, f"{out_dir}/songplays", "load_date STRING").select("load_date").distinct()
    mixed = dates.filter((F.col("load_date") == WHOLE) != F.lit(run_date is None))
    if (run_date or mode == "append") and not mixed.isEmpty():
        raise ValueError(f"{out_dir} holds a load of another kind; a whole and a dated load would repeat rows")

    def load(table: str, df: DataFrame) -> DataFrame:
        path = f"{out_dir}/{table}"
        if mode == "append":
            write_parquet(df, f"{path}/load_date={load_date}", mode=mode)
        elif run_date is None:
            write_parquet(df.withColumn("load_date", F.lit(WHOLE)), path, ["load_date"], rebalance=False)
        else:
            replace_slice(df, path, {"load_date": load_date})
        stored = spark.read.schema(StructType([*df.schema.fields, StructField("load_date", StringType())])).parquet(path)
        return stored.filter(F.col("load_date") == load_date).select(*df.columns)

    matched = match_staging(L.listens(played), songs)
    # the time's text is fixed to milliseconds, which is what the log holds
    keyed = with_hash_key(
        matched.withColumn("__t", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSS")),
        ["session_id", "__t"], "songplay_id",
    )
    fact = load("songplays", keyed.select("songplay_id", *L.SONGPLAYS))
    # the dimensions do not need each other, so their jobs are submitted side by side
    dimensions = {
        "songs": L.songs(songs), "users": L.users(played), "artists": L.artists(songs),
        "time": time_dimension(fact, "start_time", weekday="number", distinct=False),
    }
    with ThreadPoolExecutor(len(dimensions)) as pool:
        for loaded in [pool.submit(inheritable_thread_target(spark)(load), *named) for named in dimensions.items()]:
            loaded.result()
    assert_quality(not_null(fact, "songplays", L.REQUIRED))
    return fact
