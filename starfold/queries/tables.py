"""Queries on tables laid out by key, slices that are replaced, and inputs that do not all fit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators import keyed, profiles
from starfold.queries.files import (
    EVENT_JSON, EVENT_ROWS, LINE_ROWS, ORDER, ORDER_DATED, ORDER_ROWS, as_text, base_and_delta, event_json_dir,
)
from starfold.queries.registry import Tables, query
from starfold.sinks import files as sinks
from starfold.sinks.buckets import KeyedTable, save_bucketed
from starfold.sources import files as sources
from starfold.streaming import ingest

BUCKETS = 32


def bucketed(t: Tables, df: DataFrame, keys: list[str], sort: list[str]) -> DataFrame:
    return save_bucketed(df, f"bucketed_{uuid.uuid4().hex}", keys, BUCKETS, sort, t.scratch("bucketed"))


@query(
    """SELECT o_custkey, o_orderstatus, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderstatus"""
)
def bucketed_join(t: Tables) -> DataFrame:
    """Fact and dimension distributed by one key: they join without a shuffle of either."""
    lines = bucketed(t, t.lineitem, ["l_orderkey"], ["l_orderkey", "l_linenumber"])
    orders = bucketed(t, t.orders, ["o_orderkey"], ["o_orderkey"])
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").cast("double").alias("quantity")
    )


def keyed_events(t: Tables, keys: tuple[str, ...]) -> KeyedTable:
    return KeyedTable(t.spark, t.scratch("keyed-events"), t.events.schema.toDDL(), keys, BUCKETS)


@query(
    f"""SELECT {EVENT_ROWS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1"""
)
def merge_by_folder(t: Tables) -> DataFrame:
    """Upserts into folders by key hash; the second batch is applied twice, as after a restart."""
    base, delta = base_and_delta(t)
    table = keyed_events(t, ("user_id",))
    for batch in (base, delta, delta):
        table.merge(batch, lambda old, new: keyed.upsert_full(old, new, ["user_id"], ORDER))
    return as_text(table.rows(), "ts")


@query(
    f"""SELECT {EVENT_ROWS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2, ts, event_id) AS rn
        FROM events) WHERE rn = 1"""
)
def insert_by_folder(t: Tables) -> DataFrame:
    """Rows of new keys are added to the folders of their keys; a second time adds nothing."""
    base, delta = base_and_delta(t)
    table = keyed_events(t, ("user_id", "event_type"))
    for batch in (base, delta, delta):
        table.insert_absent(batch, ORDER)
    return as_text(table.rows(), "ts")


@query(
    f"""SELECT {ORDER_DATED} FROM orders
        WHERE year(o_orderdate) <> (SELECT min(year(o_orderdate)) FROM orders) OR month(o_orderdate) <= 6"""
)
def replace_slice(t: Tables) -> DataFrame:
    """The first year is loaded again with half of its months: the others are gone, and no other year is touched."""
    path = t.scratch("slice")
    df = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}).where("year is not null")
    sinks.write_parquet(df, path, ["year", "month"])
    first = df.agg(F.min("year")).first()[0]
    sinks.replace_slice(df.where((F.col("year") == first) & (F.col("month") <= 6)), path, {"year": first}, ["month"])
    return as_text(t.spark.read.parquet(path), "o_orderdate")


LINE_STATE = """CASE WHEN event_id % 7 = 3 THEN 'malformed' WHEN event_id % 11 = 5 THEN 'type of user_id'
                     WHEN event_id % 13 = 6 THEN 'type of user_id, value' ELSE 'accepted' END"""


@query(f"SELECT {LINE_STATE} AS state, count(*) AS n_lines FROM events GROUP BY ALL")
def staged_with_rejects(t: Tables) -> DataFrame:
    """Events as JSON lines of which some are cut off and some hold values of another type."""
    path = t.scratch("lines")
    good = t.events.withColumn("ts", F.unix_millis(F.col("ts").cast("timestamp")))
    state = F.expr(LINE_STATE)
    typed = F.to_json(F.struct(*good.columns))
    wrong_user = F.to_json(F.struct(*[F.lit("nobody").alias(c) if c == "user_id" else F.col(c) for c in good.columns]))
    wrong_both = F.to_json(
        F.struct(*[F.lit("none").alias(c) if c in ("user_id", "value") else F.col(c) for c in good.columns])
    )
    line = (
        F.when(state == "malformed", F.substring(typed, 1, 20))
        .when(state == "type of user_id", wrong_user)
        .when(state == "type of user_id, value", wrong_both)
        .otherwise(typed)
    )
    good.select(line.alias("value")).write.text(path)
    rows, rejects = sources.stage_with_rejects(t.spark, path, EVENT_JSON, t.scratch("staged-lines"))
    accepted = rows.groupBy(F.lit("accepted").alias("state")).agg(F.count("*").alias("n_lines"))
    return accepted.unionByName(rejects.groupBy(F.col("reason").alias("state")).agg(F.count("*").alias("n_lines")))


@query(f"SELECT {LINE_ROWS.replace('l_tax', 'CASE WHEN month(l_shipdate) = 1 THEN NULL ELSE l_tax END AS l_tax')} FROM lineitem WHERE l_shipdate IS NOT NULL")
def months_that_differ(t: Tables) -> DataFrame:
    """One scan over months of which the first lacks a column and the second holds narrower numbers."""
    path = t.scratch("months")
    lines = t.lineitem.where("l_shipdate is not null").withColumn("month", F.month("l_shipdate"))
    for name, of_month, df in (
        ("first", F.col("month") == 1, lines.drop("l_tax")),
        ("second", F.col("month") == 2, lines.withColumn("l_linenumber", F.col("l_linenumber").cast("int"))),
        ("rest", F.col("month") > 2, lines.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))),
    ):
        sinks.write_parquet(df.where(of_month).drop("month"), f"{path}/{name}")
    found = sources.read_widened(t.spark, [f"{path}/{name}" for name in ("first", "second", "rest")])
    return as_text(found.withColumn("l_linenumber", F.col("l_linenumber").cast("long")), "l_shipdate").select(*t.lineitem.columns)


@query(
    f"""SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value, props FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1"""
)
def ingest_by_folder(t: Tables) -> DataFrame:
    """New files merged into folders by key hash; then all of them again, as after lost progress."""
    table = KeyedTable(t.spark, t.scratch("ingest-folders"), EVENT_JSON, ("user_id",), BUCKETS)
    path, progress = event_json_dir(t), t.scratch("ingest-progress")
    for known in (progress, progress, t.scratch("ingest-progress")):
        ingest.merge_new_files(table, path, EVENT_JSON, known, ORDER)
    return table.rows()


PROFILED = {"event_id": True, "user_id": True, "event_type": False}


@query(
    " UNION ALL ".join(
        f"""SELECT 'events' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
            {f"CAST(sum({c}) AS VARCHAR)" if number else "CAST(NULL AS VARCHAR)"} AS total,
            count(DISTINCT {c}) AS n_distinct, true AS estimate_holds FROM events"""
        for c, number in PROFILED.items()
    )
)
def profile_of_batches(t: Tables) -> DataFrame:
    """Two batches described one by one, the second twice; estimates are held to the exact counts within 4 %."""
    path, columns = t.scratch("profiles"), list(PROFILED)
    base, delta = base_and_delta(t)
    for name, batch in (("base", base), ("delta", delta), ("delta", delta)):
        profiles.store_profile(batch.select(*columns), path, name)
    exact = t.events.agg(*[F.count_distinct(c).alias(c) for c in columns])
    exact = exact.unpivot([], columns, "column_name", "n_distinct")
    found = profiles.stored_profile(t.spark, path, "events").join(exact, "column_name")
    holds = F.abs(F.col("n_distinct_estimate") - F.col("n_distinct")) <= 0.04 * F.col("n_distinct")
    return found.withColumn("estimate_holds", holds).drop("n_distinct_estimate")


@query(
    f"""SELECT {ORDER_ROWS} FROM orders WHERE o_custkey = (SELECT max(o_custkey) FROM orders)"""
)
def lookup_by_filter(t: Tables) -> DataFrame:
    """All orders of one customer from a table that is sorted by time: filters in the files tell which row groups to read."""
    path = t.scratch("with-filters")
    sorted_by_time = t.orders.repartitionByRange("o_orderdate").sortWithinPartitions("o_orderdate")
    sinks.write_parquet(sorted_by_time, path, bloom={"o_custkey": 1_000_000})
    last = t.orders.agg(F.max("o_custkey")).first()[0]
    return as_text(t.spark.read.parquet(path).where(F.col("o_custkey") == last), "o_orderdate")
