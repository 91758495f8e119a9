"""Queries on sources, sinks and keyed writes. Each writes the whole given tables, then reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold import schemas
from starfold.operators import keyed
from starfold.queries import roles
from starfold.queries.registry import Tables, query
from starfold.sinks import files as sinks
from starfold.sources import files as sources
from starfold.streaming import ingest

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MICROS_SQL = "'%Y-%m-%d %H:%M:%S.%f'"
EVENT_ROWS = f"event_id, strftime(ts, {MICROS_SQL}) AS ts, user_id, event_type, value, props"
EVENT_JSON = "event_id BIGINT, ts BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def as_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, MICROS) for c in cols})


def event_json_dir(t: Tables) -> str:
    """Events as JSON with epoch-millisecond times, in folders by type and day."""

    def write(path: str) -> None:
        df = t.events.withColumns(
            {"ts": F.unix_millis(F.col("ts").cast("timestamp")), "kind": F.col("event_type"), "day": F.to_date("ts")}
        )
        sinks.write_json(df, path, ["kind", "day"])

    return t.staged("event-json", write)


@query("SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value, props FROM events")
def json_scan(t: Tables) -> DataFrame:
    return sources.read_json(t.spark, f"{event_json_dir(t)}/*/*/*.json", EVENT_JSON)


@query(
    """SELECT event_id AS play_id, strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S.%g') AS start_time, user_id AS listener,
              event_type AS page FROM events"""
)
def stage_mapped(t: Tables) -> DataFrame:
    mapping = {"play_id": "event_id", "start_time": "ts", "listener": "user_id", "page": "event_type"}
    df = sources.stage(t.spark, event_json_dir(t), EVENT_JSON, mapping, ["start_time"], recursive=True)
    return df.withColumn("start_time", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSS"))


@query(f"SELECT event_id, strftime(epoch_ms(epoch_us(ts) // 1000), {MICROS_SQL}) AS start_time FROM events")
def epoch_millis_to_ts(t: Tables) -> DataFrame:
    millis = t.events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return as_text(millis.select("event_id", F.timestamp_millis("ms").alias("start_time")), "start_time")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(t: Tables) -> DataFrame:
    path = t.scratch("csv-scan")
    sinks.write_csv(t.customer, path, quote_all=False, sep=";", encoding=sources.LATIN_1)
    schema = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    return sources.read_csv(t.spark, path, schema, sep=";")


@query(
    f"""SELECT artist, first_name AS "firstName", gender, item AS "itemInSession", last_name AS "lastName", length, level,
               location, session_id AS "sessionId", song, CAST(user_id AS BIGINT) AS "userId"
        FROM ({roles.LISTENS_SQL}) WHERE artist IS NOT NULL"""
)
def csv_consolidate(t: Tables) -> DataFrame:
    return sources.consolidate_csv(
        t.spark, roles.event_csv_dir(t), schemas.EVENT_CSV, schemas.EVENT_COLUMNS, require="artist"
    )


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def parquet_projection(t: Tables) -> DataFrame:
    return sources.read_parquet(t.spark, f"{t.sf_dir}/part.parquet", columns=["p_partkey", "p_name", "p_retailprice"])


@query(
    """SELECT event_id, user_id, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-17'"""
)
def run_date_slice(t: Tables) -> DataFrame:
    return sources.slice_by_run_date(t.events, "ts", "2024-01-16").select("event_id", "user_id", "event_type", "value")


def monthly_lines(t: Tables) -> str:
    def write(path: str) -> None:
        sinks.write_parquet(t.lineitem.withColumn("part_month", F.month("l_shipdate")), path, ["part_month"])

    return t.staged("monthly-lines", write)


LINE_ROWS = f"""l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                l_returnflag, l_linestatus, strftime(l_shipdate, {MICROS_SQL}) AS l_shipdate"""


@query(f"SELECT {LINE_ROWS} FROM lineitem")
def multi_file_scan(t: Tables) -> DataFrame:
    """Every monthly folder there is, that of lines without a date too, as one scan."""
    path = monthly_lines(t)
    months = t.spark.read.parquet(path).select("part_month").distinct().collect()  # a row per folder
    folders = [m[0] if m[0] is not None else "__HIVE_DEFAULT_PARTITION__" for m in months]
    return as_text(sources.read_parquet(t.spark, *[f"{path}/part_month={m}" for m in folders]), "l_shipdate")


def dated_orders(t: Tables) -> DataFrame:
    return as_text(t.orders, "o_orderdate").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})


ORDER_ROWS = f"""o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {MICROS_SQL}) AS o_orderdate,
                 o_orderpriority"""
ORDER_DATED = f"""{ORDER_ROWS}, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"""


@query(f"SELECT {ORDER_DATED} FROM orders")
def partitioned_write(t: Tables) -> DataFrame:
    path = t.scratch("partitioned")
    df = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    sinks.write_parquet(df, path, ["year", "month"])
    return as_text(t.spark.read.parquet(path), "o_orderdate")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_overwrite(t: Tables) -> DataFrame:
    """The second write replaces the first."""
    path = t.scratch("overwrite")
    sinks.write_parquet(t.part.withColumn("p_size", F.lit(0)), path)
    sinks.write_parquet(t.part, path)
    return t.spark.read.parquet(path)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_quote_all(t: Tables) -> DataFrame:
    path = t.scratch("quoted")
    sinks.write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return sources.read_csv(
        t.spark, path, "c_custkey STRING, c_name STRING, c_mktsegment STRING", encoding="UTF-8"
    )


@query("SELECT s_name, s_suppkey, s_nationkey, s_acctbal FROM supplier")
def table_load(t: Tables) -> DataFrame:
    """Files whose columns lie in another order are added to a table, which a second load replaces."""
    path, table = t.scratch("load"), f"supplier_{uuid.uuid4().hex}"
    sinks.write_parquet(t.supplier.select("s_acctbal", "s_nationkey", "s_suppkey", "s_name"), path)
    schema, location = "s_name STRING, s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE", t.scratch("table")
    sinks.load_table(t.spark, path, schema, table, location=location)
    return sinks.load_table(t.spark, path, schema, table, mode="replace", location=location)


@query(
    """SELECT event_id AS "EVENT_ID", strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S.%g') AS "Ts", user_id AS "USER_ID",
              event_type AS "Event_Type" FROM events"""
)
def stage_any_case(t: Tables) -> DataFrame:
    """Staged by names that differ from the keys in their case; a malformed line would fail the load."""
    schema = "EVENT_ID BIGINT, Ts BIGINT, USER_ID BIGINT, Event_Type STRING"
    df = sources.stage(t.spark, event_json_dir(t), schema, millis_cols=["Ts"], recursive=True, strict=True)
    return df.withColumn("Ts", F.date_format("Ts", "yyyy-MM-dd HH:mm:ss.SSS"))


@query("SELECT c_custkey, n_name || chr(10) || c_name AS label FROM customer JOIN nation ON c_nationkey = n_nationkey")
def csv_line_breaks(t: Tables) -> DataFrame:
    """Texts with line breaks, written as CSV and consolidated again."""
    path = t.scratch("line-breaks")
    label = F.concat("n_name", F.lit("\n"), "c_name").alias("label")
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", label)
    sinks.write_csv(named, path)
    return sources.consolidate_csv(
        t.spark, path, "c_custkey BIGINT, label STRING", ["c_custkey", "label"], require="label", multi_line=True
    )


@query("SELECT n_nationkey, n_name, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey UNION ALL SELECT n_nationkey, n_name, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey")
def append_insert(t: Tables) -> DataFrame:
    """Insert-select twice: rows repeat, as appends do."""
    path = t.scratch("append")
    df = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey")).select("n_nationkey", "n_name", "c_custkey")
    for _ in range(2):
        sinks.write_parquet(df, path, mode="append")
    return t.spark.read.parquet(path)


@query(f"SELECT {ORDER_DATED} FROM orders")
def full_refresh(t: Tables) -> DataFrame:
    """Loading everything and then one status' partitions again leaves each row once."""
    path = t.scratch("refresh")
    df = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    sinks.write_parquet(df, path, ["year", "o_orderstatus"])
    sinks.write_parquet(df.filter(F.col("o_orderstatus") == "F"), path, ["year", "o_orderstatus"], dynamic=True)
    return as_text(t.spark.read.parquet(path), "o_orderdate")


@query(
    """SELECT l_suppkey, count(*) AS n, CAST(min(l_shipdate) AS DATE)::VARCHAR AS first_day,
              CAST(max(l_shipdate) AS DATE)::VARCHAR AS last_day FROM lineitem GROUP BY l_suppkey"""
)
def clustered_layout(t: Tables) -> DataFrame:
    path = t.scratch("clustered")
    sinks.write_parquet(sinks.clustered(t.lineitem, "l_suppkey", ["l_suppkey", "l_shipdate"]), path)
    return t.spark.read.parquet(path).groupBy("l_suppkey").agg(
        F.count("*").alias("n"),
        F.min("l_shipdate").cast("date").cast("string").alias("first_day"),
        F.max("l_shipdate").cast("date").cast("string").alias("last_day"),
    )


# ---- keyed writes: even events are the table, odd ones the batch, so many of the batch are older ----


def base_and_delta(t: Tables) -> tuple[DataFrame, DataFrame]:
    even = F.col("event_id") % 2 == 0
    return t.events.filter(even), t.events.filter(~even | F.col("event_id").isNull())


ORDER = ["ts", "event_id"]


@query(
    f"""SELECT user_id, arg_min(props, (event_id % 2, ts, event_id)) AS props, arg_max(event_type, (ts, event_id)) AS event_type,
               strftime(max(ts), {MICROS_SQL}) AS ts, arg_max(event_id, (ts, event_id)) AS event_id
        FROM events GROUP BY user_id"""
)
def upsert_partial_update(t: Tables) -> DataFrame:
    """Applied twice, as after a restart."""
    base, delta = base_and_delta(t)
    first = keyed.first_per_key(base, ["user_id"], ORDER)
    out = first.limit(0)
    for batch in (base, delta, delta):
        out = keyed.upsert_partial(out, batch, ["user_id"], ORDER, last_wins=["event_type"], first_wins=["props"])
    return as_text(out, "ts")


@query(
    f"""SELECT {EVENT_ROWS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1"""
)
def latest_per_key(t: Tables) -> DataFrame:
    base, delta = base_and_delta(t)
    return as_text(
        keyed.upsert_full(keyed.latest_per_key(base, ["user_id"], ORDER), delta, ["user_id"], ORDER), "ts"
    )


@query(
    f"""SELECT {EVENT_ROWS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2, ts, event_id) AS rn
        FROM events) WHERE rn = 1"""
)
def insert_if_absent(t: Tables) -> DataFrame:
    base, delta = base_and_delta(t)
    keys = ["user_id", "event_type"]
    return as_text(keyed.insert_if_absent(keyed.first_per_key(base, keys, ORDER), delta, keys, ORDER), "ts")


@query(
    f"""SELECT event_type, user_id, strftime(ts, {MICROS_SQL}) AS ts, value FROM
        (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1 AND event_type = 'purchase'"""
)
def query_table_user_song(t: Tables) -> DataFrame:
    """The last row of each (type, user), then all users of one type."""
    rows = keyed.latest_per_key(t.events, ["event_type", "user_id"], ORDER)
    return as_text(rows.filter(F.col("event_type") == "purchase").select("event_type", "user_id", "ts", "value"), "ts")


@query(
    f"""SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value, props FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1"""
)
def incremental_ingest(t: Tables) -> DataFrame:
    """Two sources feed one table in several batches; a second run of each finds nothing new."""
    table, path = t.scratch("ingest-table"), event_json_dir(t)
    kinds = sorted(row[0] for row in t.spark.read.schema("kind STRING").json(path).select("kind").distinct().collect())
    progress = {kind: t.scratch("ingest-progress") for kind in kinds[:2]}
    later = ",".join(kinds[1:])
    sources_of = {kinds[0]: f"{path}/kind={kinds[0]}", **({kinds[1]: f"{path}/kind={{{later}}}"} if later else {})}
    for _ in range(2):
        for kind, source in sources_of.items():
            ingest.ingest_new_files(t.spark, source, EVENT_JSON, table, progress[kind], ["user_id"], ORDER)
    return ingest.current_rows(t.spark, table, ["user_id"], ORDER, EVENT_JSON)
