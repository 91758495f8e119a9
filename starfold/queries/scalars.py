"""Queries on projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions import dates, geo, labels
from starfold.operators import analytics
from starfold.operators.dims import project, time_dimension
from starfold.operators.joins import spread_join
from starfold.queries.registry import Tables, query
from starfold.sinks.files import clustered, write_parquet

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MICROS_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


def labelled(t: Tables) -> DataFrame:
    """Documents with the quality label that only some of them have."""
    return spread_join(t.documents.select("doc_id", "lang", "source", "n_chars"), t.labels, "doc_id", "left")


@query("SELECT p_partkey AS part_id, p_name AS title, p_brand AS maker, p_retailprice AS price FROM part")
def project_rename(t: Tables) -> DataFrame:
    return project(t.part, {"part_id": "p_partkey", "title": "p_name", "maker": "p_brand", "price": "p_retailprice"})


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(t: Tables) -> DataFrame:
    return t.customer.drop("c_acctbal", "c_mktsegment")


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_equals(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def filter_since(t: Tables) -> DataFrame:
    since = F.lit("2000-01-01").cast("timestamp_ntz")
    return t.orders.filter(F.col("o_orderdate") >= since).select("o_orderkey", "o_totalprice")


@query(
    """SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE quality IS NOT NULL AND toxic IS NOT NULL"""
)
def filter_not_null(t: Tables) -> DataFrame:
    kept = labelled(t).filter(F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    return kept.select("doc_id", "lang", "quality", "toxic")


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_linenumber = 4 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def point_lookup(t: Tables) -> DataFrame:
    """Item 4 of every urgent order: a composite-key lookup for a whole table of keys."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    wanted = urgent.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(4).alias("l_linenumber"))
    return analytics.keyed_lookup(
        t.lineitem, wanted, ["l_orderkey", "l_linenumber"],
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"],
    )


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey = 1 AND l_linenumber = 3")
def point_lookup_literal(t: Tables) -> DataFrame:
    """One composite key of a table clustered by it; the scan skips the files and row groups of other keys."""
    path = t.scratch("clustered-lines")
    keys = ["l_orderkey", "l_linenumber"]
    write_parquet(clustered(t.lineitem, "l_orderkey", keys), path)
    return analytics.point_lookup(
        t.spark.read.parquet(path), {"l_orderkey": 1, "l_linenumber": 3},
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"],
    )


@query(
    """SELECT conv_id, turn, role, text FROM conversations
       WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system') ORDER BY conv_id, turn"""
)
def keyed_range_ordered(t: Tables) -> DataFrame:
    """All turns, in order, of every conversation that has a system turn."""
    wanted = t.conversations.filter(F.col("role") == "system").select("conv_id")
    return analytics.keyed_lookup(
        t.conversations, wanted, ["conv_id"], ["conv_id", "turn", "role", "text"], ["conv_id", "turn"]
    )


@query(
    """SELECT p_partkey, CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'bolt') OR contains(p_name, 'nut')
              THEN 'IN_p_name_BUT_UNUSABLE' ELSE p_name END AS label FROM part"""
)
def remap_invalid_labels(t: Tables) -> DataFrame:
    label = labels.remap_matching(F.col("p_name"), ["ring", "bolt", "nut"], "IN_p_name_BUT_UNUSABLE")
    return t.part.select("p_partkey", label.alias("label"))


@query(
    """SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), 'NOT_IN_quality_DICTIONARY') AS quality
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def fill_sentinel(t: Tables) -> DataFrame:
    filled = labels.fill_sentinel(F.col("quality").cast("string"), "quality")
    return labelled(t).select("doc_id", filled.alias("quality"))


@query(
    """SELECT o_orderkey, CAST(CAST(trunc(o_totalprice) AS INTEGER) AS VARCHAR) AS price_id,
              CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders"""
)
def cast_chain(t: Tables) -> DataFrame:
    priority = labels.code(F.substring("o_orderpriority", 1, 1).cast("double"))
    return t.orders.select("o_orderkey", labels.id_text(F.col("o_totalprice")).alias("price_id"), priority.alias("priority"))


@query(
    """SELECT CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS null_ratio
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def null_ratio(t: Tables) -> DataFrame:
    return analytics.null_ratio(labelled(t), "quality")


@query(
    """SELECT c_custkey, concat_ws(', ', upper(c_name), CASE WHEN r_name <> 'ASIA' THEN upper(substr(r_name, 1, 2)) END)
              AS place FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def place_key(t: Tables) -> DataFrame:
    places = spread_join(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, "r_regionkey")
    df = spread_join(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), places, "n_nationkey")
    state = F.when(F.col("r_name") != "ASIA", F.lower(F.substring("r_name", 1, 2)))
    return df.select("c_custkey", labels.place_key(F.col("c_name"), state).alias("place"))


@query("SELECT o_orderkey, string_split(o_orderpriority, '-')[2] AS priority, string_split(o_orderpriority, '-')[3] AS none FROM orders")
def split_item(t: Tables) -> DataFrame:
    c = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", labels.split_item(c, "-", 1).alias("priority"), labels.split_item(c, "-", 2).alias("none")
    )


@query(
    """SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(10, 2)) AS DOUBLE) AS lon,
              CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_custkey AS DOUBLE) END AS lat FROM customer"""
)
def split_coordinates(t: Tables) -> DataFrame:
    """Coordinate texts; one segment's have no latitude."""
    lat = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey").cast("string"))
    text = F.concat_ws(", ", F.col("c_acctbal").cast("decimal(10,2)").cast("string"), lat)
    lon, lat = geo.lon_lat(F.col("coordinates"))
    return t.customer.select("c_custkey", text.alias("coordinates")).select("c_custkey", lon.alias("lon"), lat.alias("lat"))


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN size
              WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN -size END AS degrees
       FROM (SELECT *, CAST(abs(CAST(c_acctbal AS DECIMAL(10, 2))) AS DOUBLE) AS size FROM customer)"""
)
def parse_hemisphere(t: Tables) -> DataFrame:
    """A segment per hemisphere letter; the remaining one has a letter that is none."""
    segment = F.col("c_mktsegment")
    letter = (
        F.when(segment == "HOUSEHOLD", "N").when(segment == "FURNITURE", "E")
        .when(segment == "MACHINERY", "S").when(segment == "AUTOMOBILE", "W").otherwise("X")
    )
    text = F.concat(F.abs(F.col("c_acctbal").cast("decimal(10,2)")).cast("string"), letter)
    return t.customer.select("c_custkey", geo.signed_degrees(text).alias("degrees"))


@query("SELECT c_custkey, regexp_replace(c_name, '[#0]', '', 'g') AS name FROM customer")
def regex_strip(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", labels.strip_pattern(F.col("c_name"), "[#0]").alias("name"))


@query(
    f"""SELECT strftime(ts, {MICROS_SQL}) AS start_time, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
              CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
              dayname(ts) AS weekday FROM (SELECT DISTINCT ts FROM events)""",
    name="time_dimension",
)
def calendar(t: Tables) -> DataFrame:
    df = time_dimension(t.events, "ts")
    return df.withColumn("start_time", F.date_format("start_time", MICROS))


@query("SELECT event_id, CAST(dayofweek(ts) AS INTEGER) AS weekday FROM events")
def weekday_number(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.weekday_number(F.col("ts")).alias("weekday"))


@query(
    """SELECT event_id, CAST(hour(ts) AS VARCHAR) AS hour, CAST(week(ts) AS VARCHAR) AS week, dayname(ts) AS weekday
       FROM events"""
)
def map_explode_fields(t: Tables) -> DataFrame:
    mapped = t.events.select("event_id", dates.time_map(F.col("ts")).alias("m"))
    return mapped.select("event_id", *[F.col("m")[k].alias(k) for k in ("hour", "week", "weekday")])


@query("SELECT event_id, strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S.%g') AS start_time FROM events")
def epoch_millis_text(t: Tables) -> DataFrame:
    millis = t.events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return millis.select("event_id", dates.millis_text(F.col("ms")).alias("start_time"))


@query(
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN DATE '1960-01-01' + CAST(20000 + o_custkey AS INTEGER)
              ELSE DATE '1960-01-01' END AS VARCHAR) AS day FROM orders"""
)
def sas_date(t: Tables) -> DataFrame:
    number = F.when(F.col("o_orderstatus") != "P", (F.col("o_custkey") + 20000).cast("double") + 0.5)
    return t.orders.select("o_orderkey", dates.sas_date(number).cast("string").alias("day"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN l_returnflag = 'R' THEN DATE '1960-01-01'
              ELSE CAST(l_shipdate AS DATE) END AS VARCHAR) AS day FROM lineitem"""
)
def parse_date_sentinel(t: Tables) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "R", "D/S").otherwise(F.date_format("l_shipdate", "MMddyyyy"))
    day = dates.parse_date(text, "MMddyyyy").cast("string")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", day.alias("day"))
