"""Queries on aggregation, sorting, keys, unions and quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators import analytics, dims, facts, quality
from starfold.queries.registry import Tables, query
from starfold.sinks.files import load_table, write_parquet

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MICROS_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


@query("SELECT DISTINCT p_name AS title, p_brand AS maker, p_type AS kind FROM part")
def distinct_dim(t: Tables) -> DataFrame:
    return dims.distinct_dim(t.part, {"title": "p_name", "maker": "p_brand", "kind": "p_type"})


@query(
    """SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice
       FROM orders GROUP BY o_custkey, o_orderstatus"""
)
def dedup_subset(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return dims.first_per_key(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query(f"SELECT user_id, event_type, strftime(max(ts), {MICROS_SQL}) AS last_ts FROM events GROUP BY user_id, event_type")
def group_max(t: Tables) -> DataFrame:
    grouped = t.events.groupBy("user_id", "event_type").agg(F.max("ts").alias("last_ts"))
    return grouped.withColumn("last_ts", F.date_format("last_ts", MICROS))


@query(
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day, o_orderstatus,
              CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) / count(price) AS mean_price
       FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders) GROUP BY 1, 2, 3"""
)
def group_mean_calendar(t: Tables) -> DataFrame:
    """Missing measurements (the low priority ones) do not count."""
    df = t.orders.withColumn("price", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")))
    return dims.calendar_mean(df, "o_orderdate", ["o_orderstatus"], "price", "mean_price", scale=2)


@query("SELECT l_suppkey, count(l_orderkey) AS n_lines FROM lineitem GROUP BY l_suppkey")
def count_by_group(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count("l_orderkey").alias("n_lines"))


COUNTED = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in COUNTED))
def table_counts(t: Tables) -> DataFrame:
    return quality.row_counts({name: getattr(t, name) for name in COUNTED})


@query(
    """SELECT CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS min, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS max
       FROM orders"""
)
def min_max_span(t: Tables) -> DataFrame:
    span = analytics.min_max(t.orders, "o_orderdate")
    return span.select(*[F.col(c).cast("date").cast("string").alias(c) for c in ("min", "max")])


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
            min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in DESCRIBED
    )
)
def describe_columns(t: Tables) -> DataFrame:
    return analytics.describe_long(t.lineitem, DESCRIBED)


@query(
    """SELECT CAST(sum(freq) AS BIGINT) AS n_rows, count(*) AS n_groups
       FROM (SELECT user_id, event_type, count(*) AS freq FROM events GROUP BY user_id, event_type)"""
)
def sum_of_counts(t: Tables) -> DataFrame:
    grouped = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("freq"))
    return grouped.agg(F.sum("freq").alias("n_rows"), F.count("*").alias("n_groups"))


@query("SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort_rows(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment", "c_acctbal", "c_custkey").orderBy(
        "c_mktsegment", F.desc("c_acctbal"), "c_custkey"
    )


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def topk_value(t: Tables) -> DataFrame:
    return analytics.top_k(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", 10, ["c_custkey"])


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5")
def preview_limit(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type").orderBy("event_id").limit(5)


@query(
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier
       UNION ALL SELECT 'part', p_partkey, p_name, p_retailprice FROM part"""
)
def union_all_parts(t: Tables) -> DataFrame:
    """Three tables under one set of columns; the parts list them in different orders."""
    return analytics.union_parts(
        [
            dims.project(t.customer, {"kind": F.lit("customer"), "id": "c_custkey", "name": "c_name", "amount": "c_acctbal"}),
            dims.project(t.supplier, {"amount": "s_acctbal", "name": "s_name", "kind": F.lit("supplier"), "id": "s_suppkey"}),
            dims.project(t.part, {"name": "p_name", "id": "p_partkey", "amount": "p_retailprice", "kind": F.lit("part")}),
        ]
    )


@query("SELECT row_number() OVER (ORDER BY ts, event_id) AS row_id, event_id, user_id FROM events")
def global_row_id(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts")
    return facts.with_row_id(rows, ["ts", "event_id"]).select("row_id", "event_id", "user_id")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query(f"SELECT row_number() OVER (ORDER BY {', '.join(LINE_KEY)}) - 1 AS line_id, {', '.join(LINE_KEY)} FROM lineitem")
def identity_key(t: Tables) -> DataFrame:
    """Numbers from 0; equal rows may swap numbers."""
    return facts.with_row_id(t.lineitem.select(*LINE_KEY), LINE_KEY, "line_id", start=0).select("line_id", *LINE_KEY)


@query(f"SELECT event_id, md5(CAST(user_id AS VARCHAR) || strftime(ts, {MICROS_SQL})) AS play_id FROM events")
def md5_key(t: Tables) -> DataFrame:
    df = t.events.withColumn("time_text", F.date_format("ts", MICROS))
    return facts.with_hash_key(df, ["user_id", "time_text"], "play_id").select("event_id", "play_id")


# ---- quality checks ------------------------------------------------------------------------------


def result_sql(table: str, check: str, column: str, failing: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, n AS failing_rows,
               n = 0 AS passed FROM (SELECT CAST({failing} AS BIGINT) AS n FROM {source})"""


LABELLED = "(SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query(
    " UNION ALL ".join(
        result_sql("labelled", "not_null", c, f"count(*) - count({c})", LABELLED) for c in ("doc_id", "lang", "quality")
    )
)
def dq_not_null(t: Tables) -> DataFrame:
    df = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality")
    return quality.not_null(df, "labelled", ["doc_id", "lang", "quality"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def not_null_write(t: Tables) -> DataFrame:
    """A write that fails on a null key; the given orders have none."""
    path = t.scratch("not-null")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    write_parquet(quality.enforce_not_null(rows, "orders", ["o_orderkey", "o_custkey"]), path)
    return t.spark.read.parquet(path)


@query(
    " UNION ALL ".join(
        result_sql(table, "unique_key", keys, "count(*)", f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)")
        for table, keys in (("orders", "o_orderkey"), ("lineitem", "l_orderkey,l_linenumber"))
    )
)
def dq_unique_key(t: Tables) -> DataFrame:
    return quality.union_parts(
        [
            quality.unique_key(t.orders, "orders", ["o_orderkey"]),
            quality.unique_key(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
        ]
    )


@query(
    result_sql("orders", "allowed_values", "o_orderstatus", "count(*)", "orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')")
    + " UNION ALL "
    + result_sql("events", "allowed_values", "event_type", "count(*)", "events WHERE event_type NOT IN ('view', 'click')")
)
def dq_allowed_values(t: Tables) -> DataFrame:
    return quality.union_parts(
        [
            quality.allowed(t.orders, "orders", "o_orderstatus", ["F", "O", "P"]),
            quality.allowed(t.events, "events", "event_type", ["view", "click"]),
        ]
    )


@query(
    result_sql("lineitem", "referential", "l_orderkey", "count(*)", "lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
    + " UNION ALL "
    + result_sql("documents", "referential", "doc_id", "count(*)", "documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
)
def dq_referential(t: Tables) -> DataFrame:
    return quality.union_parts(
        [
            quality.referential(t.lineitem, "lineitem", "l_orderkey", t.orders, "o_orderkey"),
            quality.referential(t.documents, "documents", "doc_id", t.labels, "doc_id"),
        ]
    )


@query(
    " UNION ALL ".join(
        f"""SELECT 'customer' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM customer"""
        for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    )
)
def table_profile(t: Tables) -> DataFrame:
    return quality.profile(t.customer.drop("c_acctbal"), "customer")


@query(
    " UNION ALL ".join(
        f"""SELECT 'customer' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS n_distinct
            FROM customer"""
        for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    )
)
def table_profile_distinct(t: Tables) -> DataFrame:
    return quality.profile(t.customer.drop("c_acctbal"), "customer", distinct="exact")


@query("SELECT 'lineitem' AS table_name, true AS has_files, true AS has_bytes, count(*) AS n_rows FROM lineitem")
def table_layout(t: Tables) -> DataFrame:
    """Files and bytes depend on the writer, so only their presence is compared."""
    found = quality.layout(t.spark, f"{t.sf_dir}/lineitem.parquet", "lineitem")
    return found.select("table_name", (F.col("n_files") > 0).alias("has_files"), (F.col("n_bytes") > 0).alias("has_bytes"), "n_rows")


@query(
    """SELECT * FROM (SELECT 'loaded' AS check_table, 'present' AS check_name, '*' AS column_name, 0::BIGINT AS failing_rows, true AS passed
       UNION ALL SELECT 'absent', 'present', '*', 1::BIGINT, false UNION ALL
       SELECT 'loaded', 'not_empty', '*', (SELECT (count(*) = 0)::BIGINT FROM supplier), (SELECT count(*) > 0 FROM supplier))"""
)
def dq_table_present(t: Tables) -> DataFrame:
    """A loaded table and one that was never loaded."""
    loaded, absent = (f"{name}_{uuid.uuid4().hex}" for name in ("loaded", "absent"))
    path = t.scratch("present")
    write_parquet(t.supplier, path)
    table = load_table(t.spark, path, "s_suppkey BIGINT, s_name STRING", loaded, location=t.scratch("table"))
    checks = [quality.present(t.spark, loaded), quality.present(t.spark, absent), quality.not_empty(table, loaded)]
    rows = quality.union_parts(checks)
    return rows.select(F.substring_index("table_name", "_", 1).alias("check_table"), *rows.columns[1:])
