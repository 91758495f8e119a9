"""Queries on joins: matching, dictionaries, nearest places, facts with dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators import analytics, facts, lookup
from starfold.operators.dims import time_dimension
from starfold.operators.joins import spread_join
from starfold.plans import listens as L
from starfold.plans.arrivals import airport_details, clean_dictionary
from starfold.queries import roles
from starfold.queries.registry import Tables, query

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MICROS_SQL = "'%Y-%m-%d %H:%M:%S.%f'"

STAR_SQL = f"""
    WITH listens AS ({roles.LISTENS_SQL}), staged AS ({roles.SONGS_SQL}),
    plays AS (SELECT * FROM listens WHERE page = 'NextSong'),
    songs AS (SELECT DISTINCT song_id, title, artist_id, year, duration FROM staged),
    artists AS (SELECT DISTINCT artist_id, artist_name AS name, artist_location, artist_latitude, artist_longitude FROM staged)
"""

FACT = ["start_time", "user_id", "session_id", "user_agent", "song_id", "artist_id"]
FACT_SQL = f"strftime(start_time, {MICROS_SQL}) AS start_time, user_id, session_id, user_agent, song_id"


def fact_rows(df: DataFrame) -> DataFrame:
    return df.select(*FACT).withColumn("start_time", F.date_format("start_time", MICROS))


def played(t: Tables) -> DataFrame:
    return L.listens(L.plays(roles.listens(t)))


@query(
    f"""{STAR_SQL} SELECT {FACT_SQL}, a.artist_id FROM plays p JOIN songs s ON p.song = s.title AND p.length = s.duration
        JOIN artists a ON p.artist = a.name"""
)
def fact_match_inner(t: Tables) -> DataFrame:
    staged = roles.songs(t)
    return fact_rows(facts.match_inner(played(t), L.songs(staged), L.artists(staged)))


@query(
    f"""{STAR_SQL} SELECT {FACT_SQL}, s.artist_id FROM plays p
        JOIN staged s ON p.song = s.title AND p.length = s.duration AND p.artist = s.artist_name"""
)
def fact_match_staging(t: Tables) -> DataFrame:
    return fact_rows(facts.match_staging(played(t), roles.songs(t)))


LEFT_FIRST_SQL = """
    , hits AS (SELECT title, name, duration, min(song_id) AS song_id, arg_min(a.artist_id, song_id) AS artist_id
               FROM songs s JOIN artists a ON s.artist_id = a.artist_id GROUP BY title, name, duration)
"""


@query(
    f"""{STAR_SQL} {LEFT_FIRST_SQL} SELECT {FACT_SQL}, artist_id FROM plays p
        LEFT JOIN hits h ON p.song = h.title AND p.length = h.duration AND p.artist = h.name"""
)
def fact_match_left_first(t: Tables) -> DataFrame:
    staged = roles.songs(t)
    return fact_rows(facts.match_left_first(played(t), L.songs(staged), L.artists(staged)))


@query(
    """SELECT event_id, user_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              dayname(ts) AS weekday FROM events"""
)
def join_time_dim(t: Tables) -> DataFrame:
    fact = t.events.select("event_id", "user_id", F.col("ts").alias("start_time"))
    joined = facts.with_time(fact, time_dimension(t.events, "ts"), ["year", "month", "weekday"])
    return joined.drop("start_time")


@query(
    f"""SELECT c_custkey,
               coalesce(CASE WHEN cit.value LIKE '%INVALID: %' OR cit.value LIKE '%No Country Code %'
                             THEN 'IN_i94cit_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW' ELSE cit.value END,
                        'NOT_IN_i94cit_DICTIONARY') AS i94cit,
               coalesce(CASE WHEN res.value LIKE '%should not show%'
                             THEN 'IN_i94res_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW' ELSE res.value END,
                        'NOT_IN_i94res_DICTIONARY') AS i94res,
               coalesce(addr.value, 'NOT_IN_i94addr_DICTIONARY') AS i94addr
        FROM customer LEFT JOIN ({roles.DICTIONARY_SQL["i94cit"]}) cit ON c_nationkey = cit.key
        LEFT JOIN ({roles.DICTIONARY_SQL["i94res"]}) res ON c_nationkey = res.key
        LEFT JOIN ({roles.DICTIONARY_SQL["i94addr"]}) addr ON c_mktsegment = addr.key"""
)
def dictionary_map(t: Tables) -> DataFrame:
    coded = t.customer.select(
        "c_custkey", F.col("c_nationkey").alias("i94cit"), F.col("c_nationkey").alias("i94res"),
        F.col("c_mktsegment").alias("i94addr"),
    )
    used = {c: clean_dictionary(d, c) for c, d in roles.dictionaries(t).items() if c in coded.columns}
    return lookup.map_codes(coded, used)


@query(
    f"""SELECT c_custkey, state, r_regionkey AS state_code FROM
        (SELECT c_custkey, CASE WHEN r.r_name <> 'ASIA' THEN {roles.initcap_sql("r.r_name")} ELSE 'Nowhere' END AS state
         FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r.r_regionkey)
        LEFT JOIN region s ON state = {roles.initcap_sql("s.r_name")}"""
)
def join_computed_key(t: Tables) -> DataFrame:
    """States in title case find their code through a dictionary in capitals."""
    people = spread_join(
        t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), roles.nation_regions(t), "n_nationkey"
    )
    state = F.when(F.col("r_name") != "ASIA", F.initcap("r_name")).otherwise("Nowhere")
    named = people.select("c_custkey", state.alias("state"))
    return lookup.lookup_name(named, "state", t.region, F.initcap("r_name"), "r_regionkey", "state_code")


@query(
    """SELECT 'K' || s_suppkey AS ident, s_name AS airport_name, CAST(CAST(s_acctbal AS DECIMAL(10, 2)) AS DOUBLE) AS longitude,
              CAST(s_suppkey AS DOUBLE) AS latitude, iso_country, CASE WHEN iso_country = 'US' THEN 'Home' WHEN iso_country = 'AF'
              THEN 'AFRICA' END AS iso_country_fullname
       FROM (SELECT *, CASE WHEN r_name IN ('AMERICA', 'ASIA', 'EUROPE') THEN 'US' ELSE substr(r_name, 1, 2) END AS iso_country
             FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
)
def join_lookup_name(t: Tables) -> DataFrame:
    """Airports with their country's name; some countries are not in the table of codes."""
    home = F.col("r_name") == "AMERICA"
    codes = t.region.filter(F.col("r_name").isin("AMERICA", "AFRICA")).select(
        F.when(home, "Home").otherwise(F.col("r_name")).alias("Name"),
        F.when(home, "US").otherwise(F.substring("r_name", 1, 2)).alias("Code"),
    )
    df = airport_details(roles.airports_raw(t), codes)
    return df.select("ident", "airport_name", "longitude", "latitude", "iso_country", "iso_country_fullname")


@query(
    """SELECT p_name AS song_title, CAST(count(l_orderkey) AS BIGINT) AS played_freq FROM lineitem JOIN part
       ON l_partkey = p_partkey GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 10"""
)
def top_played(t: Tables) -> DataFrame:
    plays = t.lineitem.select(F.col("l_orderkey").alias("songplay_id"), F.col("l_partkey").alias("song_id"))
    return analytics.top_played(plays, t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_name").alias("title")))


@query(
    """SELECT c_nationkey, n_customers, count(s_name) AS n_suppliers FROM
       (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY c_nationkey
        ORDER BY n_customers DESC, c_nationkey LIMIT 10)
       JOIN supplier ON c_nationkey = s_nationkey WHERE s_acctbal > 2000 GROUP BY c_nationkey, n_customers"""
)
def topk_then_join(t: Tables) -> DataFrame:
    return analytics.topk_then_join(
        t.customer, "c_nationkey", t.supplier, "s_nationkey", F.col("s_acctbal") > 2000, "s_name",
        n_fact="n_customers", n_dim="n_suppliers",
    )


def orders_by_place(t: Tables) -> DataFrame:
    """Orders per nation and month, counted per customer before the customer is joined."""
    month = F.month("o_orderdate").alias("month")
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), month).agg(F.count("*").alias("n"))
    return spread_join(per_customer, t.customer.select("c_custkey", F.col("c_nationkey").alias("place")), "c_custkey")


@query(
    """SELECT place, n_orders, n_suppliers, balance FROM
       (SELECT c_nationkey AS place, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
       JOIN (SELECT s_nationkey AS place, count(*) AS n_suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
             FROM supplier GROUP BY 1) USING (place)"""
)
def fact_place(t: Tables) -> DataFrame:
    dim = t.supplier.withColumnRenamed("s_nationkey", "place")
    measures = {
        "n_suppliers": F.count("*"),
        "balance": F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double"),
    }
    return analytics.fact_by_place(orders_by_place(t), dim, "place", measures, n_fact="n_orders", weight="n")


@query(
    """SELECT place, month, n_orders, n_lines FROM
       (SELECT c_nationkey AS place, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
       JOIN (SELECT s_nationkey AS place, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n_lines
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) USING (place, month)"""
)
def fact_place_month(t: Tables) -> DataFrame:
    month = F.month("l_shipdate").alias("month")
    per_supplier = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey"), month).agg(F.count("*").alias("m"))
    shipped = spread_join(per_supplier, t.supplier.select("s_suppkey", F.col("s_nationkey").alias("place")), "s_suppkey")
    return analytics.fact_by_place(
        orders_by_place(t), shipped, "place", {"n_lines": F.sum("m")}, month="month", n_fact="n_orders", weight="n"
    )


def unit_sql(prefix: str) -> str:
    return f"""cos(radians({prefix}lat)) * cos(radians({prefix}lon)) AS {prefix}x,
               cos(radians({prefix}lat)) * sin(radians({prefix}lon)) AS {prefix}y, sin(radians({prefix}lat)) AS {prefix}z"""


@query(
    f"""WITH c AS (SELECT c_custkey, c_acctbal * 0.0085e0 AS plat, (c_custkey * 37 % 3600) / 10e0 - 180e0 AS plon FROM customer),
        s AS (SELECT place_id, admin1, lat AS slat, lon AS slon FROM ({roles.GAZETTEER_SQL})),
        p AS (SELECT *, {unit_sql("p")} FROM c), g AS (SELECT *, {unit_sql("s")} FROM s)
        SELECT c_custkey, place_id, admin1 AS state FROM
        (SELECT c_custkey, place_id, admin1, row_number() OVER (PARTITION BY c_custkey ORDER BY
                (px - sx) * (px - sx) + (py - sy) * (py - sy) + (pz - sz) * (pz - sz), place_id) AS rn FROM p CROSS JOIN g)
        WHERE rn = 1"""
)
def nearest_region(t: Tables) -> DataFrame:
    points = t.customer.select(
        "c_custkey",
        (F.col("c_acctbal") * 0.0085).alias("lat_deg"),
        (F.col("c_custkey") * 37 % 3600 / 10.0 - 180.0).alias("lon_deg"),
    )
    sites = roles.gazetteer(t).withColumnRenamed("place_id", "site_id")
    found = lookup.nearest_site(points, sites, "lat_deg", "lon_deg", {"site_id": "place_id", "admin1": "state"})
    return found.drop("lat_deg", "lon_deg")
