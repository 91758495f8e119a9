"""Queries on whole builds: inputs in their file formats, the build, then a table it wrote."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold import schemas
from starfold.plans import arrivals, daily, keyed, lake, query_tables, warehouse
from starfold.plans.listens import SONGPLAYS, latest_users, plays
from starfold.queries import roles
from starfold.queries.joins import LEFT_FIRST_SQL, MICROS, MICROS_SQL, STAR_SQL
from starfold.queries.registry import Tables, query
from starfold.sinks.files import open_table, write_json, write_parquet
from starfold.sources.files import read_json

OTHERS = ["user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]
TEXT_TIME = f"strftime(start_time, {MICROS_SQL}) AS start_time"
INNER_SQL = f"""
    {STAR_SQL}, fact AS (
        SELECT start_time, user_id, level, s.song_id, a.artist_id, session_id, location, user_agent FROM plays p
        JOIN songs s ON p.song = s.title AND p.length = s.duration JOIN artists a ON p.artist = a.name)
"""
NUMBER = f"row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in SONGPLAYS)})"


def text_time(df: DataFrame, col: str = "start_time") -> DataFrame:
    return df.withColumn(col, F.date_format(col, MICROS))


@query(
    f"""{INNER_SQL} SELECT {NUMBER} AS songplay_id, {TEXT_TIME}, {', '.join(OTHERS)},
        CAST(year(fact.start_time) AS INTEGER) AS year, CAST(month(fact.start_time) AS INTEGER) AS month FROM fact"""
)
def build_lake(t: Tables) -> DataFrame:
    return text_time(lake.run_lake(t.spark, roles.listen_dir(t), t.scratch("lake")))


@query(
    f"""{STAR_SQL} SELECT user_id, arg_max(first_name, (start_time, level)) AS first_name,
        arg_max(last_name, (start_time, level)) AS last_name, arg_max(gender, (start_time, level)) AS gender,
        arg_max(level, (start_time, level)) AS level FROM plays GROUP BY user_id"""
)
def build_lake_latest_users(t: Tables) -> DataFrame:
    log = read_json(t.spark, f"{roles.listen_dir(t)}/log_data", schemas.LISTEN_LOG, recursive=True)
    out = t.scratch("latest-users")
    write_parquet(latest_users(plays(log)), out)
    return t.spark.read.parquet(out)


@query(f"{INNER_SQL} SELECT {NUMBER} - 1 AS songplay_id, {TEXT_TIME}, {', '.join(OTHERS)} FROM fact")
def build_warehouse(t: Tables) -> DataFrame:
    mapping = {c: c for c in schemas.names(schemas.LISTEN_LOG)}
    return text_time(warehouse.run_warehouse(t.spark, roles.listen_dir(t), t.scratch("warehouse"), mapping))


@query(
    f"""{INNER_SQL} SELECT {TEXT_TIME}, CAST(hour(s) AS INTEGER) AS hour, CAST(day(s) AS INTEGER) AS day,
        CAST(week(s) AS INTEGER) AS week, CAST(month(s) AS INTEGER) AS month, CAST(year(s) AS INTEGER) AS year,
        dayname(s) AS weekday FROM (SELECT DISTINCT start_time, start_time AS s FROM fact)"""
)
def build_warehouse_time(t: Tables) -> DataFrame:
    out = t.scratch("warehouse")
    warehouse.run_warehouse(t.spark, roles.listen_dir(t), out)
    return text_time(t.spark.read.parquet(f"{out}/time"))


def log_batches(t: Tables) -> list[list[str]]:
    """Every folder of the log there is, that of listens without a time first, in two batches by time."""
    years = t.spark.read.schema("log_year STRING").json(f"{roles.listen_dir(t)}/log_data").select("log_year").distinct()
    found = sorted((row[0] is not None, row[0] or "__HIVE_DEFAULT_PARTITION__") for row in years.collect())  # a row per folder
    folders = [f"log_data/log_year={year}" for _, year in found]
    middle = (len(folders) + 1) // 2
    return [batch for batch in (folders[:middle], folders[middle:]) if batch]


DISTINCT_PLAYS = """
    , once AS (SELECT DISTINCT start_time, user_id, level, session_id, location, user_agent, song, artist, length, item,
                      first_name, last_name, gender FROM plays)
"""


@query(
    f"""{STAR_SQL} {LEFT_FIRST_SQL} {DISTINCT_PLAYS}, fact AS (
        SELECT start_time, user_id, level, h.song_id, h.artist_id, session_id, location, user_agent FROM once p
        LEFT JOIN hits h ON p.song = h.title AND p.length = h.duration AND p.artist = h.name)
        SELECT {NUMBER} AS songplay_id, {TEXT_TIME}, {', '.join(OTHERS)} FROM fact"""
)
def build_keyed(t: Tables) -> DataFrame:
    """Two batches; the second one starts from the first one's tables."""
    out = t.scratch("keyed")
    for batch, folders in enumerate(log_batches(t)):
        keyed.run_keyed(t.spark, roles.listen_dir(t), out, batch, folders)
    return text_time(keyed.songplays(t.spark, out))


@query(
    f"""{STAR_SQL} SELECT user_id, arg_min(first_name, k) AS first_name, arg_min(last_name, k) AS last_name,
        arg_min(gender, k) AS gender, arg_max(level, k) AS level
        FROM (SELECT *, (start_time, session_id, item, level) AS k FROM plays) GROUP BY user_id"""
)
def build_keyed_users(t: Tables) -> DataFrame:
    """The older log comes last, and is loaded twice, as after a failed run."""
    out = t.scratch("keyed")
    batches = log_batches(t)[::-1]
    for batch, folders in [*enumerate(batches), (len(batches) - 1, batches[-1])]:
        keyed.run_keyed(t.spark, roles.listen_dir(t), out, batch, folders)
    return keyed.users(t.spark, out)


@query(
    f"""{STAR_SQL} SELECT md5(CAST(session_id AS VARCHAR) || strftime(p.start_time, '%Y-%m-%d %H:%M:%S.%g')) AS songplay_id,
        {TEXT_TIME}, user_id, level, s.song_id, s.artist_id, session_id, location, user_agent FROM plays p
        JOIN staged s ON p.song = s.title AND p.length = s.duration AND p.artist = s.artist_name"""
)
def build_daily(t: Tables) -> DataFrame:
    """Loaded twice, as a retried run would: the second load replaces the first."""
    out = t.scratch("daily")
    for _ in range(2):
        fact = daily.run_daily(t.spark, roles.listen_dir(t), out)
    return text_time(fact)


def dated_listen_dir(t: Tables) -> str:
    """Songs, and the whole log as the files of two run dates."""

    def write(path: str) -> None:
        write_json(roles.songs(t).withColumn("shelf", F.col("artist_id")), f"{path}/song_data", ["shelf"], compression="gzip")
        even = F.month(F.timestamp_millis(roles.heard_at())) % 2 == 0
        day = F.when(even, F.lit(str(RUN_DATES[0]))).otherwise(F.lit(str(RUN_DATES[1])))
        roles.write_listens(roles.heard_lines(t), f"{path}/log_data", {"run": day})

    return t.staged("dated-listens", write)


RUN_DATES = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))


@query(
    f"""{STAR_SQL} SELECT md5(CAST(session_id AS VARCHAR) || strftime(p.start_time, '%Y-%m-%d %H:%M:%S.%g')) AS songplay_id,
        {TEXT_TIME}, user_id, level, s.song_id, s.artist_id, session_id, location, user_agent FROM plays p
        JOIN staged s ON p.song = s.title AND p.length = s.duration AND p.artist = s.artist_name"""
)
def build_daily_dated(t: Tables) -> DataFrame:
    """Two run dates, the first one loaded again after the second."""
    out = t.scratch("daily-dated")
    for run_date in (*RUN_DATES, RUN_DATES[0]):
        daily.run_daily(t.spark, dated_listen_dir(t), out, run_date, "log_data/run={run_date:%Y-%m-%d}")
    return text_time(t.spark.read.parquet(f"{out}/songplays").drop("load_date"))


LAST_SQL = "WITH listens AS ({listens}) SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM listens WHERE artist IS NOT NULL) WHERE rn = 1"


def last_sql(cols: str, keys: str, order: list[str]) -> str:
    return LAST_SQL.format(listens=roles.LISTENS_SQL, cols=cols, keys=keys, order=", ".join(f"{c} DESC" for c in order))


def built_query_table(t: Tables, table: str) -> DataFrame:
    built = query_tables.run_query_tables(t.spark, roles.event_csv_dir(t), t.scratch("query-tables"))
    return built[table]


@query(
    last_sql(
        "session_id, item AS item_in_session, artist, song AS song_title, CAST(length AS DOUBLE) AS length",
        "session_id, item", ["start_time", "artist", "song", "length"],
    )
)
def build_session_items(t: Tables) -> DataFrame:
    """Every (session, item) with what was heard."""
    return built_query_table(t, "session_items").withColumn("length", F.col("length").cast("double"))


@query(
    last_sql(
        "CAST(user_id AS BIGINT) AS user_id, session_id, item AS item_in_session, song AS song_title, artist, first_name, last_name",
        "user_id, session_id, item", ["start_time", "song", "artist", "first_name", "last_name"],
    )
)
def build_user_sessions(t: Tables) -> DataFrame:
    """Every user's sessions, in the order of their items."""
    return built_query_table(t, "user_sessions").orderBy("user_id", "session_id", "item_in_session")


@query(
    last_sql(
        "song AS song_title, CAST(user_id AS BIGINT) AS user_id, first_name, last_name",
        "song, user_id", ["start_time", "first_name", "last_name"],
    )
)
def build_song_users(t: Tables) -> DataFrame:
    """Every song's listeners, each once."""
    return built_query_table(t, "song_users")


# ---- arrivals --------------------------------------------------------------------------------------


def clean_dir(t: Tables) -> str:
    """The cleaned arrivals tables; the measurements lie before the usual first date."""

    def write(path: str) -> None:
        arrivals.run_arrivals(t.spark, roles.arrivals_dir(t), path, since=dt.date(1996, 1, 1), scale=2)

    return t.staged("arrivals-clean", write)


def loaded_arrivals(t: Tables) -> dict[str, DataFrame]:
    """The tables that the cleaned files were loaded into, once per session."""

    def load(path: str) -> None:
        arrivals.load_arrivals(t.spark, clean_dir(t), f"arrivals_{uuid.uuid4().hex}_", location=path)

    path = t.staged("arrivals-loaded", load)
    return {name: open_table(t.spark, f"{path}/{name}", schema) for name, schema in arrivals.TABLE_SCHEMAS.items()}


def dictionary_label(col: str, alias: str, bad: str, sentinel: str) -> str:
    return f"""coalesce(CASE WHEN {bad.format(v=f'{alias}.value')} THEN '{sentinel}' ELSE {alias}.value END,
               'NOT_IN_{col}_DICTIONARY') AS {col}"""


BAD_COUNTRY = "contains({v}, 'INVALID: ') OR contains({v}, 'No Country Code ') OR contains({v}, 'should not show')"
D = roles.DICTIONARY_SQL
CLEAN_FACT_SQL = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS cicid, CAST(yr AS INTEGER) AS i94yr, CAST(mon AS INTEGER) AS i94mon,
           {dictionary_label('i94cit', 'ci', BAD_COUNTRY, 'IN_i94cit_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW')},
           {dictionary_label('i94res', 're', BAD_COUNTRY, 'IN_i94res_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW')},
           {dictionary_label('i94port', 'po', "contains({v}, 'No PORT Code ')", 'IN_i94port_DICTIONARY_BUT_NO_PORT_CODE')},
           CAST(arr AS VARCHAR) AS arrdate, coalesce(mo.value, 'NOT_IN_i94mode_DICTIONARY') AS i94mode,
           coalesce(ad.value, 'NOT_IN_i94addr_DICTIONARY') AS i94addr,
           CAST(coalesce(dep, DATE '1960-01-01') AS VARCHAR) AS depdate, bir AS i94bir,
           coalesce(vi.value, 'NOT_IN_i94visa_DICTIONARY') AS i94visa, CAST(adfile AS VARCHAR) AS dtadfile,
           CAST(addto AS VARCHAR) AS dtaddto, o_totalprice AS admnum
    FROM ({roles.ARRIVALS_RAW_SQL}) a LEFT JOIN ({D['i94cit']}) ci ON cit = ci.key LEFT JOIN ({D['i94res']}) re ON res = re.key
    LEFT JOIN ({D['i94port']}) po ON port = po.key LEFT JOIN ({D['i94mode']}) mo ON mode = mo.key
    LEFT JOIN ({D['i94addr']}) ad ON addr = ad.key LEFT JOIN ({D['i94visa']}) vi ON visa = vi.key
"""


@query(CLEAN_FACT_SQL)
def build_arrivals(t: Tables) -> DataFrame:
    fact = loaded_arrivals(t)["i94_immigration"]
    texts = {c: F.col(c).cast("string") for c in ("arrdate", "depdate", "dtadfile", "dtaddto")}
    return fact.withColumns(texts).select(
        "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate", "i94bir",
        "i94visa", "dtadfile", "dtaddto", "admnum",
    )


NEAR = """(cos(radians(m.lat)) * cos(radians(m.lon)) - cos(radians(g.lat)) * cos(radians(g.lon))) ** 2
        + (cos(radians(m.lat)) * sin(radians(m.lon)) - cos(radians(g.lat)) * sin(radians(g.lon))) ** 2
        + (sin(radians(m.lat)) - sin(radians(g.lat))) ** 2"""


@query(
    f"""WITH m AS (SELECT CAST(month(dt) AS INTEGER) AS month, CAST(day(dt) AS INTEGER) AS day, city, lat, lon,
                CAST(sum(CAST(temp AS DECIMAL(18, 2))) AS DOUBLE) / count(temp) AS avg_temperature
            FROM ({roles.TEMPERATURE_RAW_SQL}) WHERE dt >= DATE '1996-01-01' GROUP BY 1, 2, 3, 4, 5),
        spots AS (SELECT DISTINCT lat, lon FROM m),
        near AS (SELECT m.lat, m.lon, arg_min(admin1, ({NEAR}, place_id)) AS state
            FROM spots m CROSS JOIN ({roles.GAZETTEER_SQL}) g GROUP BY 1, 2)
        SELECT DISTINCT month, day, city, state, key AS state_code, concat_ws(', ', upper(city), upper(key)) AS city_state_code,
               avg_temperature
        FROM m JOIN near USING (lat, lon) LEFT JOIN ({D['i94addr']}) ON state = {roles.initcap_sql('value')}"""
)
def build_temperature(t: Tables) -> DataFrame:
    return loaded_arrivals(t)["us_temperature"]


@query(roles.AIRPORTS_SQL)
def build_airports(t: Tables) -> DataFrame:
    return loaded_arrivals(t)["airport"]


@query(roles.DEMOGRAPHICS_SQL)
def build_demographics(t: Tables) -> DataFrame:
    return loaded_arrivals(t)["us_demographics"]


@query(
    f"""WITH fact AS ({CLEAN_FACT_SQL}), top AS (
            SELECT i94port, count(*) AS num_immigration_cases FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
        SELECT i94port, num_immigration_cases, count(airport_name) AS num_airports FROM top
        JOIN ({roles.AIRPORTS_SQL}) ON i94port = municipality_region WHERE type = 'large_airport' GROUP BY 1, 2"""
)
def busiest_ports(t: Tables) -> DataFrame:
    return arrivals.busiest_ports(loaded_arrivals(t))


TEMPERATURE_KEYS_SQL = f"""
    WITH m AS (SELECT DISTINCT month(dt) AS month, day(dt) AS day, city, lat, lon FROM ({roles.TEMPERATURE_RAW_SQL})
               WHERE dt >= DATE '1996-01-01'),
    near AS (SELECT m.lat, m.lon, arg_min(admin1, ({NEAR}, place_id)) AS state
             FROM (SELECT DISTINCT lat, lon FROM m) m CROSS JOIN ({roles.GAZETTEER_SQL}) g GROUP BY 1, 2)
    SELECT concat_ws(', ', upper(city), upper(key)) AS place, month FROM m JOIN near USING (lat, lon)
    LEFT JOIN ({D['i94addr']}) ON state = {roles.initcap_sql('value')}
"""


@query(
    f"""SELECT table_name, check_name, column_name, CAST(failing_rows AS BIGINT) AS failing_rows, failing_rows = 0 AS passed FROM (
        SELECT unnest(['i94_immigration', 'us_temperature', 'us_demographics', 'airport']) AS table_name,
               'not_empty' AS check_name, '*' AS column_name, 0 AS failing_rows
        UNION ALL SELECT 'i94_immigration', 'not_null', 'cicid', (SELECT count(*) - count(o_orderkey) FROM orders)
        UNION ALL SELECT 'i94_immigration', 'unique_key', 'cicid',
            (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'us_temperature', 'unique_key', 'city_state_code,month',
            (SELECT count(*) FROM (SELECT place, month FROM ({TEMPERATURE_KEYS_SQL}) GROUP BY 1, 2 HAVING count(*) > 1))
        UNION ALL SELECT 'airport', 'allowed_values', 'iso_country',
            (SELECT count(*) FROM ({roles.AIRPORTS_SQL}) WHERE iso_country <> 'US'))"""
)
def arrivals_checks(t: Tables) -> DataFrame:
    return arrivals.check_arrivals(loaded_arrivals(t))
