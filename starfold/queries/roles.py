"""The given tables in the roles of the star schemas' inputs.

Each role is a frame and, beside it, the same rows in SQL. Roles cover whole tables; gaps such as
missing labels or unmatched titles come from the data's own values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold import schemas
from starfold.operators.joins import spread_join
from starfold.queries.registry import Tables
from starfold.sinks.files import rebalanced, write_csv, write_json, write_parquet


def initcap_sql(text: str) -> str:
    """Title case in SQL: each word's first letter large, the others small."""
    words = f"list_transform(string_split({text}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"list_aggregate({words}, 'string_agg', ' ')"


# ---- songs and listens: part and lineitem ------------------------------------------------------

SONGS_SQL = """
    SELECT 'SO' || p_partkey AS song_id, 'Song ' || (p_partkey // 2) AS title, 'AR' || substr(p_brand, 7) AS artist_id,
           p_brand AS artist_name,
           CASE WHEN p_brand = 'Brand#7' AND p_size > 25 THEN 'Upper Town' ELSE 'Lower Town' END AS artist_location,
           CASE WHEN p_brand <> 'Brand#3' THEN CAST(substr(p_brand, 7) AS DOUBLE) * 1.5 END AS artist_latitude,
           CAST(-CAST(substr(p_brand, 7) AS DOUBLE) AS DOUBLE) AS artist_longitude,
           CASE WHEN p_size <= 10 THEN 0 ELSE 1960 + p_size END AS year,
           CAST(180 + (p_partkey // 2) % 100 AS DOUBLE) AS duration
    FROM part
"""

LISTENS_SQL = """
    SELECT CASE WHEN l_returnflag <> 'R' THEN p_brand END AS artist,
           CASE WHEN l_returnflag <> 'R' THEN 'Song ' || (l_partkey // 2)
                || CASE WHEN l_discount = 0 THEN ' (live)' ELSE '' END END AS song,
           CASE WHEN l_returnflag <> 'R' THEN CAST(180 + (l_partkey // 2) % 100 AS DOUBLE) END AS length,
           'First' || l_suppkey AS first_name, 'Last' || l_suppkey AS last_name,
           CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, l_linenumber AS item,
           CASE WHEN l_linestatus = 'O' THEN 'paid' ELSE 'free' END AS level, 'City ' || l_suppkey AS location,
           CASE WHEN l_returnflag = 'R' THEN 'Home' ELSE 'NextSong' END AS page,
           l_orderkey AS session_id, CAST(l_suppkey AS VARCHAR) AS user_id,
           'agent ' || CAST(l_quantity AS INTEGER) AS user_agent,
           l_shipdate + to_milliseconds(CAST(l_linenumber * 60000 + l_quantity * 1001 AS BIGINT)) AS start_time
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def _text(*parts) -> F.Column:
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _pair(key: str):
    return F.floor(F.col(key) / 2)


def songs(t: Tables) -> DataFrame:
    """Song metadata: two parts share a title and duration, often with different artists."""
    number = F.substring("p_brand", 7, 10)
    upper = (F.col("p_brand") == "Brand#7") & (F.col("p_size") > 25)
    return t.part.select(
        F.lit(1).alias("num_songs"),
        _text("AR", number).alias("artist_id"),
        F.when(F.col("p_brand") != "Brand#3", number.cast("double") * 1.5).alias("artist_latitude"),
        (-number.cast("double")).alias("artist_longitude"),
        F.when(upper, "Upper Town").otherwise("Lower Town").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        _text("SO", F.col("p_partkey").cast("string")).alias("song_id"),
        _text("Song ", _pair("p_partkey").cast("string")).alias("title"),
        (180 + _pair("p_partkey") % 100).cast("double").alias("duration"),
        F.when(F.col("p_size") <= 10, 0).otherwise(1960 + F.col("p_size")).alias("year"),
    )


def heard_lines(t: Tables) -> DataFrame:
    """The lines with their part's brand: what the listens are told from, in few bytes."""
    lines = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return spread_join(lines, t.part.select("p_partkey", "p_brand"), "p_partkey")


def heard_at() -> F.Column:
    after = (F.col("l_linenumber") * 60000 + F.col("l_quantity") * 1001).cast("bigint")
    return F.unix_millis(F.col("l_shipdate").cast("timestamp")) + after


def listens(t: Tables) -> DataFrame:
    """The listen log: a line is a play of its part unless returned; undiscounted plays are of live versions."""
    return told(heard_lines(t))


def told(lines: DataFrame, *keep: str) -> DataFrame:
    """The listens of ``heard_lines``, beside their columns ``keep``."""
    play = F.col("l_returnflag") != "R"
    who = F.col("l_suppkey").cast("string")
    live = F.when(F.col("l_discount") == 0, " (live)").otherwise("")
    return lines.select(
        F.when(play, F.col("p_brand")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        _text("First", who).alias("firstName"),
        F.when(F.col("l_suppkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("l_linenumber").alias("itemInSession"),
        _text("Last", who).alias("lastName"),
        F.when(play, (180 + _pair("p_partkey") % 100).cast("double")).alias("length"),
        F.when(F.col("l_linestatus") == "O", "paid").otherwise("free").alias("level"),
        _text("City ", who).alias("location"),
        F.lit("PUT").alias("method"),
        F.when(play, "NextSong").otherwise("Home").alias("page"),
        F.lit(1.5e12).alias("registration"),
        F.col("l_orderkey").alias("sessionId"),
        F.when(play, _text("Song ", _pair("p_partkey").cast("string"), live)).alias("song"),
        F.lit(200).alias("status"),
        heard_at().alias("ts"),
        _text("agent ", F.col("l_quantity").cast("int").cast("string")).alias("userAgent"),
        who.alias("userId"),
        *keep,
    )


def write_listens(lines: DataFrame, path: str, folders: dict[str, F.Column]) -> None:
    """Write the listens of ``lines`` as compressed JSON, in ``folders`` given over the lines.

    The lines are brought together and sorted by folder while they are narrow; their texts are made on writing.
    """
    together = rebalanced(lines.withColumns(folders), *folders).sortWithinPartitions(*folders)
    write_json(told(together, *folders), path, [*folders], rebalance=False, compression="gzip")


def listen_dir(t: Tables) -> str:
    """Songs and listens as nested JSON folders, the log by year and month."""

    def write(path: str) -> None:
        write_json(songs(t).withColumn("shelf", F.col("artist_id")), f"{path}/song_data", ["shelf"], compression="gzip")
        when = F.timestamp_millis(heard_at())
        write_listens(heard_lines(t), f"{path}/log_data", {"log_year": F.year(when), "log_month": F.month(when)})

    return t.staged("listens", write)


def event_csv_dir(t: Tables) -> str:
    """The listen log as quoted CSV files, rows without an artist included."""

    def write(path: str) -> None:
        cols = schemas.names(schemas.EVENT_CSV)
        write_csv(listens(t).select(*cols), path, compression="gzip")

    return t.staged("event-csv", write)


# ---- arrivals: orders, customer, supplier, nation, region --------------------------------------

ARRIVALS_RAW_SQL = """
    SELECT o_orderkey, year(o_orderdate) AS yr, month(o_orderdate) AS mon, c_nationkey AS cit,
           c_nationkey + n_regionkey AS res, 'P' || c_nationkey AS port,
           CAST(o_orderdate AS DATE) AS arr, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS mode,
           c_mktsegment AS addr, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + c_nationkey END AS dep,
           CAST(trunc(c_acctbal / 100) AS INTEGER) AS bir,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS visa, o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN DATE '1960-01-01' ELSE CAST(o_orderdate AS DATE) END AS addto,
           CASE WHEN o_orderpriority = '5-LOW' THEN DATE '1960-01-01' ELSE CAST(o_orderdate AS DATE) END AS adfile
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def arrivals_raw(t: Tables) -> DataFrame:
    """Arrivals: an order arrives on its date from its customer's nation; numbers are doubles."""
    people = spread_join(
        t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_acctbal", "c_mktsegment"),
        t.nation.select("n_nationkey", "n_regionkey"), "n_nationkey",
    ).withColumnRenamed("c_custkey", "o_custkey")
    df = spread_join(t.orders, people, "o_custkey")
    day = F.col("o_orderdate").cast("date")
    number = F.datediff(day, F.lit("1960-01-01").cast("date"))
    status = F.col("o_orderstatus")
    nation = F.col("n_nationkey")
    none = F.lit(None).cast("string")
    return df.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.year(day).cast("double").alias("i94yr"),
        F.month(day).cast("double").alias("i94mon"),
        nation.cast("double").alias("i94cit"),
        (nation + F.col("n_regionkey")).cast("double").alias("i94res"),
        _text("P", nation.cast("string")).alias("i94port"),
        number.cast("double").alias("arrdate"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("i94mode"),
        F.col("c_mktsegment").alias("i94addr"),
        F.when(status != "P", (number + nation).cast("double")).alias("depdate"),
        (F.col("c_acctbal") / 100).alias("i94bir"),
        F.when(status == "F", 1.0).when(status == "O", 2.0).otherwise(3.0).alias("i94visa"),
        F.lit(1.0).alias("count"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format(day, "yyyyMMdd")).alias("dtadfile"),
        none.alias("visapost"),
        none.alias("occup"),
        F.substring("o_orderpriority", 3, 1).alias("entdepa"),
        none.alias("entdepd"),
        none.alias("entdepu"),
        F.when(status == "O", "M").alias("matflag"),
        (F.year(day) - 30).cast("double").alias("biryear"),
        F.when(status == "F", "D/S").otherwise(F.date_format(day, "MMddyyyy")).alias("dtaddto"),
        none.alias("gender"),
        none.alias("insnum"),
        none.alias("airline"),
        F.col("o_totalprice").alias("admnum"),
        none.alias("fltno"),
        F.concat(F.lit("B"), status).alias("visatype"),
    )


# The dictionaries, as (key, value) rows: some labels are unusable, some keys are absent.
DICTIONARY_SQL = {
    "i94addr": """SELECT DISTINCT c_mktsegment AS key, 'STATE ' || c_mktsegment AS value
                  FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "i94cit": """SELECT n_nationkey AS key, CASE r_name WHEN 'AFRICA' THEN 'INVALID: ' || n_name
                 WHEN 'ASIA' THEN 'No Country Code (' || n_nationkey || ')' ELSE n_name END AS value
                 FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "i94mode": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS key, substr(o_orderpriority, 3) AS value
                  FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "i94port": """SELECT 'P' || n_nationkey AS key, CASE r_name WHEN 'EUROPE' THEN 'No PORT Code (' || n_nationkey || ')'
                  ELSE n_name || ', ' || substr(r_name, 1, 2) END AS value
                  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "i94res": """SELECT n_nationkey AS key, CASE WHEN r_name = 'ASIA' THEN n_name || ' (should not show)' ELSE n_name END AS value
                 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AMERICA'""",
    "i94visa": """SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS key,
                  'Visa ' || o_orderstatus AS value FROM orders WHERE o_orderstatus <> 'P'""",
}


def nation_regions(t: Tables) -> DataFrame:
    return spread_join(
        t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, "r_regionkey"
    )


def dictionaries(t: Tables) -> dict[str, DataFrame]:
    places = nation_regions(t)
    key, name, region = F.col("n_nationkey"), F.col("n_name"), F.col("r_name")
    text = key.cast("string")
    segments = t.customer.select(F.col("c_mktsegment").alias("key")).distinct()
    priorities = t.orders.select("o_orderpriority").distinct()
    statuses = t.orders.select("o_orderstatus").distinct()
    status = F.col("o_orderstatus")
    return {
        "i94addr": segments.filter(F.col("key") != "MACHINERY").withColumn("value", _text("STATE ", F.col("key"))),
        "i94cit": places.select(
            key.alias("key"),
            F.when(region == "AFRICA", _text("INVALID: ", name))
            .when(region == "ASIA", _text("No Country Code (", text, ")"))
            .otherwise(name).alias("value"),
        ),
        "i94mode": priorities.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("key"),
            F.substring("o_orderpriority", 3, 100).alias("value"),
        ),
        "i94port": places.select(
            _text("P", text).alias("key"),
            F.when(region == "EUROPE", _text("No PORT Code (", text, ")"))
            .otherwise(_text(name, ", ", F.substring(region, 1, 2))).alias("value"),
        ),
        "i94res": places.filter(region != "AMERICA").select(
            key.alias("key"), F.when(region == "ASIA", _text(name, " (should not show)")).otherwise(name).alias("value")
        ),
        "i94visa": statuses.filter(status != "P").select(
            F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("key"), _text("Visa ", status).alias("value")
        ),
    }


def temperature_raw(t: Tables) -> DataFrame:
    """Measurements: an order's price, in its customer's nation as city; pending orders have none."""
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    df = spread_join(spread_join(t.orders, people, "o_custkey"), nation_regions(t), "n_nationkey")
    key = F.col("n_nationkey")
    lat = F.when(key % 2 == 0, _text((key + 20).cast("string"), ".25N")).otherwise(_text((key + 1).cast("string"), ".75S"))
    return df.select(
        F.col("o_orderdate").cast("date").alias("dt"),
        F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(F.col("o_totalprice")).alias("AverageTemperature"),
        F.lit(1.0).alias("AverageTemperatureUncertainty"),
        F.initcap("n_name").alias("City"),
        F.when(F.col("r_name").isin("AMERICA", "ASIA"), "United States").otherwise(F.initcap("r_name")).alias("Country"),
        lat.alias("Latitude"),
        _text((key * 5 + 3).cast("string"), ".5W").alias("Longitude"),
    )


TEMPERATURE_RAW_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS dt, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS temp, n_nationkey,
           upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS city,
           CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 20.25e0 ELSE -(n_nationkey + 1.75e0) END AS lat,
           -(n_nationkey * 5 + 3.5e0) AS lon
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'ASIA')
"""

GAZETTEER_SQL = """
    SELECT s_suppkey AS place_id, s_acctbal * 0.009e0 - 10e0 AS lat, (s_suppkey * 97 % 3600) / 10e0 - 179.5e0 AS lon,
           CASE WHEN s_nationkey % 5 = 4 THEN 'Elsewhere'
                ELSE 'State ' || (['Automobile', 'Building', 'Furniture', 'Household'])[s_nationkey % 5 + 1] END AS admin1
    FROM supplier
"""


def gazetteer(t: Tables) -> DataFrame:
    """Reference points: suppliers, whose nation decides the state."""
    kind = F.col("s_nationkey") % 5
    state = (
        F.when(kind == 0, "State Automobile").when(kind == 1, "State Building")
        .when(kind == 2, "State Furniture").when(kind == 3, "State Household").otherwise("Elsewhere")
    )
    return t.supplier.select(
        F.col("s_suppkey").alias("place_id"),
        (F.col("s_acctbal") * 0.009 - 10.0).alias("lat"),
        (F.col("s_suppkey") * 97 % 3600 / 10.0 - 179.5).alias("lon"),
        state.alias("admin1"),
    )


def airports_raw(t: Tables) -> DataFrame:
    """Airports: suppliers, in their nation as town; three regions count as home."""
    df = spread_join(t.supplier.withColumnRenamed("s_nationkey", "n_nationkey"), nation_regions(t), "n_nationkey")
    rich = F.col("s_acctbal")
    home = F.col("r_name").isin("AMERICA", "ASIA", "EUROPE")
    state = F.substring("r_name", 1, 2)
    return df.select(
        _text("K", F.col("s_suppkey").cast("string")).alias("ident"),
        F.when(rich > 2000, "large_airport").when(rich > 0, "medium_airport").otherwise("small_airport").alias("type"),
        F.col("s_name").alias("name"),
        F.floor(rich).cast("int").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(home, "US").otherwise(state).alias("iso_country"),
        F.when(rich < 0, F.lit("US")).otherwise(_text("US-", state)).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        F.lit(None).cast("string").alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        F.col("s_suppkey").cast("string").alias("local_code"),
        _text(rich.cast("decimal(10,2)").cast("string"), ", ", F.col("s_suppkey").cast("string")).alias("coordinates"),
    )


AIRPORTS_SQL = """
    SELECT 'K' || s_suppkey AS ident, CASE WHEN s_acctbal > 2000 THEN 'large_airport' WHEN s_acctbal > 0 THEN 'medium_airport'
           ELSE 'small_airport' END AS type, s_name AS airport_name, CAST(floor(s_acctbal) AS INTEGER) AS elevation_ft,
           'NA' AS continent, 'US' AS iso_country, n_name AS municipality, CAST(NULL AS VARCHAR) AS gps_code,
           CAST(NULL AS VARCHAR) AS iata_code, CAST(s_suppkey AS VARCHAR) AS local_code,
           CASE WHEN s_acctbal >= 0 THEN substr(r_name, 1, 2) END AS region,
           concat_ws(', ', upper(n_name), CASE WHEN s_acctbal >= 0 THEN substr(r_name, 1, 2) END) AS municipality_region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('AMERICA', 'ASIA', 'EUROPE')
"""


def demographics_raw(t: Tables) -> DataFrame:
    """Demographics: customers, in their nation and region; populations from the balance."""
    df = spread_join(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), nation_regions(t), "n_nationkey")
    people = F.floor(F.abs("c_acctbal") * 10).cast("int")
    values = [
        F.col("n_name"), F.initcap("r_name"), F.col("c_acctbal"), people, people + 1, people * 2 + 1,
        F.when(F.col("c_acctbal") >= 0, people), people + 7, F.lit(2.5), F.substring("r_name", 1, 2),
        F.col("c_mktsegment"), F.length("c_name"),
    ]
    return df.select(*[v.alias(n) for v, n in zip(values, schemas.names(schemas.DEMOGRAPHICS_RAW), strict=True)])


DEMOGRAPHICS_SQL = f"""
    SELECT n_name AS city, {initcap_sql("r_name")} AS state, c_acctbal AS median_age,
           people AS male_population, people + 1 AS female_population, people * 2 + 1 AS total_population,
           CASE WHEN c_acctbal >= 0 THEN people END AS num_of_veterans, people + 7 AS foreign_born, 2.5e0 AS avg_house_size,
           substr(r_name, 1, 2) AS state_code, c_mktsegment AS race, CAST(length(c_name) AS INTEGER) AS count,
           upper(n_name) || ', ' || upper(substr(r_name, 1, 2)) AS city_state_code
    FROM (SELECT *, CAST(floor(abs(c_acctbal) * 10) AS INTEGER) AS people FROM customer)
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def arrivals_dir(t: Tables) -> str:
    """All inputs of the arrivals build, in their file formats."""

    def write(path: str) -> None:
        write_parquet(arrivals_raw(t).withColumn("month", F.col("i94mon").cast("int")), f"{path}/arrivals", ["month"])
        for col, dictionary in dictionaries(t).items():
            write_csv(dictionary, f"{path}/dictionary_data/{col}", quote_all=False, encoding="ISO-8859-1")
        write_csv(temperature_raw(t), f"{path}/temperature", quote_all=False, encoding="ISO-8859-1")
        write_csv(airports_raw(t), f"{path}/airports", quote_all=False, encoding="ISO-8859-1")
        write_csv(demographics_raw(t), f"{path}/demographics", quote_all=False, sep=";", encoding="ISO-8859-1")
        write_parquet(gazetteer(t), f"{path}/gazetteer")

    return t.staged("arrivals", write)
