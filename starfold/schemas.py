"""Declared schemas, as DDL strings for ``spark.read.schema``.

Column names are fixed values: they are the field names of the files themselves.
"""

from __future__ import annotations

from pyspark.sql import types as T

LISTEN_LOG = """
    artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession INT, lastName STRING,
    length DOUBLE, level STRING, location STRING, method STRING, page STRING, registration DOUBLE,
    sessionId BIGINT, song STRING, status INT, ts BIGINT, userAgent STRING, userId STRING
"""

SONG_METADATA = """
    num_songs INT, artist_id STRING, artist_latitude DOUBLE, artist_longitude DOUBLE,
    artist_location STRING, artist_name STRING, song_id STRING, title STRING, duration DOUBLE, year INT
"""

EVENT_CSV = """
    artist STRING, auth STRING, firstName STRING, gender STRING, itemInSession INT, lastName STRING,
    length DOUBLE, level STRING, location STRING, method STRING, page STRING, registration DOUBLE,
    sessionId BIGINT, song STRING, status INT, ts DOUBLE, userId BIGINT
"""

EVENT_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
]

ARRIVALS_RAW = """
    cicid DOUBLE, i94yr DOUBLE, i94mon DOUBLE, i94cit DOUBLE, i94res DOUBLE, i94port STRING, arrdate DOUBLE,
    i94mode DOUBLE, i94addr STRING, depdate DOUBLE, i94bir DOUBLE, i94visa DOUBLE, count DOUBLE,
    dtadfile STRING, visapost STRING, occup STRING, entdepa STRING, entdepd STRING, entdepu STRING,
    matflag STRING, biryear DOUBLE, dtaddto STRING, gender STRING, insnum STRING, airline STRING,
    admnum DOUBLE, fltno STRING, visatype STRING
"""

ARRIVALS = """
    cicid STRING, i94yr INT, i94mon INT, i94cit STRING, i94res STRING, i94port STRING, arrdate DATE,
    i94mode STRING, i94addr STRING, depdate DATE, i94bir INT, i94visa STRING, count DOUBLE,
    dtadfile DATE, visapost STRING, occup STRING, entdepa STRING, entdepd STRING, entdepu STRING,
    matflag STRING, biryear DOUBLE, dtaddto DATE, gender STRING, insnum STRING, airline STRING,
    admnum DOUBLE, fltno STRING, visatype STRING
"""

DICTIONARY_TEXT_KEY = "key STRING, value STRING"
DICTIONARY_INT_KEY = "key INT, value STRING"

TEMPERATURE_RAW = """
    dt DATE, AverageTemperature DOUBLE, AverageTemperatureUncertainty DOUBLE, City STRING, Country STRING,
    Latitude STRING, Longitude STRING
"""

TEMPERATURE = """
    month INT, day INT, city STRING, state STRING, state_code STRING, city_state_code STRING,
    avg_temperature DOUBLE
"""

DEMOGRAPHICS_RAW = """
    City STRING, State STRING, `Median Age` DOUBLE, `Male Population` INT, `Female Population` INT,
    `Total Population` INT, `Number of Veterans` INT, `Foreign-born` INT, `Average Household Size` DOUBLE,
    `State Code` STRING, Race STRING, Count INT
"""

DEMOGRAPHICS = """
    city STRING, state STRING, median_age DOUBLE, male_population INT, female_population INT,
    total_population INT, num_of_veterans INT, foreign_born INT, avg_house_size DOUBLE,
    state_code STRING, race STRING, count INT, city_state_code STRING
"""

AIRPORTS_RAW = """
    ident STRING, type STRING, name STRING, elevation_ft INT, continent STRING, iso_country STRING,
    iso_region STRING, municipality STRING, gps_code STRING, iata_code STRING, local_code STRING,
    coordinates STRING
"""

AIRPORTS = """
    ident STRING, type STRING, airport_name STRING, elevation_ft INT, continent STRING, iso_country STRING,
    municipality STRING, gps_code STRING, iata_code STRING, local_code STRING, region STRING,
    municipality_region STRING
"""

COUNTRY_CODES = "Name STRING, Code STRING"

GAZETTEER = "place_id BIGINT, lat DOUBLE, lon DOUBLE, admin1 STRING"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def names(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()
