"""Border arrivals: cleaning of the fact and its three dimensions, load and checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold import schemas
from starfold.functions import dates, geo, labels
from starfold.operators import quality
from starfold.operators.analytics import topk_then_join
from starfold.operators.dims import calendar_mean
from starfold.operators.lookup import lookup_name, map_codes, nearest_site
from starfold.session import scratch_dir
from starfold.sinks.files import load_table, materialize, open_table, write_parquet
from starfold.sources.files import read_csv, read_parquet

# The coded columns, each with the schema of its dictionary file.
DICTIONARIES = {
    "i94addr": schemas.DICTIONARY_TEXT_KEY,
    "i94cit": schemas.DICTIONARY_INT_KEY,
    "i94mode": schemas.DICTIONARY_INT_KEY,
    "i94port": schemas.DICTIONARY_TEXT_KEY,
    "i94res": schemas.DICTIONARY_INT_KEY,
    "i94visa": schemas.DICTIONARY_INT_KEY,
}
COUNTRY_COLUMNS = ["i94cit", "i94res"]
WHOLE_NUMBERS = ["i94yr", "i94mon", "i94cit", "i94res", "i94mode", "i94bir", "i94visa"]
HOME_COUNTRY, HOME_COUNTRY_CODE = "United States", "US"
FIRST_DATE = dt.date(2003, 1, 1)


def clean_dictionary(dictionary: DataFrame, col: str) -> DataFrame:
    """Replace unusable labels of country and port dictionaries."""
    if col in COUNTRY_COLUMNS:
        marks, sentinel = labels.BAD_COUNTRY_MARKS, labels.BAD_COUNTRY_LABEL
    elif col == "i94port":
        marks, sentinel = labels.BAD_PORT_MARKS, labels.BAD_PORT_LABEL
    else:
        return dictionary
    return dictionary.withColumn("value", labels.remap_matching(F.col("value"), marks, sentinel.format(col=col)))


def clean_arrivals(raw: DataFrame, dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """Decode ids, codes, dates and labels of the arrivals fact."""
    decoded = raw.withColumns(
        {
            "cicid": labels.id_text(F.col("cicid")),
            **{c: labels.code(F.col(c)) for c in WHOLE_NUMBERS},
            **{c: dates.sas_date(F.col(c)) for c in ("arrdate", "depdate")},
            "dtadfile": dates.parse_date(F.col("dtadfile"), "yyyyMMdd"),
            "dtaddto": dates.parse_date(F.col("dtaddto"), "MMddyyyy"),
        }
    )
    cleaned = {c: clean_dictionary(d, c) for c, d in dictionaries.items()}
    return map_codes(decoded, cleaned).select(*schemas.names(schemas.ARRIVALS))


def clean_temperature(
    raw: DataFrame, gazetteer: DataFrame, states: DataFrame, since: dt.date = FIRST_DATE, scale: int | None = None
) -> DataFrame:
    """Mean temperature per home city and calendar day, with the state found from its coordinates."""
    home = raw.filter((F.col("dt") >= F.lit(since)) & (F.col("Country") == HOME_COUNTRY))
    home = home.withColumn("AverageTemperature", labels.nan_to_null(F.col("AverageTemperature")))
    mean = calendar_mean(
        home, "dt", ["City", "Country", "Latitude", "Longitude"], "AverageTemperature", "avg_temperature", scale
    ).withColumns({c: geo.signed_degrees(F.col(c)) for c in ("Latitude", "Longitude")})
    # the search reads its points twice, which would read and average all measurements twice
    mean = materialize(mean, scratch_dir(raw.sparkSession, "mean-temperature"))
    sites = gazetteer.select(F.col("place_id").alias("site_id"), "lat", "lon", "admin1")
    with_state = nearest_site(mean, sites, "Latitude", "Longitude", {"admin1": "state"})
    coded = lookup_name(with_state, "state", states, F.initcap("value"), "key", "state_code")
    return coded.select(
        "month", "day", F.col("City").alias("city"), "state", "state_code",
        labels.place_key(F.col("City"), F.col("state_code")).alias("city_state_code"), "avg_temperature",
    ).distinct()


def clean_airports(raw: DataFrame) -> DataFrame:
    """Home airports with the region split off their region code and a place key."""
    region = labels.split_item(F.col("iso_region"), "-", 1)
    return (
        raw.filter(F.col("iso_country") == HOME_COUNTRY_CODE)
        .withColumnRenamed("name", "airport_name")
        .withColumn("region", region)
        .withColumn("municipality_region", labels.place_key(F.col("municipality"), F.col("region")))
        .drop("iso_region", "coordinates")
    )


def airport_details(raw: DataFrame, country_codes: DataFrame) -> DataFrame:
    """All airports with their coordinates as numbers and their country's full name."""
    lon, lat = geo.lon_lat(F.col("coordinates"))
    located = raw.withColumnRenamed("name", "airport_name").withColumns({"latitude": lat, "longitude": lon})
    return lookup_name(located.drop("coordinates"), "iso_country", country_codes, "Code", "Name", "iso_country_fullname")


def clean_demographics(raw: DataFrame) -> DataFrame:
    """Demographics under plain column names, with a place key."""
    plain = schemas.names(schemas.DEMOGRAPHICS)[:-1]
    renamed = raw.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(raw.columns, plain, strict=True)])
    return renamed.withColumn("city_state_code", labels.place_key(F.col("city"), F.col("state_code")))


def run_arrivals(
    spark: SparkSession, in_dir: str, out_dir: str, since: dt.date = FIRST_DATE, scale: int | None = None
) -> None:
    """Clean all four tables: raw CSV and Parquet below ``in_dir`` -> Parquet below ``out_dir``.

    The arrivals of all months are one scan and one plan.
    """
    dictionaries = {
        c: read_csv(spark, f"{in_dir}/dictionary_data/{c}", schema) for c, schema in DICTIONARIES.items()
    }
    temperature = read_csv(spark, f"{in_dir}/temperature", schemas.TEMPERATURE_RAW)
    gazetteer = read_parquet(spark, f"{in_dir}/gazetteer")
    write_parquet(
        clean_temperature(temperature, gazetteer, dictionaries["i94addr"], since, scale), f"{out_dir}/us_temperature"
    )
    write_parquet(clean_airports(read_csv(spark, f"{in_dir}/airports", schemas.AIRPORTS_RAW)), f"{out_dir}/airport")
    demographics = read_csv(spark, f"{in_dir}/demographics", schemas.DEMOGRAPHICS_RAW, sep=";")
    write_parquet(clean_demographics(demographics), f"{out_dir}/us_demographics")
    raw = read_parquet(spark, f"{in_dir}/arrivals", columns=schemas.names(schemas.ARRIVALS_RAW))
    write_parquet(clean_arrivals(raw, dictionaries), f"{out_dir}/i94_immigration")


TABLE_SCHEMAS = {
    "i94_immigration": schemas.ARRIVALS,
    "us_temperature": schemas.TEMPERATURE,
    "us_demographics": schemas.DEMOGRAPHICS,
    "airport": schemas.AIRPORTS,
}


def open_arrivals(spark: SparkSession, clean_dir: str) -> dict[str, DataFrame]:
    """The cleaned tables against their declared schemas."""
    return {t: open_table(spark, f"{clean_dir}/{t}", schema) for t, schema in TABLE_SCHEMAS.items()}


def load_arrivals(
    spark: SparkSession, clean_dir: str, prefix: str = "", mode: str = "replace", location: str | None = None
) -> dict[str, DataFrame]:
    """Load the cleaned files into tables named ``prefix`` and the table; ``location`` as in ``load_table``."""
    return {
        t: load_table(spark, f"{clean_dir}/{t}", schema, prefix + t, mode, location and f"{location}/{t}")
        for t, schema in TABLE_SCHEMAS.items()
    }


def check_arrivals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The quality checks of a load, as one frame."""
    fact, airport = tables["i94_immigration"], tables["airport"]
    checks = [quality.not_empty(df, t) for t, df in tables.items()]
    checks += [
        quality.not_null(fact, "i94_immigration", ["cicid"]),
        quality.unique_key(fact, "i94_immigration", ["cicid"]),
        quality.unique_key(tables["us_temperature"], "us_temperature", ["city_state_code", "month"]),
        quality.allowed(airport, "airport", "iso_country", [HOME_COUNTRY_CODE]),
    ]
    return quality.union_parts(checks)


def busiest_ports(tables: Mapping[str, DataFrame], k: int = 10) -> DataFrame:
    """The ``k`` ports with most arrivals that have a large airport, and how many of those."""
    return topk_then_join(
        tables["i94_immigration"].filter(F.col("cicid").isNotNull()), "i94port", tables["airport"],
        "municipality_region", F.col("type") == "large_airport", "airport_name", k,
        n_fact="num_immigration_cases", n_dim="num_airports",
    )
