import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from starfold.functions import dates, geo, labels


def values(spark, ddl, inputs, *columns):
    df = spark.createDataFrame([(v,) for v in inputs], f"v {ddl}")
    rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()
    return [tuple(r) if len(columns) > 1 else r[0] for r in rows]


def test_sas_date(spark):
    zero = dt.date(1960, 1, 1)
    got = values(spark, "double", [20573.0, 20573.9, -0.5, None, float("nan"), 1e30], dates.sas_date(F.col("v")))
    assert got == [dt.date(2016, 4, 29), dt.date(2016, 4, 29), dt.date(1959, 12, 31), zero, zero, zero]


def test_parse_date(spark):
    zero = dt.date(1960, 1, 1)
    got = values(spark, "string", ["10282016", "D/S", None, "13452016"], dates.parse_date(F.col("v"), "MMddyyyy"))
    assert got == [dt.date(2016, 10, 28), zero, zero, zero]


def test_signed_degrees(spark):
    got = values(spark, "string", ["57.05N", "57.05S", "10.33E", "10.33W", "x", "", None], geo.signed_degrees(F.col("v")))
    assert got == [57.05, -57.05, 10.33, -10.33, None, None, None]


def test_lon_lat(spark):
    got = values(spark, "string", ["-74.93, 40.07", "5", "a, b", None], *geo.lon_lat(F.col("v")))
    assert got == [(-74.93, 40.07), (5.0, None), (None, None), (None, None)]


def test_place_key_skips_null_parts(spark):
    df = spark.createDataFrame([("Laredo", "tx"), ("Paris", None), (None, None)], "c string, s string")
    assert [r[0] for r in df.select(labels.place_key(F.col("c"), F.col("s"))).collect()] == ["LAREDO, TX", "PARIS", ""]


def test_split_item(spark):
    assert values(spark, "string", ["US-PA", "US", None], labels.split_item(F.col("v"), "-", 1)) == ["PA", None, None]


def test_remap_matching_tests_for_contents(spark):
    c = labels.remap_matching(F.col("v"), labels.BAD_COUNTRY_MARKS, "BAD")
    inputs = ["INVALID: X", "was INVALID: X", "No Country Code (589)", "a (should not show)", "FRANCE", None]
    assert values(spark, "string", inputs, c) == ["BAD", "BAD", "BAD", "BAD", "FRANCE", None]


def test_ids_and_codes(spark):
    got = values(spark, "double", [6.0, 7.9, None, float("nan")], labels.id_text(F.col("v")), labels.code(F.col("v")))
    assert got == [("6", 6), ("7", 7), (None, None), (None, None)]


def test_hash_key_is_null_for_null_parts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "x int, y string")
    got = [r[0] for r in df.select(labels.hash_key(F.col("x"), F.col("y"))).collect()]
    assert got == [hashlib.md5(b"1a").hexdigest(), None]


@pytest.mark.parametrize(
    "millis, text, name, number, week",
    [(1541105830796, "2018-11-01 20:57:10.796", "Thursday", 4, 44), (0, "1970-01-01 00:00:00.000", "Thursday", 4, 1),
     (1546214400000, "2018-12-31 00:00:00.000", "Monday", 1, 1)],
)
def test_times(spark, millis, text, name, number, week):
    ts = F.timestamp_millis(F.col("v"))
    parts = dates.time_parts(ts)
    got = values(
        spark, "bigint", [millis], dates.millis_text(F.col("v")), parts["weekday"], dates.weekday_number(ts),
        parts["week"], dates.time_map(ts)["weekday"],
    )
    assert got == [(text, name, number, week, name)]


def test_nan_to_null(spark):
    assert values(spark, "double", [1.0, float("nan"), None], labels.nan_to_null(F.col("v"))) == [1.0, None, None]
