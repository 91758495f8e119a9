import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from starfold.operators import analytics, dims, facts, joins, keyed, lookup


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- joins -----------------------------------------------------------------------------------------


def plan_of(df):
    """The plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_and_null_keys_are_spread(spark, no_broadcast, tmp_path, how):
    """Two thirds of the rows share one key; the partition that holds them is split over tasks."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    }
    hot = None if how == "left" else 7
    key = F.when(F.col("id") % 3 < 2, hot).otherwise(F.col("id") % 50)
    spark.range(0, 60000, numPartitions=12).select("id", key.alias("k"), F.md5(F.col("id").cast("string")).alias("pad")).write.parquet(f"{tmp_path}/big")
    big = spark.read.parquet(f"{tmp_path}/big")
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = joins.spread_join(big, small, "k", how)
        assert "isSkewJoin=true" in plan_of(joined) or "skew" in plan_of(joined)
        assert joined.count() == big.join(small, "k", how).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_filters_reach_the_scan_below_a_join(spark, no_broadcast, tmp_path):
    """Also beyond broadcasting, and no side is repeated."""
    spark.range(1000).select("id", (F.col("id") % 10).alias("k"), (F.col("id") % 3).alias("flag")).write.parquet(f"{tmp_path}/big")
    spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_path}/small")
    big, small = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("big", "small"))
    joined = joins.spread_join(big, small, "k", "left").filter("flag = 2")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(flag,2)" in plan and "Generate" not in plan


def test_small_side_is_broadcast_by_its_size(spark):
    big = spark.range(100000).withColumnRenamed("id", "k")
    small = spark.createDataFrame([(1, "a")], "k bigint, v string")
    assert "BroadcastHashJoin" in joins.spread_join(big, small, "k")._jdf.queryExecution().toString()


# ---- dims ------------------------------------------------------------------------------------------


def test_first_and_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (1, "c", 2), (2, None, 1)], "k int, v string, o int")
    assert rows(dims.first_per_key(df, ["k"], ["o"])) == [(1, "b", 1), (2, None, 1)]
    assert rows(dims.latest_per_key(df, ["k"], ["o"])) == [(1, "a", 3), (2, None, 1)]
    assert dims.latest_per_key(df.limit(0), ["k"], ["o"]).count() == 0
    assert rows(dims.first_per_key(df.select("k"), ["k"], ["k"])) == [(1,), (2,)]


def test_time_dimension_variants(spark):
    df = spark.sql("SELECT timestamp'2024-01-07 10:00:00' AS t UNION ALL SELECT timestamp'2024-01-07 10:00:00'")
    (row,) = dims.time_dimension(df, "t").collect()
    assert tuple(row)[1:] == (10, 7, 1, 1, 2024, "Sunday")
    assert [r.weekday for r in dims.time_dimension(df, "t", weekday="number", distinct=False).collect()] == [0, 0]


def test_calendar_mean_ignores_nulls(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (date'2004-03-01', 1.0D), (date'2005-03-01', 2.0D), (date'2006-03-01', null) AS t(d, v)"
    )
    for scale in (None, 3):
        assert rows(dims.calendar_mean(df, "d", [], "v", "m", scale)) == [(3, 1, 1.5)]


# ---- facts -----------------------------------------------------------------------------------------

SONGS = [("S1", "T", 100.0, "A1"), ("S2", "T", 100.0, "A2"), ("S3", "U", 50.0, "A1"), ("S4", "U", 50.0, "A1")]
ARTISTS = [("A1", "Ann"), ("A2", "Bob"), ("A3", "Ann")]
EVENTS = [(1, "T", "Ann", 100.0), (2, "U", "Ann", 50.0), (3, "T", "Zed", 100.0), (4, None, None, None), (5, "T", "Ann", 99.0)]


@pytest.fixture
def star(spark):
    return (
        spark.createDataFrame(EVENTS, "e int, song string, artist string, length double"),
        spark.createDataFrame(SONGS, "song_id string, title string, duration double, artist_id string"),
        spark.createDataFrame(ARTISTS, "artist_id string, name string"),
    )


def test_match_inner_multiplies(star):
    got = rows(facts.match_inner(*star).select("e", "song_id", "artist_id"))
    expected = [(e, s, a) for e, titles in ((1, ("S1", "S2")), (2, ("S3", "S4"))) for s in titles for a in ("A1", "A3")]
    assert got == expected


def test_match_staging(star):
    events, songs, artists = star
    staged = songs.join(artists.filter("artist_id <> 'A3'"), "artist_id").withColumnRenamed("name", "artist_name")
    got = rows(facts.match_staging(events, staged).select("e", "song_id", "artist_id"))
    assert got == [(1, "S1", "A1"), (2, "S3", "A1"), (2, "S4", "A1")]


def test_match_left_first_keeps_every_event_once(star):
    got = rows(facts.match_left_first(*star).select("e", "song_id", "artist_id"))
    assert got == [(1, "S1", "A1"), (2, "S3", "A1"), (3, None, None), (4, None, None), (5, None, None)]


def test_row_ids_are_dense_with_ties(spark):
    df = spark.range(0, 5000, numPartitions=10).select(
        "id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("t")
    )
    got = facts.with_row_id(df, ["t"], "n", start=0).collect()
    assert sorted(r.n for r in got) == list(range(5000))
    assert sorted(r.id for r in got) == list(range(5000))
    by_number = [r.t for r in sorted(got, key=lambda r: r.n)]
    assert by_number == sorted(by_number)


def test_row_ids_of_nothing(spark):
    assert facts.with_row_id(spark.range(0), ["id"]).count() == 0


def test_any_ids_are_unique(spark):
    assert facts.with_any_id(spark.range(0, 1000, numPartitions=7)).select("row_id").distinct().count() == 1000


def test_hash_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "x int, y string")
    assert [r.h for r in facts.with_hash_key(df, ["x", "y"], "h").collect()] == [hashlib.md5(b"1a").hexdigest(), None]


# ---- lookups ---------------------------------------------------------------------------------------


def test_map_codes(spark):
    df = spark.createDataFrame([(1, "a", 9), (2, "b", 8), (None, None, 7)], "x int, y string, z int")
    xs = spark.createDataFrame([(1, "one")], "key int, value string")
    ys = spark.createDataFrame([("b", "bee")], "key string, value string")
    assert rows(lookup.map_codes(df, {"x": xs, "y": ys})) == [
        ("NOT_IN_x_DICTIONARY", "NOT_IN_y_DICTIONARY", 7), ("NOT_IN_x_DICTIONARY", "bee", 8), ("one", "NOT_IN_y_DICTIONARY", 9),
    ]


def test_lookup_name_by_expression(spark):
    df = spark.createDataFrame([("New York",), ("Elsewhere",), (None,)], "state string")
    codes = spark.createDataFrame([("NY", "NEW YORK")], "key string, value string")
    got = rows(lookup.lookup_name(df, "state", codes, F.initcap("value"), "key", "code"))
    assert got == [("Elsewhere", None), ("New York", "NY"), (None, None)]


def unit(lat, lon):
    a, b = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)


def brute_nearest(points, sites):
    vectors = [(unit(lat, lon), i) for i, lat, lon in sites]
    out = {}
    for p, lat, lon in points:
        u = unit(lat, lon)
        out[p] = min((sum((x - y) ** 2 for x, y in zip(u, v)), i) for v, i in vectors)[1]
    return out


def town(rnd, n):
    """Sites within two kilometres."""
    return [(i, 48.0 + rnd.uniform(0, 0.018), 2.0 + rnd.uniform(0, 0.027)) for i in range(n)]


SITE = "site_id int, lat double, lon double"


def located(spark, rows):
    return lookup.located_sites(spark.createDataFrame(rows, SITE), ["site_id"])


def test_the_tree_has_as_many_levels_for_a_dense_town_as_for_the_world(spark, monkeypatch):
    monkeypatch.setattr(lookup, "FAN", 8)
    rnd = random.Random(4)
    wide = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(3000)]
    trees = [lookup.site_tree(located(spark, rows)) for rows in ([], wide[:10], wide, town(rnd, 3000))]
    assert [len(t.inner) for t in trees] == [0, 0, 2, 2]
    assert [t.leaves.count() for t in trees] == [0, 1, 188, 188]
    sizes = trees[3].leaves.select(F.size("__sites")).collect()
    assert max(sizes)[0] <= lookup.LEAF_SITES and sum(r[0] for r in sizes) == 3000


def test_a_point_meets_few_sites_in_a_dense_town_and_far_from_it(spark):
    rnd = random.Random(5)
    world = [(10_000 + i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(1000)]
    tree = lookup.site_tree(located(spark, town(rnd, 4000) + world))
    places = town(rnd, 200) + [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(200)]
    cand = lookup.leaf_candidates(located(spark, places).drop("__site"), tree).cache()
    assert cand.select("lat", "lon").distinct().count() == 400
    assert cand.count() <= 400 * 16
    cand.unpersist()


def test_shuffles_do_not_depend_on_where_the_sites_lie(spark, no_broadcast):
    rnd = random.Random(6)
    wide = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(5000)]
    point = spark.createDataFrame([(59.8, 10.4)], "la double, lo double")
    plans = []
    for sites in (wide, town(rnd, 5000)):
        found = lookup.nearest_site(point, spark.createDataFrame(sites, SITE), "la", "lo", {"site_id": "near"})
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        assert plans[-1].count("Exchange hashpartitioning") <= 12
    assert plans[0].count("Join") == plans[1].count("Join") == 3
    assert "NestedLoop" not in plans[0] and "Cartesian" not in plans[0]


def test_sites_without_a_place_are_never_found(spark):
    ref = spark.createDataFrame([(1, float("nan"), 10.0), (2, 59.9, 10.5), (3, None, 1.0), (4, 65.0, 20.0)], SITE)
    point = spark.createDataFrame([(59.8, 10.4)], "la double, lo double")
    assert lookup.nearest_site(point, ref, "la", "lo", {"site_id": "near"}).first().near == 2
    assert lookup.nearest_site(point, ref.limit(0), "la", "lo", {"site_id": "near"}).first().near is None


@pytest.mark.parametrize(("leaf", "fan"), [(16, 64), (16, 4), (1, 4)])
@pytest.mark.parametrize("broadcast", [True, False])
def test_nearest_site_equals_brute_force(spark, request, monkeypatch, leaf, fan, broadcast):
    """Sites are scattered, with most of them in one dense town, and at the poles and the date line."""
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    monkeypatch.setattr(lookup, "LEAF_SITES", leaf)
    monkeypatch.setattr(lookup, "FAN", fan)
    rnd = random.Random(leaf + fan)
    sites = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(100)]
    sites += [(100 + i, 48.0 + rnd.uniform(0, 0.2), 2.0 + rnd.uniform(0, 0.2)) for i in range(200)]
    sites += [(900, 90.0, 0.0), (901, -90.0, 0.0), (902, 0.0, 180.0), (903, 0.0, -179.9), (904, 0.0, 180.0)]
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(150)]
    points += [(200 + i, 48.0 + rnd.uniform(-1, 1), 2.0 + rnd.uniform(-1, 1)) for i in range(150)]
    points += [(500 + i, 48.1, 2.1) for i in range(300)]
    points += [(900, 89.9, 100.0), (901, -90.0, 50.0), (902, 0.0, 179.99), (903, 0.0, -179.99)]
    df = spark.createDataFrame(points + [(999, None, 1.0), (998, float("nan"), 1.0)], "p int, la double, lo double")
    ref = spark.createDataFrame([(*s, f"R{s[0]}") for s in sites], "site_id int, lat double, lon double, region string")
    got = {r.p: (r.near, r.region) for r in lookup.nearest_site(
        df, ref, "la", "lo", {"site_id": "near", "region": "region"}
    ).collect()}
    expected = {p: (i, f"R{i}") for p, i in brute_nearest(points, sites).items()}
    assert got == {**expected, 999: (None, None), 998: (None, None)}


# ---- keyed writes ----------------------------------------------------------------------------------


@pytest.fixture
def levels(spark):
    ddl = "user string, name string, level string, ts int"
    first = spark.createDataFrame([("u", "Ann", "free", 1), ("u", "Anna", "paid", 2), ("u", "Anne", "free", 3)], ddl)
    second = spark.createDataFrame([("u", "An", "paid", 4), ("v", "Vic", "free", 2)], ddl)
    return first, second


def upsert(base, delta):
    return keyed.upsert_partial(base, delta, ["user"], ["ts"], ["level"], ["name"])


def test_partial_upsert_keeps_first_name_and_latest_level(levels):
    first, second = levels
    base = upsert(first.limit(0), first)
    assert rows(base) == [("u", "Ann", "free", 3)]
    merged = upsert(base, second)
    assert rows(merged) == [("u", "Ann", "paid", 4), ("v", "Vic", "free", 2)]
    assert rows(upsert(merged, second)) == rows(merged)


def test_full_upsert(levels):
    first, second = levels
    base = keyed.latest_per_key(first, ["user"], ["ts"])
    merged = keyed.upsert_full(base, second, ["user"], ["ts"])
    assert rows(merged) == [("u", "An", "paid", 4), ("v", "Vic", "free", 2)]


def test_insert_if_absent_is_idempotent(levels):
    first, second = levels
    base = keyed.first_per_key(first, ["user"], ["ts"])
    merged = keyed.insert_if_absent(base, second, ["user"], ["ts"])
    assert rows(merged) == [("u", "Ann", "free", 1), ("v", "Vic", "free", 2)]
    assert rows(keyed.insert_if_absent(merged, second, ["user"], ["ts"])) == rows(merged)
    assert rows(keyed.insert_if_absent(base, second.limit(0), ["user"], ["ts"])) == rows(base)


def test_late_rows_do_not_undo_newer_ones(spark):
    ddl = "user string, name string, level string, ts int"
    base = spark.createDataFrame([("u", "Ann", "paid", 10)], ddl)
    late = spark.createDataFrame([("u", "Old", "free", 5)], ddl)
    assert rows(upsert(base, late)) == [("u", "Ann", "paid", 10)]
    assert rows(keyed.upsert_full(base, late, ["user"], ["ts"])) == [("u", "Ann", "paid", 10)]
    even = spark.createDataFrame([("u", "Eve", "free", 10)], ddl)
    assert rows(upsert(base, even)) == [("u", "Ann", "free", 10)]
    assert rows(keyed.upsert_full(base, even, ["user"], ["ts"])) == [("u", "Eve", "free", 10)]


def test_null_keys_are_inserted_once(spark):
    base = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    delta = spark.createDataFrame([(None, 3), ("b", 4)], "k string, v int")
    once = keyed.insert_if_absent(base, delta, ["k"], ["v"])
    assert rows(once) == rows(keyed.insert_if_absent(once, delta, ["k"], ["v"])) == sorted([(None, 1), ("a", 2), ("b", 4)], key=str)


# ---- analytics -------------------------------------------------------------------------------------


def test_point_lookup(spark):
    df = spark.createDataFrame([(338, 4, "b"), (338, 3, "a"), (1, 4, "c")], "session int, item int, song string")
    assert rows(analytics.point_lookup(df, {"session": 338, "item": 4}, ["song"])) == [("b",)]
    assert [r.song for r in analytics.point_lookup(df, {"session": 338}, ["song"], ["item"]).collect()] == ["a", "b"]
    assert rows(analytics.point_lookup(df, {"session": 5}, ["song"])) == []


def test_keyed_lookup_ignores_repeated_wishes(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    wanted = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(analytics.keyed_lookup(df, wanted, ["k"], ["v"])) == [("a",), ("b",)]


def test_top_played(spark):
    plays = spark.createDataFrame([(1, "S1"), (2, "S1"), (3, "S2"), (None, "S2"), (4, "S9"), (5, None)], "songplay_id int, song_id string")
    songs = spark.createDataFrame([("S1", "T"), ("S2", "T"), ("S3", "U")], "song_id string, title string")
    assert rows(analytics.top_played(plays, songs)) == [("T", 3)]


def test_topk_then_join_drops_after_the_cut(spark):
    fact = spark.createDataFrame([("x",)] * 3 + [("y",)] * 2 + [("z",)], "port string")
    dim = spark.createDataFrame([("y", "big", "a"), ("y", "big", "b"), ("x", "small", "c"), ("z", "big", "d")], "p string, t string, n string")
    got = rows(analytics.topk_then_join(fact, "port", dim, "p", F.col("t") == "big", "n", k=2))
    assert got == [("y", 2, 2)]


def test_null_ratio_and_union(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "x int, y string")
    assert analytics.null_ratio(df, "y").first()[0] == 0.5
    assert analytics.null_ratio(df.limit(0), "y").first()[0] is None
    assert analytics.union_parts([df, df.select("y", "x")]).count() == 4


def test_a_leaf_is_one_row_of_the_last_comparison(spark):
    rnd = random.Random(9)
    sites = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)]
    point = spark.createDataFrame([(59.8, 10.4)], "la double, lo double")
    found = lookup.nearest_site(point, spark.createDataFrame(sites, SITE), "la", "lo", {"site_id": "near"})
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" in text and "explode" not in text
