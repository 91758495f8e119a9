"""Whole builds on small handmade files."""

import datetime as dt
import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starfold import schemas
from starfold.operators.quality import QualityError
from starfold.plans import arrivals, daily, keyed, lake, listens, query_tables, warehouse
from starfold.sinks.files import write_parquet
from starfold.sources.files import read_json


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def song(song_id, artist_id, title, name, duration, location="Rome"):
    return {
        "num_songs": 1, "artist_id": artist_id, "artist_latitude": None, "artist_longitude": 1.5,
        "artist_location": location, "artist_name": name, "song_id": song_id, "title": title,
        "duration": duration, "year": 0,
    }


def listen(ts, user, level, song=None, artist=None, length=None, page="NextSong", item=0, session=1):
    return {
        "artist": artist, "auth": "Logged In", "firstName": "F" + user, "gender": "F", "itemInSession": item,
        "lastName": "L" + user, "length": length, "level": level, "location": "Rome", "method": "PUT", "page": page,
        "registration": 1.5e12, "sessionId": session, "song": song, "status": 200, "ts": ts, "userAgent": "agent",
        "userId": user,
    }


DAY = 1541030400000  # 2018-11-01
SONGS = [
    song("S2", "A1", "T", "Ann", 100.5), song("S1", "A1", "T", "Ann", 100.5, "Oslo"), song("S3", "A2", "U", "Bob", 50.25),
]
FIRST_LOG = [
    listen(DAY + 1000, "1", "free", "T", "Ann", 100.5),
    listen(DAY + 2000, "1", "paid", "U", "Bob", 50.25, item=1),
    listen(DAY + 3000, "1", "free", "X", "Ann", 100.5, item=2),
    listen(DAY + 3000, "1", "free", "X", "Ann", 100.5, item=2),
    listen(DAY + 4000, "2", "free", page="Home"),
]
SECOND_LOG = [listen(DAY + 86400000, "1", "paid", "U", "Bob", 50.25, session=2), listen(DAY + 86400000, "3", "free", "U", "Bob", 50.25, session=3)]


@pytest.fixture
def music(tmp_path):
    for i, s in enumerate(SONGS):
        path = tmp_path / "in" / "song_data" / "A" / "B"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{i}.json").write_text(json.dumps(s))
    path = tmp_path / "in" / "log_data" / "2018" / "11"
    path.mkdir(parents=True)
    for name, log in (("2018-11-01", FIRST_LOG), ("2018-11-02", SECOND_LOG)):
        (path / f"{name}-events.json").write_text("\n".join(json.dumps(r) for r in log))
    return str(tmp_path / "in"), str(tmp_path / "out")


def at(ms):
    return dt.datetime(2018, 11, 1) + dt.timedelta(milliseconds=ms)


def test_lake(spark, music):
    fact = lake.run_lake(spark, *music)
    got = [(r.songplay_id, r.start_time, r.user_id, r.song_id, r.artist_id, r.year, r.month) for r in fact.collect()]
    # artist A1 has two rows (two locations), so each play of T matches two songs times two artists
    assert sorted(got)[:4] == [(i + 1, at(1000), "1", s, "A1", 2018, 11) for i, s in enumerate(["S1", "S1", "S2", "S2"])]
    assert [g[:3] for g in sorted(got)[4:]] == [(5, at(2000), "1"), (6, at(86400000), "1"), (7, at(86400000), "3")]
    out = music[1]
    assert rows(spark.read.parquet(f"{out}/users").select("user_id", "level")) == [("1", "free"), ("1", "paid"), ("3", "free")]
    assert spark.read.parquet(f"{out}/time").count() == 4
    assert spark.read.parquet(f"{out}/artists").count() == 3
    lake.run_lake(spark, *music, users="latest")
    assert rows(spark.read.parquet(f"{out}/users").select("user_id", "level")) == [("1", "paid"), ("3", "free")]


def test_warehouse(spark, music):
    fact = warehouse.run_warehouse(spark, *music)
    assert sorted(r.songplay_id for r in fact.collect()) == list(range(7))
    times = spark.read.parquet(f"{music[1]}/time")
    assert rows(times.select("start_time", "weekday")) == [
        (at(1000), "Thursday"), (at(2000), "Thursday"), (at(86400000), "Friday"),
    ]


def test_keyed_batches(spark, music):
    in_dir, out = music
    logs = [["log_data/2018/11/2018-11-01-events.json"], ["log_data/2018/11/2018-11-02-events.json"]]
    keyed.run_keyed(spark, in_dir, out, 0, logs[0])
    assert rows(keyed.users(spark, out)) == [("1", "F1", "L1", "F", "free")]
    for _ in range(2):
        keyed.run_keyed(spark, in_dir, out, 1, logs[1])
        assert rows(keyed.users(spark, out)) == [("1", "F1", "L1", "F", "paid"), ("3", "F3", "L3", "F", "free")]
        got = [(r.songplay_id, r.start_time, r.song_id, r.artist_id) for r in keyed.songplays(spark, out).collect()]
        assert sorted(got, key=lambda g: g[0]) == [
            (1, at(1000), "S1", "A1"), (2, at(2000), "S3", "A2"), (3, at(3000), None, None),
            (4, at(86400000), "S3", "A2"), (5, at(86400000), "S3", "A2"),
        ]
        # the first row of artist A1 came with song S1
        assert rows(spark.read.parquet(f"{out}/artists").select("artist_id", "location")) == [("A1", "Oslo"), ("A2", "Rome")]
        assert spark.read.parquet(f"{out}/songs").count() == 3
        assert spark.read.parquet(f"{out}/time").count() == 4


def test_daily_load_replaces_its_date(spark, music):
    in_dir, out = music
    for _ in range(2):
        fact = daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 1))
        assert rows(fact.select("user_id", "song_id")) == [("1", "S1"), ("1", "S2"), ("1", "S3")]
    daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 2))
    assert spark.read.parquet(f"{out}/songplays").count() == 5
    assert {r.weekday for r in spark.read.parquet(f"{out}/time").collect()} == {4, 5}
    daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 2), mode="append")
    assert spark.read.parquet(f"{out}/songplays").count() == 7


def unmatched(path):
    """Give a log's plays a song that does not exist."""
    lines = [json.loads(line) for line in path.read_text().splitlines() if line.strip()]
    path.write_text("\n".join(json.dumps({**line, "song": "unheard"}) for line in lines))


def test_daily_rerun_can_shrink_to_nothing(spark, music):
    in_dir, out = music
    log = Path(in_dir) / "log_data" / "2018" / "11" / "2018-11-01-events.json"
    assert daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 1)).count() == 3
    unmatched(log)
    assert daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 1)).count() == 0
    daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 2))
    assert spark.read.parquet(f"{out}/songplays").count() == 2


def test_daily_first_day_without_a_match(spark, music):
    in_dir, out = music
    unmatched(Path(in_dir) / "log_data" / "2018" / "11" / "2018-11-01-events.json")
    assert daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 1)).count() == 0


def test_whole_and_dated_loads_do_not_mix(spark, music):
    in_dir, out = music
    daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 1))
    with pytest.raises(ValueError, match="another kind"):
        daily.run_daily(spark, in_dir, out, mode="append")
    whole = daily.run_daily(spark, in_dir, out)
    assert whole.count() == spark.read.parquet(f"{out}/songplays").count() == 5
    with pytest.raises(ValueError, match="another kind"):
        daily.run_daily(spark, in_dir, out, dt.date(2018, 11, 1))


def test_lake_and_warehouse_without_a_match(spark, music):
    in_dir, out = music
    for log in (Path(in_dir) / "log_data").rglob("*.json"):
        unmatched(log)
    assert lake.run_lake(spark, in_dir, f"{out}/lake").count() == 0
    assert warehouse.run_warehouse(spark, in_dir, f"{out}/warehouse").count() == 0


def test_keyed_batches_keep_their_order(spark, music):
    in_dir, out = music
    logs = [["log_data/2018/11/2018-11-02-events.json"], ["log_data/2018/11/2018-11-01-events.json"]]
    for batch, paths in enumerate(logs):
        keyed.run_keyed(spark, in_dir, out, batch, paths)
    # the older log came later and does not undo the level
    assert rows(keyed.users(spark, out))[0][-1] == "paid"
    with pytest.raises(ValueError, match="batch 1 builds on it"):
        keyed.run_keyed(spark, in_dir, out, 0, logs[0])
    ids = [r.songplay_id for r in keyed.songplays(spark, out).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_every_folder_of_the_log_is_a_batch(spark, tmp_path):
    """Listens of 1994 and 2002, and one without a time, are in the folders that the builds read."""
    from starfold.queries import builds

    log = [(None, "Home"), (757382400000, "NextSong"), (1009843200000, "NextSong")]
    df = spark.createDataFrame(log, "ts long, page string").withColumn("log_year", F.year(F.timestamp_millis("ts")))
    df.write.partitionBy("log_year").json(f"{tmp_path}/log_data")

    class Listens:
        def __init__(self):
            self.spark = spark

        def staged(self, label, write):
            return str(tmp_path)

    batches = builds.log_batches(Listens())
    assert [len(b) for b in batches] == [2, 1] and "HIVE_DEFAULT" in batches[0][0]
    assert spark.read.json([f"{tmp_path}/{folder}" for b in batches for folder in b]).count() == 3


def test_daily_gate(spark, music, tmp_path):
    path = tmp_path / "in" / "log_data" / "2018" / "11" / "2018-11-03-events.json"
    path.write_text(json.dumps({**listen(DAY, "1", "free", "U", "Bob", 50.25), "userId": None}))
    with pytest.raises(QualityError, match="songplays.user_id"):
        daily.run_daily(spark, *music, run_date=dt.date(2018, 11, 3))


def test_query_tables(spark, tmp_path):
    head = ",".join(schemas.names(schemas.EVENT_CSV))
    line = "{a},Logged In,Ann,F,{i},Lee,{n},free,Rome,PUT,NextSong,1.5E+12,{s},{t},200,{ts},{u}"
    events = [
        line.format(a="Faithless", i=4, n="495.3073", s=338, t="Music Matters", ts="1E12", u=10),
        line.format(a="Old", i=4, n="1.5", s=338, t="Old", ts="9E11", u=10),
        line.format(a="Second", i=1, n="2.5", s=182, t="B", ts="1E12", u=10),
        line.format(a="First", i=0, n="2.5", s=182, t="A", ts="1E12", u=10),
        line.format(a="", i=2, n="", s=182, t="", ts="1E12", u=10),
    ]
    (tmp_path / "in").mkdir()
    for i, e in enumerate(events):
        (tmp_path / "in" / f"{i}.csv").write_text(f"{head}\r\n{e}\r\n")
    tables = query_tables.run_query_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    from starfold.operators.analytics import point_lookup

    (hit,) = point_lookup(tables["session_items"], {"session_id": 338, "item_in_session": 4}, ["artist", "song_title", "length"]).collect()
    assert hit.artist == "Faithless" and hit.song_title == "Music Matters" and hit.length == pytest.approx(495.3073, abs=1e-4)
    session = point_lookup(tables["user_sessions"], {"user_id": 10, "session_id": 182}, ["artist"], ["item_in_session"])
    assert [r.artist for r in session.collect()] == ["First", "Second"]
    assert rows(point_lookup(tables["song_users"], {"song_title": "Music Matters"}, ["first_name", "last_name"])) == [("Ann", "Lee")]


def test_arrivals_fact(spark):
    raw = spark.createDataFrame(
        [
            (6.0, 2016.0, 4.0, 692.0, 589.0, "XXX", 20573.0, None, None, None, 37.0, 2.0, 1.0, None, *[None] * 6, 1979.0,
             "10282016", None, None, None, 1.5, None, "B2"),
            (7.0, 2016.0, 4.0, 254.0, 101.0, "ATL", 20551.0, 1.0, "AL", 20691.0, 25.0, 3.0, 1.0, "20130811", *[None] * 6, 1991.0,
             "D/S", "M", None, None, 2.5, None, "F1"),
        ],
        schemas.ARRIVALS_RAW,
    )
    ints, texts = schemas.DICTIONARY_INT_KEY, schemas.DICTIONARY_TEXT_KEY
    dictionaries = {
        "i94addr": spark.createDataFrame([("AL", "ALABAMA")], texts),
        "i94cit": spark.createDataFrame([(254, "INVALID: X"), (692, "ECUADOR")], ints),
        "i94mode": spark.createDataFrame([(1, "Air")], ints),
        "i94port": spark.createDataFrame([("ATL", "ATLANTA, GA"), ("XXX", "No PORT Code (XXX)")], texts),
        "i94res": spark.createDataFrame([(589, "No Country Code (589)")], ints),
        "i94visa": spark.createDataFrame([(2, "Pleasure"), (3, "Student")], ints),
    }
    clean = arrivals.clean_arrivals(raw, dictionaries)
    assert clean.schema.simpleString() == schemas.struct(schemas.ARRIVALS).simpleString()
    cols = ["cicid", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate", "i94visa", "dtadfile", "dtaddto"]
    zero = dt.date(1960, 1, 1)
    assert rows(clean.select(*cols)) == [
        ("6", "ECUADOR", "IN_i94res_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW", "IN_i94port_DICTIONARY_BUT_NO_PORT_CODE",
         dt.date(2016, 4, 29), "NOT_IN_i94mode_DICTIONARY", "NOT_IN_i94addr_DICTIONARY", zero, "Pleasure", zero, dt.date(2016, 10, 28)),
        ("7", "IN_i94cit_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW", "NOT_IN_i94res_DICTIONARY", "ATLANTA, GA",
         dt.date(2016, 4, 7), "Air", "ALABAMA", dt.date(2016, 8, 25), "Student", dt.date(2013, 8, 11), zero),
    ]


def test_temperature(spark):
    raw = spark.sql(
        """SELECT * FROM VALUES
        (date'2003-03-01', 19.0D, 0.1D, 'Laredo', 'United States', '28.13N', '99.09W'),
        (date'2004-03-01', 21.0D, 0.1D, 'Laredo', 'United States', '28.13N', '99.09W'),
        (date'2005-03-01', double('NaN'), 0.1D, 'Laredo', 'United States', '28.13N', '99.09W'),
        (date'2002-03-01', 99.0D, 0.1D, 'Laredo', 'United States', '28.13N', '99.09W'),
        (date'2003-04-01', 1.0D, 0.1D, 'Nowhere', 'United States', '70.00N', '150.00W'),
        (date'2003-03-01', 6.0D, 0.1D, 'Aarhus', 'Denmark', '57.05N', '10.33E')
        AS t(dt, AverageTemperature, AverageTemperatureUncertainty, City, Country, Latitude, Longitude)"""
    )
    gazetteer = spark.createDataFrame([(1, 27.5, -99.5, "Texas"), (2, 34.0, -118.0, "California"), (3, 65.0, -150.0, "Yukon")], schemas.GAZETTEER)
    states = spark.createDataFrame([("TX", "TEXAS"), ("CA", "CALIFORNIA")], schemas.DICTIONARY_TEXT_KEY)
    assert rows(arrivals.clean_temperature(raw, gazetteer, states)) == [
        (3, 1, "Laredo", "Texas", "TX", "LAREDO, TX", 20.0), (4, 1, "Nowhere", "Yukon", None, "NOWHERE", 1.0),
    ]


def test_airports_and_country_names(spark):
    raw = spark.createDataFrame(
        [
            ("00A", "heliport", "Total Rf", 11, "NA", "US", "US-PA", "Bensalem", None, None, None, "-74.93, 40.07"),
            ("00B", "closed", "No Dash", 12, "NA", "US", "US", None, None, None, None, "bad"),
            ("00C", "closed", "Far", 13, "EU", "DK", "DK-81", "Aarhus", None, None, None, None),
        ],
        schemas.AIRPORTS_RAW,
    )
    clean = arrivals.clean_airports(raw)
    assert clean.columns == schemas.names(schemas.AIRPORTS)
    assert rows(clean.select("ident", "region", "municipality_region")) == [("00A", "PA", "BENSALEM, PA"), ("00B", None, "")]
    codes = spark.createDataFrame([("United States", "US")], schemas.COUNTRY_CODES)
    details = arrivals.airport_details(raw, codes)
    assert rows(details.select("ident", "longitude", "latitude", "iso_country_fullname")) == [
        ("00A", -74.93, 40.07, "United States"), ("00B", None, None, "United States"), ("00C", None, None, None),
    ]


def test_demographics(spark):
    raw = spark.createDataFrame(
        [("Silver Spring", "Maryland", 33.8, 1, 2, 3, 4, 5, 2.6, "MD", "White", 6)], schemas.struct(schemas.DEMOGRAPHICS_RAW)
    )
    clean = arrivals.clean_demographics(raw)
    assert clean.columns == schemas.names(schemas.DEMOGRAPHICS)
    assert clean.select("median_age", "foreign_born", "city_state_code").first() == (33.8, 5, "SILVER SPRING, MD")


def test_latest_users_meet_as_versions(spark):
    row = "struct<ts:long,userId:string,firstName:string,lastName:string,gender:string,level:string>"
    data = [(t, "u", "A", "B", "F", "free" if t < 5 else "paid") for t in range(9)] + [(None, "u", "A", "B", "F", "void"), (None, "n", "C", "D", "M", "free")]
    played = spark.createDataFrame(data, row)
    found = listens.latest_users(played)
    assert sorted(tuple(r) for r in found.collect()) == [("n", "C", "D", "M", "free"), ("u", "A", "B", "F", "paid")]
    # the plays themselves are counted up by hash, not sorted
    assert "HashAggregate" in found._jdf.queryExecution().executedPlan().toString()


def test_query_tables_sort_after_the_shuffle(spark):
    names = "session_id long, item_in_session int, artist string, song_title string, length double, ts double"
    events = spark.createDataFrame([(1, 1, "a", "s", 2.0, 5.0), (1, 1, "b", "t", 3.0, 6.0), (2, 1, "a", "s", 2.0, 5.0)], names)
    table = query_tables.keyed_table(events, "session_items", ["ts"])
    assert sorted(tuple(r) for r in table.collect()) == [(1, 1, "b", "t", 3.0), (2, 1, "a", "s", 2.0)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert "Aggregate" not in initial[initial.index("Exchange"):]


def test_lake_brings_folders_together_before_it_sorts(spark, music, monkeypatch):
    """A writer sorts what its task holds, and a scan's task holds many times what a shuffle's does."""
    plans = {}

    def spied(df, path, *args, **kwargs):
        if path.endswith("/songplays"):
            plans[path] = kwargs.get("rebalance", True)
        return write_parquet(df, path, *args, **kwargs)

    monkeypatch.setattr(lake, "write_parquet", spied)
    fact = lake.run_lake(spark, *music)
    assert list(plans.values()) == [True]
    assert sorted(r[0] for r in fact.select("songplay_id").collect()) == list(range(1, 1 + fact.count()))


def test_plays_without_repeats_are_staged_as_they_are(spark, music):
    """Whole rows are moved only where hashes repeat, so that a log without repeats is written once."""
    in_dir, out = music
    log = read_json(spark, f"{in_dir}/log_data", schemas.LISTEN_LOG, recursive=True)
    once = listens.staged_plays(log.where("itemInSession < 2"), f"{out}/a", distinct=True)
    assert once.count() == 4 and not Path(f"{out}/a-once/rows").exists()
    assert {Path(f).parent.name for f in once.inputFiles()} == {"a"}
    # and where rows repeat, each is kept once
    both = listens.staged_plays(log, f"{out}/b", distinct=True)
    assert rows(both) == rows(listens.plays(log).distinct().select(*listens.PLAY_COLUMNS)) and both.count() == 5


def test_temperature_reads_the_measurements_once(spark, tmp_path):
    raw = spark.createDataFrame(
        [(dt.date(2010, 1, 1), t, 0.1, "Town", "United States", "10.00N", "20.00W") for t in (1.0, 2.0)],
        schemas.TEMPERATURE_RAW,
    )
    raw.write.csv(str(tmp_path / "measured"))
    raw = spark.read.schema(schemas.TEMPERATURE_RAW).csv(str(tmp_path / "measured"))
    places = spark.createDataFrame([("p", 10.0, -20.0, "Ohio")], "place_id STRING, lat DOUBLE, lon DOUBLE, admin1 STRING")
    states = spark.createDataFrame([("OH", "OHIO")], schemas.DICTIONARY_TEXT_KEY)
    got = arrivals.clean_temperature(raw, places, states)
    assert rows(got.select("month", "day", "state_code", "avg_temperature")) == [(1, 1, "OH", 1.5)]
    # the mean is stored, so neither the search nor the join that follows it reads the measurements again
    assert not [f for f in got.inputFiles() if "measured" in f]


def test_tables_are_written_compressed(spark, music):
    in_dir, out = music
    warehouse.run_warehouse(spark, in_dir, out)
    codecs = {
        pq.ParquetFile(f).metadata.row_group(0).column(0).compression
        for f in Path(out).rglob("*.parquet") if pq.ParquetFile(f).metadata.num_row_groups
    }
    assert codecs == {"ZSTD"}
