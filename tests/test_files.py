import datetime as dt

import pytest
from pyspark.sql import functions as F

from starfold import schemas
from starfold.queries import roles
from starfold.session import shared_dir
from starfold.sinks import files as sinks
from starfold.sources import files as sources
from starfold.streaming import ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_json_by_glob_and_by_folder(spark, tmp_path):
    deep = tmp_path / "2018" / "11"
    deep.mkdir(parents=True)
    (deep / "a.json").write_text('{"x": 1, "T": 1541105830796}\n{"x": 2, "extra": 5}')
    (deep / "readme.txt").write_text("no json")
    schema = "x INT, t BIGINT"
    assert sources.read_json(spark, f"{tmp_path}/*/*/*.json", schema).count() == 2
    assert sources.read_json(spark, str(tmp_path), schema, recursive=True).count() == 2


def test_stage_maps_names_and_times(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"userId": "u", "ts": 1541105830796}\n')
    df = sources.stage(spark, str(tmp_path), "userId STRING, ts BIGINT", {"user_id": "userId", "start": "ts"}, ["start"])
    assert rows(df) == [("u", dt.datetime(2018, 11, 1, 20, 57, 10, 796000))]


def test_csv_latin_1_and_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("City;n\r\nÅrhus;1\r\n\"a;\"\"b\";\r\n".encode("latin-1"))
    assert rows(sources.read_csv(spark, str(tmp_path), "City STRING, n INT", sep=";")) == [('a;"b', None), ("Århus", 1)]


def test_consolidate_drops_rows_without_artist(spark, tmp_path):
    head = ",".join(schemas.names(schemas.EVENT_CSV))
    row = "{},Logged In,Ann,F,4,Lee,100.5,free,Rome,PUT,NextSong,1.5E+12,338,Song,200,1.54E+12,10"
    (tmp_path / "a.csv").write_text("\r\n".join([head, row.format("Faithless"), row.format("")]) + "\r\n")
    (tmp_path / "b.csv").write_text("\r\n".join([head, row.format('"A, B"')]) + "\r\n")
    df = sources.consolidate_csv(spark, str(tmp_path), schemas.EVENT_CSV, schemas.EVENT_COLUMNS, "artist")
    assert df.columns == schemas.EVENT_COLUMNS
    assert sorted(r.artist for r in df.collect()) == ["A, B", "Faithless"]


def test_run_path_and_slice(spark):
    assert sources.run_path("logs/{run_date:%Y/%m}/{run_date:%d}.json", dt.date(2018, 11, 5)) == "logs/2018/11/05.json"
    df = spark.sql("SELECT timestamp'2024-01-16 00:00:00' AS t UNION ALL SELECT timestamp'2024-01-16 23:59:59.999' UNION ALL SELECT timestamp'2024-01-17 00:00:00'")
    assert sources.slice_by_run_date(df, "t", "2024-01-16").count() == 2


def test_slice_reaches_the_scan(spark):
    df = sources.slice_by_run_date(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", "2024-01-16")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in df._jdf.queryExecution().toString()


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    df = spark.range(1000).withColumn("p", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5))
    assert "REBALANCE_PARTITIONS_BY_COL" in sinks.rebalanced(df, "p")._jdf.queryExecution().toString()
    sinks.write_parquet(df, str(tmp_path / "t"), ["p"])
    assert sorted(d.name for d in (tmp_path / "t").glob("p=*")) == [f"p={i}" for i in range(5)]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, ["p"])
    sinks.write_parquet(spark.createDataFrame([(3, "b")], "x int, p string"), path, ["p"], dynamic=True)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_csv_sink_quotes_everything(spark, tmp_path):
    path = tmp_path / "c"
    sinks.write_csv(spark.createDataFrame([(1, 'a "b", c')], "x int, y string").coalesce(1), str(path))
    (part,) = path.glob("part-*")
    assert part.read_text() == '"x","y"\n"1","a ""b"", c"\n'


def test_load_table_writes_the_table_after_a_check(spark, tmp_path):
    path, location = str(tmp_path / "t"), str(tmp_path / "loaded")
    spark.createDataFrame([("a", 1)], "y string, x int").write.parquet(path)
    schema, name = "x INT, y STRING", f"loaded_{abs(hash(path))}"
    assert rows(sinks.load_table(spark, path, schema, name, location=location)) == [(1, "a")]
    assert spark.table(name).columns == ["x", "y"] and spark.read.parquet(location).count() == 1
    assert sinks.load_table(spark, path, schema, name).count() == 2
    assert sinks.load_table(spark, path, schema, name, mode="replace").count() == 1
    with pytest.raises(ValueError, match="x: expected bigint, found int; z: expected int, found no such column"):
        sinks.load_table(spark, path, "x BIGINT, y STRING, z INT", name)
    with pytest.raises(ValueError, match="mode"):
        sinks.load_table(spark, path, schema, name, mode="other")
    assert spark.table(name).count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_staging_ignores_case_and_can_be_strict(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"firstName": "Ann", "USERID": 7, "ts": 1541105830796, "other": {"x": [1]}}\n\n{"userId": "x"}\n')
    schema = "firstname STRING, userid INT, ts BIGINT"
    got = sources.stage(spark, str(tmp_path), schema, recursive=True)
    assert rows(got) == sorted([("Ann", 7, 1541105830796), (None, None, None)], key=str)
    assert got.schema.simpleString() == "struct<firstname:string,userid:int,ts:bigint>"
    (tmp_path / "b.json").write_text('{"firstName": \n')
    assert sources.stage(spark, str(tmp_path), schema, recursive=True).count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.stage(spark, str(tmp_path), schema, recursive=True, strict=True).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.stage(spark, str(tmp_path), "ts BIGINT", {"t": "ts"}, recursive=True, strict=True).collect()


def test_quoted_line_breaks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, 'c "d"\n\n,e'), (3, None)], "x int, y string")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = sources.consolidate_csv(spark, str(tmp_path / "c"), "x INT, y STRING", ["x", "y"], "y", multi_line=True)
    assert rows(back) == [(1, "a\nb"), (2, 'c "d"\n\n,e')]


def test_read_if_present(spark, tmp_path):
    assert sources.read_if_present(spark, str(tmp_path / "none"), "x INT").collect() == []
    spark.range(2).selectExpr("cast(id as int) x").write.parquet(str(tmp_path / "some"))
    assert sources.read_if_present(spark, str(tmp_path / "some"), "x INT").count() == 2


def test_clustered_sorts_within_files(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=4).select((F.col("id") % 10).alias("k"), (-F.col("id")).alias("v"))
    sinks.clustered(df, "k", ["k", "v"]).write.parquet(str(tmp_path / "t"))
    for part in (tmp_path / "t").glob("part-*"):
        got = [tuple(r) for r in spark.read.parquet(str(part)).collect()]
        assert got == sorted(got)


def test_shared_dir_needs_a_setting_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Session:
        sparkContext = Context()

    session = Session()
    session.conf = Conf(None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
    session.conf = Conf("hdfs:///shared/")
    assert shared_dir(session) == "hdfs:///shared"


def test_ingest_takes_new_files_once(spark, tmp_path):
    src, table, progress = (str(tmp_path / d) for d in ("src", "table", "progress"))
    (tmp_path / "src").mkdir()
    schema, keys, order = "k STRING, v INT, ts INT", ["k"], ["ts"]

    def run(**options):
        ingest.ingest_new_files(spark, src, schema, table, progress, keys, order, **options)
        return rows(ingest.current_rows(spark, table, keys, order))

    (tmp_path / "src" / "1.json").write_text('{"k": "a", "v": 1, "ts": 1}\n{"k": "a", "v": 2, "ts": 2}\n{"k": "b", "v": 3, "ts": 1}')
    assert run() == [("a", 2, 2), ("b", 3, 1)]
    assert run() == [("a", 2, 2), ("b", 3, 1)]
    (tmp_path / "src" / "2.json").write_text('{"k": "a", "v": 9, "ts": 0}\n{"k": "b", "v": 4, "ts": 5}\n{"k": "c", "v": 5, "ts": 1}')
    (tmp_path / "src" / "3.json").write_text('{"k": "b", "v": 0, "ts": 4}')
    assert run(max_batch_bytes=1) == [("a", 2, 2), ("b", 4, 5), ("c", 5, 1)]
    assert len(list((tmp_path / "table").glob("stream_id=*/batch_id=*"))) == 3
    ingest.compact(spark, table, str(tmp_path / "small"), keys, order)
    assert rows(ingest.current_rows(spark, str(tmp_path / "small"), keys, order)) == [("a", 2, 2), ("b", 4, 5), ("c", 5, 1)]


def test_ingest_keeps_sources_apart(spark, tmp_path):
    table, schema = str(tmp_path / "table"), "k STRING, v INT, ts INT"
    assert ingest.current_rows(spark, table, ["k"], ["ts"], schema).collect() == []
    for name, key in (("one", "a"), ("two", "b")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.json").write_text(f'{{"k": "{key}", "v": 1, "ts": 1}}')
        ingest.ingest_new_files(spark, str(tmp_path / name), schema, table, str(tmp_path / f"progress-{name}"), ["k"], ["ts"])
    assert rows(ingest.current_rows(spark, table, ["k"], ["ts"])) == [("a", 1, 1), ("b", 1, 1)]
    # a lost progress folder: the files are read again, as another stream
    ingest.ingest_new_files(spark, str(tmp_path / "one"), schema, table, str(tmp_path / "progress-new"), ["k"], ["ts"])
    assert rows(ingest.current_rows(spark, table, ["k"], ["ts"])) == [("a", 1, 1), ("b", 1, 1)]


def test_compressed_json_is_read_beside_plain_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PACKED_ROWS", 10)
    df = spark.range(25).select("id", (F.col("id") % 2).alias("k")).coalesce(1)
    sinks.write_json(df, str(tmp_path / "packed"), ["k"], compression="gzip")
    files = list((tmp_path / "packed").rglob("*.json.gz"))
    # a packed file cannot be split, so it is short
    assert len(files) == 4 and not list((tmp_path / "packed").rglob("*.json"))
    sinks.write_json(spark.range(100, 103), str(tmp_path / "plain"))
    found = sources.read_json(spark, str(tmp_path), "id BIGINT", recursive=True)
    assert sorted(r.id for r in found.collect()) == [*range(25), 100, 101, 102]


def test_listens_are_shuffled_before_their_texts_are_made(spark, tmp_path):
    lines = spark.createDataFrame(
        [(k, k, 1, 1, 2.0, 0.0, "NR"[k % 2], "O", dt.datetime(2024, 1 + k % 3, 1), "Brand#1") for k in range(12)],
        "p_partkey long, l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp, p_brand string",
    )
    plans = []
    write, roles.write_json = roles.write_json, lambda df, *a, **k: (plans.append(df), write(df, *a, **k))
    try:
        roles.write_listens(lines, str(tmp_path), {"log_month": F.month(F.timestamp_millis(roles.heard_at()))})
    finally:
        roles.write_json = write
    text = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Logged In") < text.index("RebalancePartitions") and "userAgent" not in text[text.index("RebalancePartitions"):]
    got = sources.read_json(spark, str(tmp_path), schemas.LISTEN_LOG, recursive=True)
    expected = roles.told(lines)
    assert got.exceptAll(expected.select(*got.columns)).count() == 0 and got.count() == 12


def test_rows_whose_hashes_meet_are_compared_whole(spark, tmp_path):
    """A null leaves a hash as it is, so a text under either column has one hash but is two rows."""
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", None), ("y", "z"), (None, None)], "a STRING, b STRING")
    want = sorted([("x", None), (None, "x"), ("y", "z"), (None, None)], key=str)
    for most in (1_000, 0):
        stored = sinks.materialize(df, str(tmp_path / f"in{most}"))
        got = sinks.distinct_stored(stored, str(tmp_path / f"out{most}"), most)
        assert sorted([tuple(r) for r in got.collect()], key=str) == want
