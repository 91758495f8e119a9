import datetime as dt
import importlib.util
import json
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from starfold.operators import keyed
from starfold.queries import QUERIES
from starfold.sinks import files as sinks
from starfold.sinks.buckets import KeyedTable, save_bucketed
from starfold.sources import files as sources
from starfold.streaming import ingest

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- the entry without the optional subpackage ----------------------------------------------------


def test_entry_without_the_training_text_subpackage(monkeypatch):
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "starfold.llm" else find(name, *a))
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("starfold.llm")]:
        monkeypatch.delitem(sys.modules, name)
    found = contract.queries()
    assert set(found) == set(QUERIES) and set(contract.oracle_sql()) <= set(found)
    assert not any(m == "corpus_pipeline" or m.startswith("starfold.llm") for m in sys.modules)


# ---- bucketed tables ------------------------------------------------------------------------------


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast, tmp_path):
    left = spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    right = spark.range(60).select(F.col("id").alias("key"), (F.col("id") * 2).alias("y"))
    a = save_bucketed(left, "bucketed_left", ["k"], 8, ["k", "x"], str(tmp_path / "a"))
    b = save_bucketed(right, "bucketed_right", ["key"], 8, location=str(tmp_path / "b"))
    joined = a.join(b, F.col("k") == F.col("key"))
    assert "Exchange" not in plan(joined) and "SelectedBucketsCount: 8 out of 8" in plan(joined)
    assert rows(joined.select("x", "y")) == rows(left.join(right, F.col("k") == F.col("key")).select("x", "y"))
    # sums by the key need no shuffle either
    assert "Exchange" not in plan(a.groupBy("k").count())
    # a layout that Spark does not know of is shuffled again
    sinks.write_parquet(sinks.clustered(left, "k", ["k"]), str(tmp_path / "c"))
    plain = spark.read.parquet(str(tmp_path / "c"))
    assert "Exchange" in plan(plain.join(b, F.col("k") == F.col("key")))
    assert len(list((tmp_path / "a").glob("part-*"))) == 8


def test_bucketed_join_query_moves_neither_table(spark, no_broadcast):
    text = plan(QUERIES["bucketed_join"](spark, SF_DIR))
    join = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in join and join.count("SelectedBucketsCount: 32 out of 32") == 2


def test_saving_again_replaces_the_table(spark, tmp_path):
    for n in (5, 3):
        table = save_bucketed(spark.range(n).toDF("k"), "bucketed_again", ["k"], 4, location=str(tmp_path / "t"))
    assert table.count() == 3


# ---- keyed folders --------------------------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "keyed"), "k BIGINT, t INT, v STRING", ("k",), 16)


def batch(spark, *values):
    return spark.createDataFrame(list(values), "k bigint, t int, v string")


def upsert(old, new):
    return keyed.upsert_full(old, new, ["k"], ["t"])


def test_merge_reads_and_writes_the_folders_of_its_keys(spark, table, tmp_path):
    assert table.rows().collect() == []
    assert table.merge(batch(spark, *[(k, 1, "a") for k in range(200)]), upsert) == 16
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "keyed").rglob("part-*")}
    small = batch(spark, (7, 2, "b"), (500, 1, "new"))
    touched = table.merge(small, upsert)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "keyed").rglob("part-*")}
    folders = {p.parent.name for p in set(before) ^ set(after)}
    assert len(folders) == touched <= 2
    assert sum(before[p] == after[p] for p in set(before) & set(after)) == 16 - touched
    assert rows(table.rows()) == rows(batch(spark, *[(k, 1, "a") for k in range(200) if k != 7], (7, 2, "b"), (500, 1, "new")))
    # the scan of the part that a batch meets is pruned to its files
    part = table.part(small)
    assert len(part.inputFiles()) == touched and "PartitionFilters: [isnotnull(folder" in plan(part) or "folder#" in plan(part)


def test_merge_twice_changes_nothing_and_older_rows_undo_nothing(spark, table):
    for values in ([(1, 5, "x"), (None, 1, "n")], [(1, 3, "old")], [(None, 2, "m")], [(None, 2, "m")]):
        table.merge(batch(spark, *values), upsert)
    assert rows(table.rows()) == rows(batch(spark, (1, 5, "x"), (None, 2, "m")))
    assert table.merge(batch(spark), upsert) == 0 and table.rows().count() == 2


def test_insert_absent_adds_first_rows_of_new_keys(spark, table):
    table.insert_absent(batch(spark, (1, 2, "b"), (1, 1, "a"), (None, 1, "n")), ["t"])
    assert table.insert_absent(batch(spark, (1, 0, "late"), (None, 0, "late"), (2, 1, "c")), ["t"]) <= 3
    table.insert_absent(batch(spark, (2, 1, "c")), ["t"])
    assert rows(table.rows()) == rows(batch(spark, (1, 1, "a"), (None, 1, "n"), (2, 1, "c")))


def test_another_number_of_folders_is_refused(spark, table):
    table.merge(batch(spark, (1, 1, "a")), upsert)
    with pytest.raises(ValueError, match="16 folders"):
        KeyedTable(spark, table.path, table.schema, table.keys, 8).rows()


def files_of(folder):
    return sorted(folder.rglob("part-*.parquet"))


def test_compaction_in_the_same_table(spark, table, tmp_path):
    for first in range(0, 200, 40):
        table.insert_absent(batch(spark, *[(k, 1, "a") for k in range(first, first + 40)]), ["t"])
    before, many = rows(table.rows()), files_of(tmp_path / "keyed")
    assert len(many) > 32 and table.compact() == 16
    assert len(files_of(tmp_path / "keyed")) == 16 and rows(table.rows()) == before
    assert table.compact() == 0
    table.insert_absent(batch(spark, (1000, 1, "a")), ["t"])
    kept = set(files_of(tmp_path / "keyed"))
    assert table.compact(most=2) == 0 and table.compact() == 1
    # only the folder with two files was written again
    assert len(kept - set(files_of(tmp_path / "keyed"))) == 2


# ---- ingest into keyed folders --------------------------------------------------------------------


def put(folder, name, *values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("k", "t", "v"), v))) for v in values))


def test_ten_ingests_leave_a_bounded_number_of_files(spark, table, tmp_path):
    src, truth = tmp_path / "src", {}

    def run(progress="progress", **options):
        ingest.merge_new_files(table, str(src), table.schema, str(tmp_path / progress), ["t"], **options)
        return rows(table.rows())

    for n in range(10):
        new = [((n * 17 + i) % 90, n - i % 3, f"{n}-{i}") for i in range(40)]
        put(src, f"{n}.json", *new)
        for k, t, v in new:
            truth[k] = max(truth.get(k, (t, v)), (t, v), key=lambda row: row[0])
        expected = sorted(((k, t, v) for k, (t, v) in truth.items()), key=str)
        assert [r[0] for r in run()] == [r[0] for r in expected]
        assert len(files_of(tmp_path / "keyed")) <= 16
    before, stamps = rows(table.rows()), {p: p.stat().st_mtime_ns for p in files_of(tmp_path / "keyed")}
    assert [r[:2] for r in before] == [r[:2] for r in expected]
    # nothing new: nothing is written
    assert run() == before and {p: p.stat().st_mtime_ns for p in files_of(tmp_path / "keyed")} == stamps
    # the progress is lost: all files are read again, several a batch, and bring nothing new
    again = run("other", max_batch_bytes=2_000)
    assert [r[:2] for r in again] == [r[:2] for r in before] and len(files_of(tmp_path / "keyed")) <= 16


def test_small_batch_leaves_other_folders_alone(spark, table, tmp_path):
    src = tmp_path / "src"
    put(src, "all.json", *[(k, 1, "a") for k in range(200)])
    ingest.merge_new_files(table, str(src), table.schema, str(tmp_path / "progress"), ["t"])
    stamps = {p: p.stat().st_mtime_ns for p in files_of(tmp_path / "keyed")}
    put(src, "one.json", (7, 2, "b"), (7, 3, "c"), (7, 0, "old"))
    ingest.merge_new_files(table, str(src), table.schema, str(tmp_path / "progress"), ["t"])
    same = [p for p in files_of(tmp_path / "keyed") if stamps.get(p) == p.stat().st_mtime_ns]
    assert len(stamps) == 16 and len(same) == 15
    assert (7, 3, "c") in rows(table.rows()) and table.rows().count() == 200


def test_files_that_were_merged_are_archived(spark, table, tmp_path):
    src, archive = tmp_path / "src", tmp_path / "archive"
    for n in range(3):
        put(src, f"{n}.json", (n, 1, "a"))
        ingest.merge_new_files(
            table, str(src), table.schema, str(tmp_path / "progress"), ["t"], archive_dir=str(archive)
        )
    # those of the last batch wait for the next one
    assert [p.name for p in src.glob("*.json")] == ["2.json"]
    assert sorted(p.name for p in archive.rglob("*.json")) == ["0.json", "1.json"]
    assert rows(table.rows()) == [(0, 1, "a"), (1, 1, "a"), (2, 1, "a")]


# ---- lookups by filters in the files --------------------------------------------------------------


def scanned(df):
    """The rows that the scan of ``df`` read, and the result."""
    result = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value(), result


def test_lookup_reads_only_row_groups_that_may_hold_the_key(spark, tmp_path):
    # keys in no order, so that extremes of row groups say nothing
    df = spark.range(0, 200_000, 1, 8).select(F.xxhash64("id").alias("key"), "id", F.hash("id").cast("string").alias("name"))
    sinks.write_parquet(df, str(tmp_path / "plain"))
    sinks.write_parquet(df, str(tmp_path / "filtered"), bloom={"key": 25_000, "name": 25_000})
    wanted = df.where("id = 77777").first()
    for condition in (F.col("key") == wanted.key, F.col("name") == wanted.name, F.col("key").isin(wanted.key, 5)):
        read, result = scanned(spark.read.parquet(str(tmp_path / "filtered")).where(condition))
        assert [tuple(r) for r in result] == [tuple(wanted)] and read <= 50_000
        read, result = scanned(spark.read.parquet(str(tmp_path / "plain")).where(condition))
        assert [tuple(r) for r in result] == [tuple(wanted)] and read == 200_000
    # a key that no file has
    assert scanned(spark.read.parquet(str(tmp_path / "filtered")).where(F.col("key") == 12345))[0] <= 25_000


# ---- slices ---------------------------------------------------------------------------------------


def test_replaced_slice_keeps_no_stale_partition(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "x int, y string, m int"
    first = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b:c", 1), (4, None, 1)], schema)
    sinks.write_parquet(first, path, ["y", "m"])
    sinks.replace_slice(spark.createDataFrame([(9, "a", 2)], schema), path, {"y": "a"}, ["m"])
    assert rows(spark.read.parquet(path)) == rows(spark.createDataFrame([(9, "a", 2), (3, "b:c", 1), (4, None, 1)], schema))
    for value, left in (("b:c", [(9, "a", 2), (4, None, 1)]), (None, [(9, "a", 2)])):
        sinks.replace_slice(first.limit(0), path, {"y": value}, ["m"])
        assert rows(spark.read.parquet(path)) == rows(spark.createDataFrame(left, schema))


def test_rows_outside_the_slice_change_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "x int, y string"
    sinks.write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["y"])
    for wrong in ("b", None):
        with pytest.raises(Exception, match="outside the slice"):
            sinks.replace_slice(spark.createDataFrame([(3, "a"), (4, wrong)], schema), path, {"y": "a"})
    assert (2, "b") in rows(spark.read.parquet(path))


# ---- staging --------------------------------------------------------------------------------------


def lines(tmp_path, *values):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / "a.json").write_text("\n".join(v if isinstance(v, str) else json.dumps(v) for v in values) + "\n")
    return str(tmp_path / "in")


def test_one_spelling_is_read_by_the_typed_reader(spark, tmp_path):
    path = lines(tmp_path, {"userId": 1, "Ts": 5, "x": {"y": [1]}}, {"userId": 2}, {"Ts": 7})
    df = sources.stage(spark, path, "userid INT, ts BIGINT, nothing STRING")
    assert "Scan json" in plan(df) or "FileScan json" in plan(df)
    assert rows(df) == rows(spark.createDataFrame([(1, 5, None), (2, None, None), (None, 7, None)], "a int, b bigint, c string"))


def test_several_spellings_in_one_line(spark, tmp_path):
    path = lines(tmp_path, {"A": 1, "a": 2}, {"A": 3}, {"a": 4, "B": "z"}, {})
    df = sources.stage(spark, path, "a INT, b STRING")
    assert rows(df) == rows(spark.createDataFrame([(2, None), (3, None), (4, "z"), (None, None)], "a int, b string"))


@pytest.mark.parametrize("value", ["abc", 5.5, True])
@pytest.mark.parametrize("other", [{"TS": 1}, {"ts": 1}])
def test_strict_fails_on_a_wrong_type_either_way(spark, tmp_path, value, other):
    path = lines(tmp_path, {"ts": value, "k": 1}, other)
    schema = "ts BIGINT, k INT"
    assert (None, 1) in rows(sources.stage(spark, path, schema))
    for mapping in (None, {"t": "ts"}):
        with pytest.raises(Exception, match="(?i)malformed"):
            sources.stage(spark, path, schema, mapping, strict=True).collect()


def test_too_many_spellings(spark, tmp_path):
    path = lines(tmp_path, {f"k{i}": i for i in range(30)})
    with pytest.raises(ValueError, match="over 20"):
        sources.spelled_keys(spark, path, most=20)


def test_rejects_carry_file_line_and_reason(spark, tmp_path):
    good, bad = {"a": 1, "b": "x"}, {"a": "one", "b": "x"}
    path = lines(tmp_path, good, bad, '{"a": 2', "", "[1]", {"b": None}, {"a": 1.5, "b": "y"}, {})
    kept, rejects = sources.stage_with_rejects(spark, path, "a INT, b STRING", str(tmp_path / "staging"))
    assert rows(kept) == rows(spark.createDataFrame([(1, "x"), (None, None), (None, None)], "a int, b string"))
    got = {r.line: (r.reason, r.file.endswith("/in/a.json")) for r in rejects.collect()}
    assert got == {
        json.dumps(bad): ("type of a", True), '{"a": 2': ("malformed", True), "[1]": ("malformed", True),
        '{"a": 1.5, "b": "y"}': ("type of a", True),
    }
    with pytest.raises(sources.RejectedLines, match="4 lines rejected, 3 allowed"):
        sources.stage_with_rejects(spark, path, "a INT, b STRING", str(tmp_path / "staging"), most=3)


def test_months_with_missing_columns_and_wider_types(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    spark.createDataFrame([(1, 1.5, day)], "x int, f float, d date").write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(2**40, "s")], "x bigint, s string").write.parquet(f"{tmp_path}/b")
    df = sources.read_widened(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert df.schema.simpleString() == "struct<x:bigint,f:float,d:date,s:string>"
    assert rows(df) == rows(spark.createDataFrame([(1, 1.5, day, None), (2**40, None, None, "s")], df.schema))
    assert rows(df.where("x > 5").select("s")) == [("s",)]
    spark.createDataFrame([("t",)], "x string").write.parquet(f"{tmp_path}/c")
    with pytest.raises(ValueError, match="column x is bigint in some files and string"):
        sources.read_widened(spark, [f"{tmp_path}/{k}" for k in "bc"])


# ---- merges by time -------------------------------------------------------------------------------


def test_base_of_other_times_is_not_read(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "at TIMESTAMP, n INT"
    day = dt.datetime(2018, 11, 1)
    for n in range(3):
        some = [(day + dt.timedelta(days=30 * n, minutes=i), n) for i in range(100)]
        sinks.write_parquet(spark.createDataFrame(some, schema).coalesce(1), f"{path}/batch={n}")
    sinks.write_parquet(spark.createDataFrame([(None, 9)], schema).coalesce(1), f"{path}/batch=3")
    base = spark.read.parquet(path)
    delta = spark.createDataFrame([(day + dt.timedelta(days=30, minutes=i), 5) for i in (7, 99, 100)] + [(None, 5)], schema)
    near = keyed.in_time_of(base, delta, "at")
    read, result = scanned(near)
    assert read <= 101 and len(result) == 94
    for whole in (base, near):
        assert rows(keyed.absent_rows(whole, delta, ["at"], ["n"])) == [(day + dt.timedelta(days=30, minutes=100), 5)]
    # a delta without times meets only rows without one
    timeless = delta.where("at is null")
    assert rows(keyed.in_time_of(base, timeless, "at").select("n")) == [(9,)]
    assert keyed.absent_rows(keyed.in_time_of(base, timeless, "at"), timeless, ["at"], ["n"]).collect() == []
    assert keyed.in_time_of(base, delta.limit(0), "at").where("at is not null").collect() == []
