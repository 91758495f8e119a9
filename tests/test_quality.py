import pytest

from starfold.operators import quality


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")


def result(checks):
    return [(r.column_name, r.failing_rows, r.passed) for r in checks.collect()]


def test_not_null(df):
    assert result(quality.not_null(df, "t", ["k", "v"])) == [("k", 0, True), ("v", 1, False)]


def test_not_null_of_empty_table(df):
    assert result(quality.not_null(df.limit(0), "t", ["k"])) == [("k", 0, True)]


def test_unique_key(df):
    assert result(quality.unique_key(df, "t", ["k"])) == [("k", 1, False)]
    assert result(quality.unique_key(df, "t", ["k", "v"])) == [("k,v", 0, True)]


def test_allowed_counts_nulls(df):
    assert result(quality.allowed(df, "t", "v", ["a", "b"])) == [("v", 1, False)]
    assert result(quality.allowed(df, "t", "k", [1, 2])) == [("k", 0, True)]


def test_referential_counts_rows_not_keys(spark, df):
    parent = spark.createDataFrame([(2,)], "id int")
    assert result(quality.referential(df, "t", "k", parent, "id")) == [("k", 2, False)]
    assert result(quality.referential(df, "t", "k", df, "k")) == [("k", 0, True)]


def test_not_empty(df):
    assert result(quality.not_empty(df, "t")) == [("*", 0, True)]
    assert result(quality.not_empty(df.limit(0), "t")) == [("*", 1, False)]


def test_profile(df):
    got = [tuple(r) for r in quality.profile(df, "t", distinct=True).collect()]
    assert got == [("t", "k", 3, 0, "1", "2", 2), ("t", "v", 3, 1, "a", "b", 2)]


def test_assert_quality(df):
    quality.assert_quality(quality.not_null(df, "t", ["k"]))
    with pytest.raises(quality.QualityError, match="t.v: not_null fails on 1 rows"):
        quality.assert_quality(quality.not_null(df, "t", ["k", "v"]))


def test_enforced_constraint_fails_the_write(df, tmp_path):
    quality.enforce_not_null(df, "t", ["k"]).write.parquet(str(tmp_path / "good"))
    with pytest.raises(Exception, match="t.v must not be null"):
        quality.enforce_not_null(df, "t", ["v"]).write.parquet(str(tmp_path / "bad"))
    assert not (tmp_path / "bad" / "_SUCCESS").exists()


def test_exact_profile_sorts_no_copies_of_rows(spark):
    wide = spark.createDataFrame([(1, "a", 2.0), (2, None, 2.0), (2, "a", None)], "k int, v string, w double")
    found = quality.profile(wide, "t", distinct="exact")
    assert [tuple(r)[1:4] + tuple(r)[-1:] for r in found.collect()] == [("k", 3, 0, 2), ("v", 3, 1, 1), ("w", 3, 1, 1)]
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.n_distinct for r in quality.profile(wide.limit(0), "t", distinct="exact").collect()] == [0, 0, 0]
