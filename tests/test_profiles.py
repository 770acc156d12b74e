import pytest
from pyspark.sql import functions as F

from basketry.session import work_path
from basketry.sources import landing, profiles
from basketry.sources.publish import filesystem

NAN = float("nan")


def day(spark, n, shift=0):
    i = F.col("id") + shift
    return spark.range(n).select(
        (i % 700).alias("user"), F.concat(F.lit("p"), i % 90).alias("item"),
        F.when(i % 11 == 0, None).when(i % 13 == 0, NAN).otherwise(i / 3).alias("x"), F.array(i % 3).alias("tags"),
    )


def check(spark, path, states):
    """The profile against a scan of all files."""
    df = spark.read.parquet(path).drop("ingest_date")
    n = df.count()
    got = {r["column"]: r for r in profiles.profile(spark, states).collect()}
    assert set(got) == set(df.columns)
    for c in df.columns:
        x = F.when(~F.isnan(c), F.col(c)) if c == "x" else F.col(c)
        exact = df.agg(F.count(x).alias("n"), F.count_distinct(x).alias("d")).first()
        assert (got[c].n_rows, got[c].n_null) == (n, n - exact.n)
        assert abs(got[c].n_distinct - exact.d) <= max(1, profiles.DISTINCT_ERROR * exact.d)
        if c in ("user", "x"):
            low, high = df.agg(F.min(x), F.max(x)).first()
            assert (got[c].low, got[c].high) == (low, high)
            for share, value in zip(profiles.QUANTILES, got[c].quantiles):
                under, upto = df.agg(F.count_if(x < value), F.count_if(x <= value)).first()
                assert under / exact.n - profiles.RANK_ERROR <= share <= upto / exact.n + profiles.RANK_ERROR
        else:
            assert got[c].low is None and got[c].quantiles is None


def test_only_new_dates_are_read(spark):
    path, states = work_path(spark, "landing"), work_path(spark, "states")
    landing.land(day(spark, 3000), path, "2024-01-01")
    landing.land(day(spark, 2000, 5000), path, "2024-01-02")
    assert profiles.refresh(spark, path, states) == ["2024-01-01", "2024-01-02"]
    check(spark, path, states)
    landing.land(day(spark, 4000, 9000), path, "2024-01-03")
    assert profiles.refresh(spark, path, states) == ["2024-01-03"]
    check(spark, path, states)
    assert profiles.refresh(spark, path, states) == []
    (counts,) = profiles.profile(spark, states, first="2024-01-02", last="2024-01-02").where("column = 'user'").collect()
    assert (counts.n_rows, counts.n_dates) == (2000, 1)
    row = profiles.sparsity(profiles.profile(spark, states), "user", "item").first()
    assert row.n_rows == 9000 and row.sparsity == pytest.approx(1 - 9000 / (700 * 90), abs=0.02)


def test_dates_landed_again_and_gone(spark):
    path, states = work_path(spark, "landing"), work_path(spark, "states")
    for d in ("2024-01-01", "2024-01-02"):
        landing.land(day(spark, 1000), path, d)
    profiles.refresh(spark, path, states)
    landing.land(day(spark, 1500), path, "2024-01-01")
    assert profiles.refresh(spark, path, states) == ["2024-01-01"]
    check(spark, path, states)
    place, fs = filesystem(spark, f"{path}/ingest_date=2024-01-02")
    fs.delete(place, True)
    assert profiles.refresh(spark, path, states) == []
    check(spark, path, states)


def test_a_column_that_a_date_lacks(spark):
    path, states = work_path(spark, "landing"), work_path(spark, "states")
    landing.land(spark.createDataFrame([(1,), (2,)], "a int"), path, "2024-01-01")
    landing.land(spark.createDataFrame([(3, "x")], "a int, b string"), path, "2024-01-02")
    landing.land(spark.createDataFrame([], "a int, b string"), path, "2024-01-03")
    profiles.refresh(spark, path, states)
    got = {r["column"]: (r.n_rows, r.n_null, r.low, r.high, r.n_distinct) for r in profiles.profile(spark, states).collect()}
    assert got == {"a": (3, 0, 1.0, 3.0, 3), "b": (3, 2, None, None, 1)}
    assert profiles.profile(spark, work_path(spark, "none")).collect() == []
