from pyspark.sql import functions as F

from basketry.operators import dedup, encode, impute, profile


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_keep_first_null_keys_are_equal(spark):
    df = spark.createDataFrame([(0, 1, "a"), (1, 1, "b"), (2, None, "c"), (3, None, "d")], "seq int, k int, v string")
    assert rows(dedup.keep_first(df, ["k"], ["seq"]), "seq") == [(0, 1, "a"), (2, None, "c")]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert rows(dedup.duplicate_rows(df)) == [(3, 1)]
    wide = spark.createDataFrame(
        [("x" * 200, None, 0.0), ("x" * 200, None, -0.0), ("x" * 200, "", 0.0), ("x" * 200, "null", 0.0)],
        "a string, b string, c double",
    )
    assert rows(dedup.duplicate_rows(wide)) == [(4, 1)]


def test_duplicate_rows_of_nothing(spark):
    assert rows(dedup.duplicate_rows(spark.createDataFrame([], "a string"))) == [(0, 0)]


def test_median_impute(spark):
    for values, expected in (([1, 2, 4, None], 2.0), ([1, 2, 4, 9, None], 3.0), ([None, None], None)):
        df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
        filled = [r[0] for r in impute.median_impute(df, ["x"]).collect()]
        assert filled == [expected if v is None else float(v) for v in values]


def test_bracketed_median_is_exact(spark):
    for n in (1, 2, 999, 5000):
        df = spark.range(n).select((F.hash("id") / 7.0).alias("x"))
        expected = df.agg(F.median("x")).first()[0]
        assert impute.bracketed_median(df, "x", max_values=20, accuracy=200) == expected


def test_bracketed_median_with_heavy_values(spark):
    heavy = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 42.0).otherwise(F.col("id") * 1.0).alias("x"))
    expected = heavy.agg(F.median("x")).first()[0]
    assert impute.bracketed_median(heavy, "x", max_values=10, accuracy=100) == expected
    only = spark.range(500).select(F.lit(3.0).alias("x"))
    assert impute.bracketed_median(only, "x", max_values=10, accuracy=100) == 3.0
    assert impute.bracketed_median(spark.createDataFrame([(None,)], "x double"), "x") is None


def test_label_encode(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "a")], "i int, x string")
    assert [r[-1] for r in rows(encode.label_encode(df, {"x": "c"}), "i")] == [1, 0, -1, 0]


def test_label_encode_large_dictionary_gives_the_same_codes(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 11 != 0, F.concat(F.lit("v"), F.hash("id") % 977)).alias("x"))
    small = encode.label_encode(df, {"x": "c"})
    large = encode.label_encode(df, {"x": "c"}, max_bytes=0)
    assert small.select("id", "c").exceptAll(large.select("id", "c")).isEmpty()
    codes = {r.c for r in large.select("c").distinct().collect()}
    assert codes == set(range(-1, len(codes) - 1))


def test_minmax(spark):
    df = spark.createDataFrame([(5.0, 1.0, None), (5.0, 3.0, None), (5.0, None, None)], "a double, b double, c double")
    scaled = encode.minmax_scale(df, {"a": "sa", "b": "sb", "c": "sc"})
    assert sorted(rows(scaled.select("sa", "sb", "sc")), key=str) == sorted(
        [(0.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, None, 0.0)], key=str
    )


def test_clip(spark):
    df = spark.createDataFrame([(0, -2.0), (1, 3.0), (2, None)], "i int, x double")
    assert [r[0] for r in df.orderBy("i").select(encode.clip_at_zero(F.col("x"))).collect()] == [0.0, 3.0, None]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5)] + [(None,)], "x double")
    assert [r[3] for r in rows(profile.histogram(df, "x"), "bin")] == [1, 1, 1, 1, 1]
    flat = rows(profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x"), "bin")
    assert [r[3] for r in flat] == [0, 0, 2, 0, 0]
    assert (flat[0][1], flat[4][2]) == (1.5, 2.5)


def test_sparsity_of_nothing(spark):
    empty = spark.createDataFrame([], "u int, i int")
    assert rows(profile.matrix_sparsity(empty, "u", "i")) == [(0, 0, 0, None)]
