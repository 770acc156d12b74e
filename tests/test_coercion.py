from pyspark.sql import functions as F

from basketry.functions import coercion, temporal, text
from basketry.operators import quality


def column(spark, values, type_="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")


def evaluate(df, *exprs):
    return [tuple(r) for r in df.orderBy("i").select(*exprs).collect()]


TEXTS = ["4.6 out of 5 stars", "1e5", " 7 ", "1d", "1_000", "abc", None]


def test_numbers(spark):
    x = F.col("x")
    df = column(spark, TEXTS)
    strict = coercion.to_number(x)
    loose = coercion.to_number_or_embedded(x)
    got = evaluate(df, strict, loose, coercion.malformed(x, loose))
    assert [r[0] for r in got] == [None, 100000.0, 7.0, None, None, None, None]
    assert [r[1] for r in got] == [4.6, 100000.0, 7.0, 1.0, 1.0, None, None]
    assert [r[2] for r in got] == [False, False, False, False, False, True, False]


def test_extract_only(spark):
    df = column(spark, ["1e5", ".5", "-3", "abc", None])
    got = evaluate(df, F.coalesce(coercion.extract_number(F.col("x")), F.lit(0.0)))
    assert [r[0] for r in got] == [1.0, 0.5, -3.0, 0.0, 0.0]


def test_null_tokens(spark):
    df = column(spark, ["", "NA", "nan", "None", "n/a ", "N/A", "x"])
    got = coercion.null_tokens_to_null(df).orderBy("i").collect()
    assert [r.x for r in got] == [None, None, None, None, "n/a ", None, "x"]


def test_nan_is_null(spark):
    df = coercion.nan_to_null(column(spark, [float("nan"), 1.0], "double"))
    assert [r.x for r in df.orderBy("i").collect()] == [None, 1.0]


def test_email(spark):
    df = column(spark, ["a@b", "ab", None])
    assert [r[0] for r in evaluate(df, quality.invalid_email(F.col("x")))] == [False, True, True]


def test_python_float_text(spark):
    values = [
        0.0, 1.0, -2.5, 41.0, 0.001, 0.0001, 0.00012345, -0.0005, 1e-5, 1.5e-7, 1e7, 12345678.9, -98765432.125, 1e15, 1.25e15,
        1e16, 1.5e300, 123456789012345.6, 9999999.0, float("inf"), float("-inf"), None,
    ]
    df = column(spark, values, "double")
    got = [r[0] for r in evaluate(df, coercion.python_float_text(F.col("x")))]
    assert got == [None if v is None else repr(v) for v in values]


def test_dates(spark):
    df = column(spark, ["2024-01-02", "2024-01-03 10:00:00", "03/04/2024", None])
    assert temporal.infer_format(df, "x", ["i"]) == "yyyy-MM-dd"
    parsed = temporal.parse_datetime(df, "x", "yyyy-MM-dd")
    got = evaluate(df, parsed.isNull(), temporal.year_or_zero(parsed), temporal.month_or_zero(parsed), temporal.hour_or_minus_one(parsed))
    assert got == [(False, 2024, 1, 0), (True, 0, 0, -1), (True, 0, 0, -1), (True, 0, 0, -1)]


def test_dates_without_common_format(spark):
    df = column(spark, ["soon", "2024-01-03 10:00:00", "03/04/2024"])
    assert temporal.infer_format(df, "x", ["i"]) is None
    parsed = temporal.parse_datetime(df, "x", None)
    assert [r[0] for r in evaluate(df, F.date_format(parsed, "yyyy-MM-dd HH"))] == [None, "2024-01-03 10", "2024-03-04 00"]


def test_terms(spark):
    df = column(spark, ["The Über-café, a b2 x_y!", "", None])
    got = [r[0] for r in evaluate(df, text.terms(F.col("x")))]
    assert got == [["the", "über", "café", "b2", "x_y"], [], None]


def test_stop_words(spark):
    words = text.english_stop_words()
    assert len(words) == len(set(words)) == 318
    assert {"a", "the", "sincere", "yourselves", "fifteen"} <= set(words)
    assert not {"just", "t", "did"} & set(words)


def test_oracle_stop_words_equal_sparks(spark):
    from basketry.plans import oracle

    assert oracle.stop_words() == text.english_stop_words()


def test_joined_text(spark):
    df = column(spark, ["a", None])
    assert [r[0] for r in evaluate(df, text.joined_text(F.col("x"), F.lit("b"), F.col("x")))] == ["a b a", " b "]
