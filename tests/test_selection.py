import collections
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import heavy, impute, selection
from basketry.session import materialize

NAN, INF = float("nan"), float("inf")


def columns():
    rng = random.Random(4)
    n = 2001
    wide = [10.0 ** rng.uniform(-300, 300) for _ in range(n)]
    return {
        "ints": [float(rng.randrange(50)) for _ in range(n)],
        "even": [rng.random() for _ in range(n - 1)] + [None],
        "wide": wide,
        "negative": [-v for v in wide],
        "both": [rng.choice((-1, 1)) * v for v in wide],
        "holes": [rng.choice([None, NAN, 3.0, 1.0]) for _ in range(n)],
        "one": [7.5] * n,
        "none": [rng.choice([None, NAN]) for _ in range(n)],
        "ends": [rng.choice([INF, -INF, 0.0, 1e308, -1e308, 5e-324]) for _ in range(n)],
        "skew": [0.0] * 1500 + [float(2**k) for k in range(501)],
        "near": [1.0 + k * 2**-52 for k in range(n)],
    }


def test_medians_of_many_columns(spark):
    data = columns()
    rows = list(zip(*data.values()))
    df = materialize(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)), "numbers")
    got = selection.medians(df, list(data))
    for c, values in data.items():
        known = [v for v in values if v is not None and v == v]
        if not known:
            assert got[c] is None
            continue
        known.sort()
        low, high = known[(len(known) - 1) // 2], known[len(known) // 2]
        assert got[c] == (low if low == high else low / 2 + high / 2), c


def test_any_ranks(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.exponential(3, 500), 2).tolist()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = selection.order_statistics(df, ["x"], lambda n: [0, 1, 250, n - 1])
    assert got["x"] == [sorted(values)[r] for r in (0, 1, 250, 499)]
    assert selection.order_statistics(df, [], lambda n: [0]) == {}
    assert selection.medians(df.limit(0), ["x"]) == {"x": None}


def test_passes_do_not_grow_with_columns(spark, monkeypatch):
    calls = []
    real = selection._histograms
    monkeypatch.setattr(selection, "_histograms", lambda *a: calls.append(1) or real(*a))
    df = spark.range(4000).select(*((F.rand(i) * 100).alias(f"c{i}") for i in range(12)))
    df = materialize(df, "columns")
    selection.medians(df, ["c0"])
    one = len(calls)
    calls.clear()
    selection.medians(df, df.columns)
    assert len(calls) <= one + 2 <= 8


def test_impute_uses_them(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, 2.0), (None, NAN), (NAN, 4.0)], "a double, b double")
    assert [tuple(r) for r in impute.median_impute(df, ["a", "b"]).collect()] == [(1.0, 3.0), (4.0, 2.0), (2.5, 3.0), (2.5, 4.0)]


def zipf(n, seed):
    rng = random.Random(seed)
    return [f"t{int(rng.paretovariate(0.7))}" for _ in range(n)]


@pytest.mark.parametrize("capacity", [4, 64, 1 << 16])
@pytest.mark.parametrize("k", [1, 10, 100])
def test_top_counts_are_exact(spark, capacity, k):
    values = zipf(6000, 3)
    df = materialize(spark.createDataFrame([(v,) for v in [*values, None]], "x string").repartition(5), "values")
    found = heavy.top_counts(df, "x", k, capacity)
    counts = collections.Counter(values)
    assert [tuple(r) for r in found.rows.orderBy(F.desc("n"), "value").collect()] == sorted(counts.items(), key=lambda t: (-t[1], t[0]))[:k]
    (proof,) = found.proof.collect()
    assert proof.proven and proof.outside_at_most < proof.kth_count and proof.n_listed == k
    if capacity == 64 and k == 1:
        assert 0 < proof.outside_at_most and proof.n_candidates < len(counts) / 10


def test_top_counts_of_arrays_and_few_values(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b", None],), ([],), (None,)], "x array<string>")
    assert [tuple(r) for r in heavy.top_counts(df, "x", 5, 2).rows.collect()] == [("a", 2), ("b", 2)]
    (proof,) = heavy.top_counts(df, "x", 5, 2).proof.collect()
    assert proof.proven and proof.n_listed == 2 and proof.outside_at_most == 0
    assert heavy.top_counts(df.limit(0), "x", 5).rows.collect() == []


def test_the_bound_holds_for_every_value():
    import pyarrow as pa

    values = zipf(5000, 9)
    counters = heavy.Counters(20, pa.string())
    for at in range(0, len(values), 300):
        counters.add(pa.array(values[at : at + 300]))
    assert len(counters.values) <= 20 and counters.error > 0
    kept = dict(zip(counters.values.to_pylist(), counters.counts.tolist()))
    for value, n in collections.Counter(values).items():
        assert kept.get(value, 0) <= n <= kept.get(value, 0) + counters.error


def test_arrays_reach_a_task_in_small_batches(spark, monkeypatch):
    """A row may hold a whole text: memory of a task must not follow the session's batch of rows."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []
    materialize_ = heavy.materialize

    def watched(df, name):
        seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return materialize_(df, name)

    monkeypatch.setattr(heavy, "materialize", watched)
    words = [f"w{i % 700}" for i in range(3000)]
    df = spark.createDataFrame([(words,)] * 600 + [([],), (None,)], "x array<string>").repartition(2)
    found = heavy.top_counts(df, "x", 3, 100)
    assert [tuple(r) for r in found.rows.collect()] == [("w0", 3000), ("w1", 3000), ("w10", 3000)]
    assert {int(n) for name, n in seen if name == "counters"} == {heavy.ARRAYS}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
