import re
from math import log, log2, sqrt

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import evaluate, holdout, item_index, recommend, scoring, tfidf
from basketry.session import materialize


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def interactions(spark, data):
    return spark.createDataFrame(data, "review_id int, user_id string, product_id string, review_date string")


def test_holdout(spark):
    df = interactions(spark, [
        (1, "u", "a", None), (2, "u", "b", "2024-01-01"), (3, "u", "c", "2024-01-02"),
        (4, "v", "a", None), (5, "v", "b", None), (6, "w", "a", "2024-01-01"), (7, None, "a", "2024-01-01"), (8, None, "b", "2024-01-02"),
    ])
    train, test = holdout.train_test(df, "user_id", "review_date", "review_id")
    assert [r[0] for r in rows(test, "review_id")] == [3, 5]
    assert [r[0] for r in rows(train, "review_id")] == [1, 2, 4, 6, 7, 8]


def test_popularity_order(spark):
    stats = spark.createDataFrame(
        [("w", 1, 1.0), ("x", 1, 2.0), ("y", 1, 1.0), ("z", 2, None)],
        "product_id string, item_interaction_count long, item_avg_rating double",
    )
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    lists = rows(recommend.recommend_popular(users, stats, 4), "user_id", "rank")
    assert [r[2] for r in lists if r[0] == "u1"] == ["z", "x", "w", "y"]
    assert [r[1:] for r in lists if r[0] == "u2"] == [(1, "z"), (2, "x"), (3, "w"), (4, "y")]


@pytest.fixture(scope="module")
def shop(spark):
    products = spark.createDataFrame(
        [
            ("p1", "red shoe", None, "running shoe", 4, 3.0), ("p2", "blue shoe", "shoes", "walking shoe", 1, 5.0),
            ("p3", "tea pot", "kitchen", "pot for tea", 2, 4.0), ("p4", "tea cup", "kitchen", None, 0, 0.0),
            ("p5", "the of", None, "and", 0, 0.0),
        ],
        "product_id string, product_name string, category string, description string, item_interaction_count long, item_avg_rating double",
    ).repartition(2)
    users = spark.createDataFrame([("u1",), ("cold",), ("lost",), ("all",)], "user_id string")
    history = interactions(spark, [
        (1, "u1", "p1", None), (2, "u1", "p1", None), (3, "u1", "p3", None), (4, "lost", "gone", None),
        *((10 + i, "all", f"p{i}", None) for i in range(1, 6)), (20, "stranger", "p1", None),
    ])
    return products, users, history


def brute_force(products, users, history, popular, k):
    """Dense arithmetic over all items, per user."""
    from basketry.functions.text import english_stop_words

    stop = set(english_stop_words())
    import re

    ids = [r.product_id for r in products]
    docs = [[t for t in re.findall(r"\b\w\w+\b", " ".join(x or "" for x in (r.product_name, r.category, r.description)).lower()) if t not in stop] for r in products]
    vocab = sorted({t for d in docs for t in d})
    m = np.array([[d.count(t) * (log((1 + len(docs)) / (1 + sum(t in e for e in docs))) + 1) for t in vocab] for d in docs])
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
    out = {}
    for u in users:
        own = [p for (v, p) in history if v == u]
        if not own:
            out[u] = popular[:k]
            continue
        scores = sum((m @ m[ids.index(p)] for p in own if p in ids), np.zeros(len(ids)))
        ranked = sorted((-round(s, 9), p) for s, p in zip(scores, ids) if p not in own)
        items = [p for _, p in ranked]
        items += [p for p in popular if p not in items]
        out[u] = items[:k]
    return out


@pytest.mark.parametrize("k", [2, 4])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_content_lists_against_brute_force(spark, shop, monkeypatch, broadcast_bytes, k):
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", broadcast_bytes)
    products, users, history = shop
    lists = rows(recommend.recommend_content(users, products, history, k), "user_id", "rank")
    got = {}
    for user, rank, product, _ in lists:
        got.setdefault(user, []).append(product)
        assert rank == len(got[user])
    popular = [r.product_id for r in recommend.popular_products(products, k).collect()]
    expected = brute_force(
        products.collect(), [r.user_id for r in users.collect()],
        [(r.user_id, r.product_id) for r in history.collect()], popular, k,
    )
    assert got == expected


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_profiles_are_neither_stored_nor_shuffled(spark, shop, monkeypatch, broadcast_bytes):
    """Only the products of a user's history are; profiles are summed where they are compared."""
    products, users, history = shop
    model = recommend.fit_content(products)
    stored = {}

    def recorded(df, name):
        stored[name] = (df.columns, df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, name)

    for module in (recommend, scoring, item_index):
        monkeypatch.setattr(module, "materialize", recorded, raising=False)
    made = recommend.recommend_content(users, products, history, 3, model, broadcast_bytes=broadcast_bytes)
    assert made.count() == 4 * 3
    assert {"history", "histories", "scores"} <= stored.keys()
    assert not any("w" in columns for columns, _ in stored.values())
    assert "Exchange" not in stored["scores"][1]


def test_profiles_summed_for_queries(spark, shop, monkeypatch):
    """The sums of ``user_profiles``, over many slices, with repeated and unknown products and a product listed twice."""
    monkeypatch.setattr(scoring, "SUMMED", 2)
    products, users, history = shop
    products = products.unionByName(products.where("product_id = 'p3'"))
    model = recommend.fit_content(products)
    folded = recommend.history_counts(users, history)
    profiles = {r.user_id: dict(zip(r.idx, r.w)) for r in recommend.user_profiles(folded, model).collect()}
    asked = recommend.profile_queries(folded, model)
    batch = asked.rows.toArrow().combine_chunks().to_batches()[0]
    got = dict(zip(batch.column("q").to_pylist(), asked.vectors(batch)))
    assert got.keys() == profiles.keys() and not got["lost"].any()
    for user, row in got.items():
        assert {int(i): row[i] for i in np.flatnonzero(row)} == pytest.approx(profiles[user])
    seen = dict(zip(batch.column("q").to_pylist(), map(set, batch.column("seen").to_pylist())))
    assert seen == {"u1": {"p1", "p3"}, "lost": set(), "all": {f"p{i}" for i in range(1, 6)}}


def test_cold_users(spark, shop):
    _, users, history = shop
    assert rows(recommend.cold_start_users(users, history)) == [("cold",)]


def test_weights_have_unit_norm(spark, shop):
    model = recommend.fit_content(shop[0])
    norms = model.vectors().select("product_id", F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x).alias("n")).collect()
    assert {r.product_id: round(r.n, 9) for r in norms} == {"p1": 1.0, "p2": 1.0, "p3": 1.0, "p4": 1.0, "p5": 0.0}


def test_vocabulary_cut_by_frequency_then_term(spark):
    items = spark.createDataFrame([(1, "bb aa bb cc"), (2, "cc dd aa")], "i int, t string")
    model = tfidf.fit(items, "i", F.col("t"), max_terms=2, stop_words=["bb"])
    assert (model.terms, model.corpus_freq, model.doc_freq, model.n_items) == (["aa", "cc"], [2, 2], [2, 2], 2)
    assert model.idf == [1.0, 1.0]


def test_empty_vocabulary(spark):
    items = spark.createDataFrame([(1, "the of"), (2, "")], "i int, t string")
    model = tfidf.fit(items, "i", F.col("t"))
    assert model.terms == [] and rows(model.vectors(), "i") == [(1, [], []), (2, [], [])]


def test_similar_items(spark, shop):
    got = {(a, r): b for a, r, b, _ in rows(recommend.similar_items(recommend.fit_content(shop[0]), 2))}
    assert got[("p1", 1)] == "p2" and got[("p3", 1)] == "p4" and ("p5", 1) in got


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_similar_items_shuffle_no_queries(spark, shop, monkeypatch, broadcast_bytes):
    """The items are asked for where their counts are stored; only the index is sorted."""
    plans = {}

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name)

    for module in (scoring, item_index):
        monkeypatch.setattr(module, "materialize", recorded, raising=False)
    assert recommend.similar_items(recommend.fit_content(shop[0]), 2, broadcast_bytes).count() == 5 * 2
    assert "scores" in plans and not any("Exchange" in plans[name] for name in plans.keys() & {"scores", "queries"})


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_top_scores_over_many_blocks(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(item_index, "SHELF", 40)
    monkeypatch.setattr(item_index, "BLOCK", 10)
    monkeypatch.setattr(scoring, "QUERY_BLOCK", 10)
    monkeypatch.setattr(scoring, "DENSE_ITEMS", 16)
    monkeypatch.setattr(scoring, "DENSE_QUERIES", 4)
    rng = np.random.default_rng(7)
    terms = 12

    def vectors(n):
        return [(i, sorted(rng.choice(terms, 3, replace=False).tolist()), rng.integers(1, 3, 3).astype(float).tolist()) for i in range(n)]

    qs, its = vectors(33), vectors(150)
    seen = [(q, (q * 5 + j) % 150) for q in range(33) for j in range(4)]
    schema = "array<int>, w array<double>"
    got = recommend.ranked(
        scoring.top_scores(
            spark.createDataFrame(qs, f"q long, idx {schema}"), spark.createDataFrame(its, f"i long, idx {schema}"),
            spark.createDataFrame(seen, "q long, i long"), "q", "i", terms, 5,
        ), "q", "i", 5,
    )

    def dot(a, b):
        return sum(x * y for i, x in zip(a[1], a[2]) for j, y in zip(b[1], b[2]) if i == j)

    expected = []
    for q in qs:
        order = sorted((-dot(q, it), it[0]) for it in its if (q[0], it[0]) not in set(seen))
        expected += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(order[:5])]
    assert rows(got, "q", "rank") == expected


def test_metrics(spark):
    recs = spark.createDataFrame([("u", 1, "a"), ("u", 2, "b"), ("u", 3, "c")], "user_id string, rank int, product_id string")
    test = spark.createDataFrame([("u", "b"), ("nobody", "a")], "user_id string, product_id string")
    n, p, r, ndcg = rows(evaluate.evaluate_at_k(test, recs, 5))[0]
    assert (n, r) == (1, 1.0) and abs(p - 1 / 3) < 1e-12 and abs(ndcg - 1 / log2(3)) < 1e-12
    assert rows(evaluate.evaluate_at_k(test.where("false"), recs, 5)) == [(0, 0.0, 0.0, 0.0)]


def test_ideal_gain_counts_min_of_true_and_k(spark):
    recs = spark.createDataFrame([("u", 1, "a"), ("u", 2, "b")], "user_id string, rank int, product_id string")
    test = spark.createDataFrame([("u", x) for x in "abcd"], "user_id string, product_id string")
    n, p, r, ndcg = rows(evaluate.evaluate_at_k(test, recs, 2))[0]
    assert (n, p, r, round(ndcg, 12)) == (1, 1.0, 0.5, 1.0)


def test_lookup(spark):
    recs = spark.createDataFrame([("u", 1, "a"), ("u", 2, "b"), ("v", 1, "c")], "user_id string, rank int, product_id string")
    asked = spark.createDataFrame([("u",), ("x",), ("u",)], "user_id string")
    assert rows(recommend.lookup(asked, recs, 1)) == [("u", 1, "a")]


def test_unit_vector_example(spark):
    items = spark.createDataFrame([(1, "aa bb"), (2, "aa")], "i int, t string")
    model = tfidf.fit(items, "i", F.col("t"))
    weights = {(i, t): w for i, t, w in rows(model.vector_rows())}
    b = log(3 / 2) + 1
    assert abs(weights[(1, "bb")] - b / sqrt(1 + b * b)) < 1e-12 and weights[(2, "aa")] == 1.0


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_profiles_are_summed_in_a_stream(spark, shop, monkeypatch, broadcast_bytes):
    """Users whose rows go on over many slices, repeated and unknown products, a product listed twice; no entry is shuffled."""
    monkeypatch.setattr(recommend, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(scoring, "SUMMED", 2)
    products, users, history = shop
    products = products.unionByName(products.where("product_id = 'p3'"))
    model = recommend.fit_content(products)
    folded = recommend.history_counts(users, history)
    made = recommend.user_profiles(folded, model)
    vectors = model.vectors().collect()
    sums = {}
    for user, product in {(r.user_id, r.product_id) for r in folded.collect()}:
        n = history.where((F.col("user_id") == user) & (F.col("product_id") == product)).count()
        own = sums.setdefault(user, {})
        for v in vectors:
            if v.product_id == product:
                for i, w in zip(v.idx, v.w):
                    own[i] = own.get(i, 0.0) + n * w
    got = {r.user_id: dict(zip(r.idx, r.w)) for r in made.collect()}
    assert got.keys() == sums.keys() and got["lost"] == {}
    assert all(got[u] == pytest.approx(s) and list(got[u]) == sorted(s) for u, s in sums.items())
    assert "Aggregate" not in made._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[1].split("Exchange")[0]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_a_user_has_one_profile(spark, shop, monkeypatch, broadcast_bytes):
    """The rows of a user lie apart in the history."""
    monkeypatch.setattr(recommend, "BROADCAST_BYTES", broadcast_bytes)
    model = recommend.fit_content(shop[0])
    history = spark.range(2000).select(
        (F.col("id") % 100).cast("string").alias("user_id"), F.concat(F.lit("p"), F.col("id") % 3 + 1).alias("product_id"), F.lit(1).alias("n")
    )
    made = recommend.user_profiles(history, model)
    total = model.vectors().where("product_id IN ('p1', 'p2', 'p3')").select(F.explode("w").alias("w")).agg(F.sum("w")).first()[0]
    got = made.select("user_id", F.aggregate("w", F.lit(0.0), lambda a, x: a + x).alias("w")).collect()
    assert len(got) == len({r.user_id for r in got}) == 100
    assert all(abs(r.w - 20 / 3 * total) < 20 for r in got)


def test_listed_pairs_are_dealt_before_they_are_folded(spark):
    """One task may make the lists of all users: none of them may be folded where they are made."""
    lists = spark.range(50).select(F.col("id").alias("user_id"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("rank"))
    lists = lists.withColumn("product_id", F.col("rank").cast("long"))
    test = spark.range(50).select(F.col("id").alias("user_id"), (F.col("id") % 5 + 1).alias("product_id"))
    made = evaluate.user_metrics(test.unionByName(test), lists.unionByName(lists.where("user_id < 3")), 4)
    above = made._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert re.findall("HashAggregate|Exchange", above)[-1] == "Exchange"
    got = {r.user_id: (r.precision, r.recall) for r in made.collect()}
    assert got == {u: ((0.25, 1.0) if u % 5 < 4 else (0.0, 0.0)) for u in range(50)}
