"""Edge rows of the Kneser-Ney operator."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from basketry.llm import kneser_ney

DOCS = "doc_id long, lang string, text string"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    words = [f"wo{k}rd" for k in range(60)]
    good = [(i, "en", " ".join(rng.choice(words) for _ in range(40))) for i in range(80)]
    junk = [(100 + i, "en", "".join(chr(rng.randrange(33, 126)) for _ in range(200))) for i in range(5)]
    rest = [(200, "en", None), (201, "en", ""), (202, None, good[0][2]), (None, "en", good[1][2]), (3, "en", good[3][2]), (203, "en", good[4][2] * 60)]
    docs = spark.createDataFrame(good + junk + rest, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 2)] + [(4, 1, 0), (101, 1, 1), (102, 0, 0), (None, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_trusted_documents_by_ids(spark, tables, monkeypatch):
    docs, labels = tables
    for bits in (27, 15):
        monkeypatch.setattr(kneser_ney, "FILTER_BITS", bits)
        got = sorted(r.doc_id for r in kneser_ney.trusted_documents(docs, labels).collect())
        assert got == list(range(0, 80, 2))


def test_columns_with_the_operators_names_survive(spark, tables):
    docs, labels = tables
    named = docs.withColumns({c: F.lit(7) for c in ("n_bytes", "__lang", "__limit", "__bits0", "c", "key")})
    rows = kneser_ney.classify(named, labels).collect()
    assert len(rows) == docs.count() and all(r.n_bytes == r["__lang"] == r["__limit"] == r["__bits0"] == 7 for r in rows)
    plain = {(r.doc_id, r.text): (r.perplexity, r.kept) for r in kneser_ney.classify(docs, labels).collect()}
    assert {(r.doc_id, r.text): (r.perplexity, r.kept) for r in rows} == plain


def test_null_empty_long_and_repeated(spark, tables):
    docs, labels = tables
    got = {}
    for r in kneser_ney.digest(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i in (200, 201):
        assert got[i][0].perplexity is None and got[i][0].kept is False
    assert len(got[3]) == 2 and got[3][0] == got[3][1] and got[3][0].kept
    assert got[203][0].kept and got[202][0].kept and len(got[None]) == 1
    assert not any(got[100 + i][0].kept for i in range(5))
    assert kneser_ney.digest(docs.limit(0), labels).collect() == []
    assert all(not r.kept or r.perplexity is not None for rows in got.values() for r in rows)


def brute_force(train, texts, order, left_out=False):
    """Perplexities by dictionaries: interpolated modified Kneser-Ney over bytes."""
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode()) for t in train]
    counts = collections.Counter()
    for t in low:
        padded = b"\n" * (order - 1) + t
        counts.update(padded[i : i + order] for i in range(len(t)))
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    cut, totals, freed = {}, {}, {}
    for k, table in tables.items():
        n = [max(1, sum(c == j for c in table.values())) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.1 * j), 0.9 * j) for j in (1, 2, 3)]
        cut[k] = lambda c, d=d: d[min(c, 3) - 1]
        totals[k], freed[k] = collections.Counter(), collections.Counter()
        for g, c in table.items():
            totals[k][g[:-1]] += c
            freed[k][g[:-1]] += cut[k](c)

    def probability(g, k, without):
        if k == 0:
            return 1 / 256
        own, c, total = g[len(g) - k :], tables[k][g[len(g) - k :]], totals[k][g[len(g) - k : -1]]
        below = probability(g, k - 1, without and c <= 1)
        if total == 0 or without and total == 1:
            return below
        weight = freed[k][own[:-1]] / total
        if c == 0 or without and c == 1:
            return weight * below
        return (c - cut[k](c)) / total + weight * probability(g, k - 1, False)

    found = []
    for t in texts:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())
        padded = b"\n" * (order - 1) + raw
        bits = sum(math.log2(probability(padded[i : i + order], order, left_out)) for i in range(len(raw)))
        found.append(2 ** (-bits / len(raw)))
    return found


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = ["Über", "the", "cat", "sat", "on", "hat", "mat", "\n", "mats", "Ω"]
    train = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(30)] + ["the cat"] * 2
    other = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(9)] + ["zz", "\n", "x" * 40]
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(train + other + [other[0]] * 5)], DOCS).repartition(3)
    none = spark.createDataFrame([(900, "en", None), (901, None, "")], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(train))], "doc_id long, quality int, toxic int")
    table, trusted = kneser_ney.train(docs, labels)
    plain = brute_force(train, train + other + [other[0]] * 5, kneser_ney.ORDER)
    without = brute_force(train, train, kneser_ney.ORDER, left_out=True)
    monkeypatch.setattr(kneser_ney, "COPIES", 3)  # one text is sent, the others are joined
    for shard_bytes in (1 << 30, 16 * table.count() // 3 + 1):
        add = kneser_ney.scorer(docs.unionByName(none), table, shard_bytes=shard_bytes)
        got = {r.doc_id: r.perplexity for r in add(docs.unionByName(none)).collect()}
        assert len(got) == len(plain) + 2 and got[900] is None and got[901] is None
        assert all(abs(got[i] - p) < 1e-9 * p for i, p in enumerate(plain))
        assert add(docs).columns == [*docs.columns, "perplexity"]
        out = {r.doc_id: r.perplexity for r in add(trusted, left_out=True).collect()}
        assert len(out) == len(train) and all(abs(out[i] - p) < 1e-9 * p for i, p in enumerate(without))


def test_what_the_model_gathers_grows_with_the_text(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8))) for _ in range(3000)]
    texts = [(" ".join(rng.choice(words) for _ in range(100)),) for _ in range(400)]
    sizes = [kneser_ney.gram_counts(spark.createDataFrame(texts[:n], "text string")).count() for n in (100, 400)]
    assert sizes[1] > 2.5 * sizes[0]


def test_counts_are_the_same_however_they_are_folded(spark, monkeypatch):
    texts = spark.createDataFrame([("the cat sat on the mat " * (i % 7),) for i in range(200)] + [(None,), ("",)], "text string").repartition(2)
    whole = {r.key: r.c for r in kneser_ney.gram_counts(texts).collect()}
    monkeypatch.setattr(kneser_ney, "FOLD_ROWS", 20)
    assert {r.key: r.c for r in kneser_ney.gram_counts(texts).collect()} == whole
    assert sum(whole.values()) == sum(len("the cat sat on the mat ") * (i % 7) for i in range(200))
