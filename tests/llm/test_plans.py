"""Packing plans against best fit decreasing; shards of groups of equal texts; shards written out."""

import collections
import random

import pytest

from basketry.llm import packing, sharding

DOCS = "doc_id long, text string, shard string"


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - x)
        else:
            rooms.append(capacity - x)
    return len(rooms)


@pytest.mark.parametrize("low, high, n", [(1, 2048, 300), (600, 800, 900), (130, 700, 500), (2048, 2048, 7), (1, 90, 400)])
def test_never_more_sequences_than_best_fit_decreasing(low, high, n):
    rng = random.Random(low + n)
    lengths = [rng.randint(low, high) for _ in range(n)]
    rows, sequences = packing.plan(collections.Counter(lengths))
    fill, ranks = collections.Counter(), collections.defaultdict(list)
    for length, rank, count, first, offset in rows:
        ranks[length] += range(rank, rank + count)
        for s in range(first, first + count):
            assert offset == fill[s]
            fill[s] += length
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(c)) for k, c in collections.Counter(lengths).items()}
    assert len(fill) == sequences and max(fill.values()) <= 2048
    assert sequences <= best_fit_decreasing(lengths, 2048)


def test_configurations_beat_best_fit_where_it_wastes_room():
    histogram = {650: 2000, 700: 2000, 690: 2000}  # 650 + 690 + 700 fit; best fit decreasing starts with pairs of 700
    assert packing.plan(histogram)[1] == 2000
    bins = []
    packing._best_fit(bins, histogram, {}, 2048)
    assert sum(b[0] for b in bins) > 2000


def test_equal_texts_stay_together_unless_their_size_forbids(spark):
    texts = [f"group {k} " + "y" * (40 + k % 50) for k in range(200)]
    rows = [(i, texts[i % 200], "x") for i in range(4000)] + [(9000 + i, "hot " * 200, "x") for i in range(700)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.shard for r in sharding.digest(spark, docs, shards=4).collect()}
    held = collections.defaultdict(set)
    for i, t, _ in rows:
        held[t].add(got[i])
    hot = held.pop("hot " * 200)
    assert all(len(s) == 1 for s in held.values()) and len(hot) > 1
    size = collections.Counter()
    for i, t, _ in rows:
        size[got[i]] += len(t) + 16
    mean = sum(size.values()) / 4
    assert len(size) == 4 and all(abs(n - mean) <= 2 * sharding.GROUP_SLACK * mean + 2000 for n in size.values())


def test_rounds_end_at_one_row(spark, monkeypatch):
    calls = []
    below = sharding._below
    monkeypatch.setattr(sharding, "_below", lambda *a: calls.append(1) or below(*a))
    docs = spark.createDataFrame([(1, "long " * 4000, "x"), (2, "b", "x"), (3, "c", "x"), (4, None, "x")], DOCS)
    got = sharding.digest(spark, docs, shards=3).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4] and len(calls) < 6


def test_written_shards_hold_every_row_once(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "b", "y"), (None, "c", "z"), (None, None, None), (7, "a", "x")] + [(20 + i, f"text {i}", "w") for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS).withColumnsRenamed({"shard": "h"}).withColumn("run", sharding.F.lit(3))
    sharding.write_shards(spark, docs, f"{tmp_path}/shards", shards=4)
    got = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, (tuple(r)[:4] for r in got.select("doc_id", "text", "h", "run").collect()))) == sorted(str((*r, 3)) for r in rows)
    by = {(r.doc_id, r.text_crc32): r.shard for r in sharding.digest(spark, docs, shards=4).collect()}
    counts = collections.Counter(by.values())
    assert {r["shard"]: r["count"] for r in got.groupBy("shard").count().collect()} == dict(counts)
    assert sharding.digest(spark, docs.limit(0)).collect() == []
