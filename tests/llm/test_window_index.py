"""The window index of the decontamination operator: memory, blocks, repeated and long items, empty tables."""

import pickle
import random
import re

from basketry.llm import decontaminate

ITEMS = "item_id string, text string"
DOCS = "doc_id long, text string"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def expected(docs, items):
    out = {}
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for name, item in items:
            v = words(item)
            n = min(13, len(v))
            known = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit.update(range(k, k + n))
                    ids.add(name)
        out[i] = (sorted(hit), sorted(x for x in ids if x is not None))
    return out


def test_index_size_per_byte_of_text():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(5000)]
    items = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(400))) for i in range(800)]
    size = sum(len(t) for _, t in items)
    assert len(pickle.dumps(decontaminate.WindowIndex(items, 13), 5)) < 6 * size + 2 * (1 << decontaminate._FILTER_BITS)


def test_long_items_are_cut_without_losing_windows():
    rng = random.Random(2)
    text = " -- ".join(rng.choice(["é", "bb", "ccc", "DDDD"]) + str(rng.randrange(999)) for _ in range(300))
    for size in (1, 90, 500, 2_000, 100_000):
        parts = list(decontaminate._parts(text, 13, size))
        w = words(text)
        assert all(len(p.encode()) <= max(size, 200) for p in parts) or size == 100_000
        found = {tuple(v[k : k + 13]) for v in map(words, parts) for k in range(len(v) - 12)}
        assert found == {tuple(w[k : k + 13]) for k in range(len(w) - 12)} and all(len(words(p)) >= 13 for p in parts)


def test_repeated_long_and_short_items_in_any_blocks(spark):
    rng = random.Random(3)
    make = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    long, mid = make(400), make(40)
    items = [("a", long), ("b", mid), ("b", mid), ("c", mid.upper()), (None, make(20)), ("d", "v1"), ("e", "v2, v3"), ("f", None), ("g", ""), ("h", "!?")] + [("r", make(15))] * 50
    docs = [(1, f"{make(30)} {long} {make(5)}"), (2, mid), (3, make(200)), (4, None), (5, ""), (6, items[4][1]), (None, mid), (2, mid), (7, make(3000) + " " + long[200:900])]
    want = expected(docs, items)
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for size in (1 << 24, 700):
        got = decontaminate.scan(frame, bench, block_bytes=size).collect()
        assert len(got) == len(docs)
        for r in got:
            assert (r.hit_words, r.hit_items) == want[r.doc_id]
            assert r.n_words == len(words(dict(docs)[r.doc_id]))
    sizes = [sum(len(t.encode()) for _, t in b) for b in decontaminate.blocks(bench.selectExpr("item_id id", "text").where("text is not null"), 13, 700)]
    assert max(sizes) <= 700 and len(sizes) > 2


def test_empty_tables_of_both_sides(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], DOCS)
    bench = spark.createDataFrame([("a", "words")], ITEMS)
    assert decontaminate.digest(docs.limit(0), bench).collect() == []
    got = {r.doc_id: r for r in decontaminate.digest(docs, bench.limit(0)).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].contaminated, got[2].n_words) == (3, 0, False, 0)
    assert decontaminate.remove_documents(docs, bench.limit(0)).count() == 2
