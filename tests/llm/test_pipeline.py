"""The pipeline against a brute-force version of all five stages."""

import collections
import contextlib
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from basketry.llm import jaccard, pii, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, n_words string, hit_words int"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bucket(v):
    shift = max(v.bit_length() - 6, 0)
    return v >> shift << shift


def measures(text):
    """None where a base rule rejects, else the three values with a threshold."""
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    places = collections.defaultdict(list)
    for k in range(len(w) - 4):
        places[tuple(w[k : k + 5])].append(k)
    again = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(5)}
    if len(w) < 10 or 100 * len(again) > 20 * len(w):
        return None
    symbols = sum(c in "#*$%&|<>" for c in text)
    return 1000 * symbols // len(w), 1000 * (len(lines) - len(set(lines))) // len(lines), 100 * sum(map(len, w)) // len(w)


def after_rules(docs):
    """All documents here are of groups of 50 or more, or judged by the whole."""
    found = {i: measures(d[1]) for i, d in enumerate(docs)}
    groups = collections.defaultdict(list)
    for i, m in found.items():
        if m:
            for key in ((docs[i][2], docs[i][3]), docs[i][2], "all"):
                groups[key].append(m)

    def bound(key, k):
        ordered = sorted(bucket(m[k]) for m in groups[key])
        low, high = (next(v for n, v in enumerate(ordered, 1) if 100 * n >= q * len(ordered)) for q in (25, 75))
        fence = high + 3 * (high - low)
        width = 1 << max(fence.bit_length() - 6, 0)
        return max((fence // width + 1) * width - 1, (250, 350, 1800)[k])

    out = []
    for i, m in found.items():
        if m:
            key = next((x for x in ((docs[i][2], docs[i][3]), docs[i][2]) if len(groups[x]) >= 50), "all")
            if all(m[k] <= bound(key, k) for k in range(3)):
                out.append(docs[i])
    return out


def after_join(docs):
    sets = {}
    for d in docs:
        w = words(lowered(d[1]))
        sets[d[0]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    return [d for d in docs if group[d[0]] == d[0]]


def after_benchmark(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = set()
    for _, t in items:
        w = split(t)
        n = min(13, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1 if n else 0)}
    out = []
    for d in docs:
        w = split(d[1])
        hit = {k + j for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for j in range(n)}
        if not hit or 20 * len(hit) < len(w):
            out.append(d)
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(500)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    item, base = make(40), make(150)
    texts = [" ".join(make(rng.randrange(20, 200))) for _ in range(140)]
    for k in range(10):  # near copies, the first of them the source
        near = list(base)
        if k:
            near[rng.randrange(150)] = f"y{k}"
        texts.append(" ".join(near).upper() if k == 3 else "\n".join(near))
    texts += [texts[5]] * 7  # exact copies
    texts += [" ".join(make(100) + item[3:18] + make(60)), " ".join(make(500) + item[3:17] + make(60)), " ".join(item)]
    texts += [" ".join(make(30)) + f" mail jo{k % 2}@example.com, card 4539 1488 0343 6467 on 2024-02-29" for k in range(4)]
    texts += ["## $$ %% && ** " * 2 + " ".join(make(12)), "same line\n" * 9, None, "", " \n\t", "too few words", " ".join(make(9000))]
    texts.append("\n".join([x for k in range(12) for x in (" ".join(make(15)), "one line")] + [" ".join(make(30))]))
    docs = [(k, t, ("en", "de", None)[(k % 9) // 4], ("hot", "rare")[k % 13 == 0], k, k, "n", 0) for k, t in enumerate(texts)]
    return docs, [(1, " ".join(item)), (2, None), (3, "")]


def test_every_stage_against_brute_force(spark, tables, tmp_path):
    from tokenizers import Tokenizer

    docs, items = tables
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sizes = [len(docs)]
    expected = docs
    for step in (after_rules, after_join, lambda d: after_benchmark(d, items)):
        expected = step(expected)
        sizes.append(len(expected))
    assert all(a > b for a, b in zip(sizes, sizes[1:], strict=False)) and sizes[-1] > 100
    expected = [(d[0], pii.pseudonymize(d[1], pii.DEMO_KEY)[0], *d[2:]) for d in expected]

    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, got, str(tmp_path))
        assert made.columns == got.columns, name
        made.write.parquet(f"{tmp_path}/{name}")
        got = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(map(tuple, got.collect())) == sorted(expected)

    coder = Tokenizer.from_file(queries.tokenizer_path())
    pieces = set()
    for d in expected:
        ids = np.array([*coder.encode(d[1], add_special_tokens=False).ids, 0], "<u4")
        start, end, piece = 0, len(ids) % 2048 or 2048, 0
        while start < len(ids):
            pieces.add((d[0], piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            start, end, piece = end, end + 2048, piece + 1
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(rows) == len(pieces) and {tuple(r)[:5] for r in rows} == pieces
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        ends = np.cumsum([n for _, n in sorted(spans)]).tolist()
        assert [at for at, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_empty_tables(spark, tables, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_texts_go_to_tasks_once_and_in_small_batches(spark, tables):
    from basketry.llm import decontaminate

    docs = spark.createDataFrame([(1, "one two three", 7), (2, None, 8)], "doc_id long, text string, hit_words int")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    left = decontaminate.remove_documents(docs, items)
    row = re.search(r"struct\(([^()]*)\) AS row", left._jdf.queryExecution().analyzed().toString()).group(1)
    assert "doc_id" in row and "text" not in row
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, None, 8)]
    assert decontaminate.remove_documents(docs.select("text"), items).collect() == [(None,)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for stage in (corpus_pipeline.benchmark_decontamination, corpus_pipeline.pii_pseudonyms):
            spark.conf.set(name, "10000")
            with pytest.raises(Exception, match="benchmark|PATH_NOT_FOUND") if stage is corpus_pipeline.benchmark_decontamination else contextlib.nullcontext():
                stage(spark, docs, "/nowhere")
            assert int(spark.conf.get(name)) == corpus_pipeline.BATCH_ROWS
    finally:
        spark.conf.set(name, before)


def test_near_duplicates_take_one_worker_for_a_task(spark, tables, monkeypatch):
    """A worker for each Python function of a stage and core is kept until all are idle."""

    def most(node, above=0):
        if node.nodeName() == "AdaptiveSparkPlan":
            return most(node.executedPlan(), above)
        here = 0 if "Exchange" in node.nodeName() else above + (node.nodeName() == "MapInArrow")
        children = node.children()
        return max([here, *(most(children.apply(k), here) for k in range(children.size()))])

    found = {}

    def recorded(df, name, run=jaccard.materialize):
        found[name] = max(found.get(name, 0), most(df._jdf.queryExecution().executedPlan()))
        return run(df, name)

    monkeypatch.setattr(jaccard, "materialize", recorded)
    docs = spark.createDataFrame(tables[0], COLUMNS)
    left = jaccard.drop_near_duplicates(docs)
    assert found["cells"] == found["sets"] == 1 and max(found.values()) == 1
    assert most(left._jdf.queryExecution().executedPlan()) == 0
    kept = [d[0] for d in after_join([d for d in tables[0] if words(d[1])])]
    assert sorted(r.doc_id for r in left.collect()) == sorted(kept + [d[0] for d in tables[0] if not words(d[1])])


def test_sets_of_candidates_only(spark):
    """The filter lets all ids of pairs through, and hardly any other."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('a b c d e f g ', id div 2) as text")
    ids = docs.where("doc_id < 20").select("doc_id")
    from basketry.llm.common import key_filter, map_words

    held = key_filter(ids.selectExpr("xxhash64(doc_id) as h"), "h", 20)
    made = map_words(docs, "doc_id", "text", "doc_id long, n int", lambda i, w: [i, w.counts.astype("i4")], among=held).collect()
    assert {tuple(r) for r in made} >= {(k, 8) for k in range(20)} and len(made) < 40
