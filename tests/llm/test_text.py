"""The text operators against brute force, round trips and edge rows."""

import collections
import datetime
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from basketry.llm import chat, decontaminate, jaccard, kneser_ney, langid, packing, phrases, pii, queries, rules, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra=""):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    return df


def words(text, low=False):
    text = text or ""
    if low:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, ties, empty, null, short and one long text."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, base = make(70), make(120)
    out = [(0, " ".join(base)), (1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one TWO"), (6, " ".join(make(30000)))]
    for k in range(12):
        near = list(base)
        near[rng.randrange(120)] = f"x{k}"
        out.append((10 + k, " ".join(near)))
    for k in range(15):
        out.append((30 + k, " ".join(make(40) + passage[k % 3 : 70 - k] + make(rng.randrange(5, 90)))))
    out += [(50 + k, " ".join(make(60))) for k in range(20)]
    out += [(80 + k, out[0][1]) for k in range(6)] + [(90, " ".join(passage[:49])), (91, "\n".join(passage[5:55]))]
    return out


EMPTY = [(1, None), (2, "")]


def test_jaccard_components(spark, corpus):
    sets = {}
    for i, t in corpus:
        w = words(t, True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_components(frame(spark, corpus)).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}
    kept = sorted(r.doc_id for r in jaccard.drop_near_duplicates(frame(spark, corpus)).collect())
    assert kept == sorted(i for i in sets if find(i) == i)


def test_jaccard_blocks_and_tree(spark, corpus, monkeypatch):
    expected = sorted(map(tuple, jaccard.linked_components(frame(spark, corpus)).collect()))
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    assert sorted(map(tuple, jaccard.linked_components(frame(spark, corpus)).collect())) == expected
    rng = np.random.default_rng(1)
    points = rng.poisson(3, (700, jaccard.GROUPS)).astype(np.int32)
    points[350:] = points[:350] + (rng.random((350, jaccard.GROUPS)) < 0.02)
    sizes = points.sum(1)
    found = {tuple(sorted(p)) for i, j in jaccard.RTree(points, sizes).pairs() for p in zip(i.tolist(), j.tolist(), strict=True)}
    every = {
        (i, j) for i in range(700) for j in range(i)
        if 9 * np.minimum(points[i], points[j]).sum() >= 4 * (sizes[i] + sizes[j]) and 5 * min(sizes[i], sizes[j]) >= 4 * max(sizes[i], sizes[j])
    }
    assert found == {(b, a) for a, b in every}


def test_jaccard_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c", "x"), (7, "a b c", "y"), (7, "a b c", "z"), (3, "A b c", "q")], "doc_id long, text string, n string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.linked_components(df).collect())
    assert got == [("3", 1, 3), ("7", 1, 3), ("7", 1, 3), ("None", 1, None)]
    assert sorted((str(r.doc_id), r.n) for r in jaccard.drop_near_duplicates(df).collect()) == [("3", "q"), ("None", "x")]


def test_jaccard_texts_of_equal_size_under_one_id(spark):
    rng = random.Random(2)
    texts = [[f"{name}{rng.randrange(10**6)}" for _ in range(120)] for name in "pqr"]
    near = [["other", *t[1:]] for t in texts]
    rows = [(1, t) for t in texts] + [(2 + k, t) for k, t in enumerate(near)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked_components(df).collect())
    assert got == [(i, 116, 1) for i in (1, 1, 1, 2, 3, 4)]


def cut_by_hand(texts, window=50):
    first, out = {}, {}
    for i, t in sorted(texts):
        w = words(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    for i, t in texts:
        w = words(t)
        gone = {x for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for x in range(k, k + window)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_phrases(spark, corpus):
    expected = cut_by_hand(corpus)
    assert sum(v[1] > 0 for v in expected.values()) > 15
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept).decode()) for r in phrases.cut_repeats(frame(spark, corpus), keep_text=True).collect()}
    assert got == expected
    digest = {r.doc_id: r.kept_sha256 for r in phrases.digest(frame(spark, corpus)).collect()}
    assert digest == {i: hashlib.sha256(v[2].encode()).hexdigest() for i, v in expected.items()}


def test_decontaminate(spark, corpus):
    base = words(corpus[0][1])
    items = [(2, " ".join(base[10:40]).upper()), (10, "w1, w2"), (None, " ".join(base[60:80])), (4, None), (2, "zz")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    alnum = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = alnum(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    expected = {}
    for i, t in corpus:
        w, hit, ids = alnum(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids.update(windows[tuple(w[k : k + n])])
        names = ",".join(sorted(str(x) for x in ids if x is not None))
        expected[i] = (len(w), len(hit), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    docs = frame(spark, corpus)
    for block in (decontaminate.BLOCK_BYTES, 64):
        got = decontaminate.scan(docs, bench, block_bytes=block).collect()
        assert {r.doc_id: len(r.hit_words) for r in got} == {i: v[1] for i, v in expected.items()}
    got = {r.doc_id: (r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in decontaminate.digest(docs, bench).collect()}
    assert got == expected
    assert {r.doc_id for r in decontaminate.remove_documents(docs, bench).collect()} == {i for i, v in expected.items() if not v[3]}
    spans = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert len(alnum(spans[0])) == expected[0][0] - expected[0][1] and spans[1] is None


def test_pii_is_a_permutation_within_formats(spark):
    key = b"k"
    assert sorted(pii.permute(v, 37, key, b"t") for v in range(37)) == list(range(37))
    assert all(pii.permute(pii.permute(v, 37, key, b"t"), 37, key, b"t", inverse=True) == v for v in range(37))
    text = "Mail Jo.42@mail7.example.com or JO.42@mail7.example.com, card 4539 1488 0343 6467, 4539148803436467 4539148803436466; 2024-02-29 2024-02-30 +1 (017) 555-7713 203.0.113.7 300.1.1.1 078-05-1120 token = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\""
    new, kinds = pii.pseudonymize(text, key)
    assert kinds == ["email", "email", "card", "card", "date", "phone", "ipv4", "ssn", "secret"]
    a, b = re.findall(r"\S+@\S+\.com", new)
    assert a.lower() == b.lower() and a != b and a[2] == "." and a.endswith(".com")
    c, d = re.findall(r"\d{4} \d{4} \d{4} \d{4}|(?<= )\d{16}", new)[:2]
    assert c.replace(" ", "") == d and pii.luhn_digit(d[:-1]) == d[-1] and d != "4539148803436467"
    for left in ("4539148803436466", "2024-02-30", "300.1.1.1", "+1 ("):
        assert left in new
    for gone in ("203.0.113.7", "2024-02-29", "555-7713", "078-05-1120", "9233A8EC"):
        assert gone not in new
    datetime.date.fromisoformat(re.search(r"\d{4}-\d{2}-\d{2}", new).group())
    assert pii.pseudonymize(text, b"other")[0] != new
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, text, 7), (3, text, 7)], "doc_id long, text string, found long")
    got = pii.mask(df, key).collect()
    assert [r.text for r in got] == [None, "", new, new] and [r.found for r in got] == [5, 6, 7, 7]


def test_pii_cards_in_any_grouping_and_phones_in_any_notation():
    new = lambda t: pii.pseudonymize(t, b"k")
    digits = lambda t: re.sub(r"\D", "", t)
    amex, found = new("card 3782 822463 10005.")
    assert found == ["card"] and re.fullmatch(r"card \d{4} \d{6} \d{5}\.", amex) and "822463" not in amex
    for other in ("3782-822463-10005", "378282246310005", "378 282 246 310 005", "3782-8224-6310-005"):
        assert new(other)[1] == ["card"] and digits(new(other)[0]) == digits(amex)
    whole = new("4539 1488 0343 6467")[0]
    for text in ("12 {}", "{} 12", "{} 123", "7 8 {} 9 10", "{} 4539 1488 0343 6466"):
        made, found = new(text.format("4539 1488 0343 6467"))
        assert made == text.format(whole) and found == ["card"]
    for left in ("3782 822463 10006", "100 200 300 400 501", "378 282 246 310 005 17 18", "1234 5678 90"):
        assert new(left) == (left, [])
    assert new("12 2024-02-29 555 17 20")[1] == ["date"]
    phones = [new(p) for p in ("+1 (310) 555-4510", "+13105554510", "+1 310.555.4510", "310-555-4510", "(310) 555-4510")]
    assert all(k == ["phone"] for _, k in phones) and len({digits(p)[-10:] for p, _ in phones}) == 1
    assert digits(phones[0][0])[1:] != "3105554510" and phones[1][0].startswith("+1") and phones[0][0][:4] == "+1 ("
    a, b = new("+44 20 7946 0958")[0], new("+442079460958")[0]
    assert digits(a) == digits(b) != "442079460958" and b.startswith("+44")
    assert digits(new("+352 26 123 456")[0]).startswith("352")


def test_rules_thresholds_and_edges(spark):
    clean = [f"a{k} bee cee dee eff gee aitch eye jay kay ell {k} em en oh" for k in range(120)]
    junk = ["## $$ %% " * 5 + "one two three", "Same line here now\n" * 6 + " ".join(f"u{k}" for k in range(60)), "", None, "few words", "a b c d e " * 9]
    rows = [(i, t, "en" if i % 3 else None, "s", 0) for i, t in enumerate(clean + junk)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in rules.digest(docs).collect()}
    assert all(got[i].kept for i in range(120)) and not any(got[i].kept for i in range(120, 126))
    assert got[125].n_repeat_words == 45 and got[121].n_dup_lines == 5 and got[123].n_words == 0
    assert {r.doc_id for r in rules.filter_documents(docs).collect()} == set(range(120))
    assert rules.filter_documents(docs.withColumn("m", docs.lang)).columns == [*docs.columns, "m"]


def test_rules_keep_a_group_inside_one_bucket(spark):
    words = lambda n, marked: " ".join("#" * (k < marked) + f"u{k}" for k in range(n))
    symbols, more = words(100, 30), words(125, 38)  # 300 and 304 of 1000 words: the buckets that begin at 296 and 304
    long_words = " ".join(f"{k:02}".ljust(20 + (k < 3), "x") for k in range(20))  # 2015, in the bucket that begins at 1984
    texts = [(symbols, "a")] * 60 + [(more, "a")] + [(long_words, "b")] * 60
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, (t, s) in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in rules.filter_documents(docs).collect()} == set(range(121)) - {60}


def test_packing_fills_sequences(spark, corpus):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    reference = Tokenizer.from_file(path)
    odd = [(200, "it's  they'll\n\n x 's <|endoftext|> é  日本 12345 \t"), (201, " " * 3000), (201, "a" * 5000)]
    texts = corpus + odd
    got = packing.pack(spark, frame(spark, texts), path).collect()
    ids = collections.defaultdict(list)
    for i, t in texts:
        ids[i].append(np.array(reference.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))
    expected = []
    for i, all_ids in ids.items():
        for x in all_ids:
            end, start, piece = len(x) % 2048 or 2048, 0, 0
            while start < len(x):
                expected.append((i, piece, start, end - start, zlib.crc32(x[start:end].tobytes())))
                start, end, piece = end, end + 2048, piece + 1
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    room = collections.defaultdict(list)
    for r in got:
        room[r.sequence_id].append((r.offset, r.length))
    for spans in room.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_plan_is_tight():
    rng = random.Random(3)
    histogram = collections.Counter(rng.choice([2048, rng.randrange(1, 2049), rng.randrange(1, 300)]) for _ in range(20000))
    rows, sequences = packing.plan(histogram)
    fill = collections.Counter()
    ranks = collections.defaultdict(list)
    for length, rank, count, first, offset in rows:
        ranks[length] += range(rank, rank + count)
        for s in range(first, first + count):
            fill[s] += length
            assert offset + length <= 2048
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert max(fill.values()) <= 2048 and sequences <= 1.01 * sum(k * n for k, n in histogram.items()) / 2048
    assert packing.plan({}) == ([], 0)


def test_chat_round_trip(spark):
    rows = [
        (1, 2, "assistant", "b <|im_end|> %25 <"), (1, 1, "user", "100% <b>\n"), (1, 1, "user", "100% <b>\n"), (2, None, None, None),
        (3, 0, "assistant %", "x"), (3, 1, "a\nb", "y"), (None, 0, "assistant", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rendered", chat.F.lit(1))
    got = {r.conv_id: r for r in chat.digest(chat.with_probe(spark, df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in (1, 2, 3, None, -1):
        own = [(r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv] if conv != -1 else [(k, role, "<|im_end|><|im_start|>assistant ok") for k, role in enumerate(("user", "assistant"))]
        own.sort(key=lambda r: (-1 if r[0] is None else r[0], *r[1:]))
        r = got[conv]
        assert r.round_trip and r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for _, a, b in own))
        loss = "".join(b for _, a, b in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_language_id_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(900, None, None, None, None), (901, "123 ...", None, None, None), (902, "日本語", None, None, None)], SCHEMA)
    got = langid.digest(docs.unionByName(more)).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    held = [r for r in got if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and held
    by = {r.doc_id: r for r in got}
    assert by[900].lang_pred == by[901].lang_pred == "und" and by[902].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in langid.digest(more.where("lang is not null").unionByName(more)).collect()] == ["und"] * 3


def test_kneser_ney_is_a_distribution(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    table = kneser_ney.probability_table(kneser_ney.gram_counts(kneser_ney.trusted_documents(docs, labels))).toPandas()
    shard = kneser_ney.Shard({})
    for k, own in table.groupby("order"):
        own = own.sort_values("key")
        shard.tables[k] = (own["key"].to_numpy(), own["value"].to_numpy())
    for context in (b"the", b"qzx", b"\n\n\n", b" th"):
        keys = np.array([int.from_bytes(context, "big") << 8 | b for b in range(256)])
        assert abs(np.exp2(shard.log2(keys)).sum() - 1) < 1e-6
    found = kneser_ney.classify(docs, labels)
    whole = found.join(labels, "doc_id").collect()
    good = [r for r in whole if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in whole if r.quality == 0) >= 0.5 * sum(r.quality == 0 for r in whole)
    one = {r.doc_id: r.perplexity for r in found.collect()}
    many = {r.doc_id: r.perplexity for r in kneser_ney.score(docs, kneser_ney.train(docs, labels)[0], shard_bytes=1 << 18).collect()}
    assert all(abs(one[i] - many[i]) < 1e-6 * one[i] for i in one)


def test_sharding_law(spark, corpus):
    texts = [(1000 + k, f"text {k} " + "x" * (k % 300)) for k in range(3000)] + [(5000 + k, "the same text " * 8) for k in range(900)] + [(None, "n"), (9, None)]
    got = sharding.digest(spark, frame(spark, texts), shards=8).collect()
    size = {(i, zlib.crc32((t or "").encode())): len((t or "").encode()) + 16 for i, t in texts}
    assert len(got) == len(texts) and {(r.doc_id, r.text_crc32): r.size for r in got} == size
    total, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(total.values()) / 8
    assert all(abs(total[s] - mean) <= 0.01 * mean + 400 for s in range(8))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    hot = {r.shard for r in got if r.doc_id and r.doc_id >= 5000}
    assert max(hot) - min(hot) == len(hot) - 1


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op5_benchmark_decontamination"}))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for t in ("documents", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    rows = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(rows) == (1 if name.startswith("op8") else 0)


def test_near_duplicates_shuffle_no_text_but_of_repeated_ids(spark, monkeypatch):
    texts = [(k, f"{chr(97 + k)} w x y z {k}", "n") for k in range(20)]
    texts += [(3, "a b c d e f", "again"), (None, "null id", "x"), (None, "null id", "y"), (5, " ", "blank"), (5, None, "null")]
    df = spark.createDataFrame(texts, "doc_id long, text string, n string")
    found = spark.createDataFrame([(k, 2, k // 10 * 10 if k in (0, 1, 10, 11) else k) for k in range(20)], "doc_id long, n_shingles long, component_id long")
    monkeypatch.setattr(jaccard, "linked_components", lambda docs: found)
    left = jaccard.drop_near_duplicates(df)
    rows = left.collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in rows) == sorted([-1, -1, 5, 5, *({*range(20)} - {1, 11})])
    assert left.columns == df.columns
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window [") :]
    assert "LeftSemi" in window  # only rows with a repeated id are sorted
    physical = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical and "BroadcastHashJoin" in physical
