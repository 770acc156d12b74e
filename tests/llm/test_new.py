"""Merkle manifest, BPE by tree concatenation and conversation repair against brute force."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest

from basketry.llm import bpe, merkle, packing, queries, repair
from basketry.llm.glr import ROLE_GRAMMAR, Automaton, Stacks
from basketry.llm.oracle import SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def multiset(rows):
    return collections.Counter(tuple(r) for r in rows)


def clash(df):
    """Extra columns with names that the operators use inside."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(1).alias(c) for c in ("k", "p", "n", "h", "id", "row", "ids", "seg", "later", "there", "copy", "same", "first", "kind")))


# --- Merkle ------------------------------------------------------------------------


def brute_manifest(rows):
    """By the contract's words, over (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
        return levels

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            run = level[i // 3 * 3 :][:3]
            out.append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
            i //= 3
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, at)
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf((*r[:4], text))
            for place, others in path:
                node = sha("".join(others[:place] + [node] + others[place:]))
            proof = sha("".join("".join(others) for _, others in path))
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def test_merkle_equals_brute_force(spark, monkeypatch):
    """One source of several superblocks, small ones, nulls, ties, equal rows, ids beside a null that a double can't hold."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["a\nb", "x", "", None, "long " * 500]), "en", "hot", i) for i in range(1700)]
    rows += [(i, f"t{i}\n", None, f"s{i % 40}", None) for i in range(2000, 2100)]
    rows += [(None, "x\ny", "fr", "hot", 1), (2**60 + 1, "q\n", "fr", "hot", 1), (2**60 + 1, "q\n", "fr", "hot", 1), (7, "other\n", "fr", "hot", 1)]
    rows += [(1, "null source", "en", None, 3), (2, "empty source", "en", "", 3), (3, "é", "en", "é", 1), (4, "z", "en", "z", 1)]
    df = spark.createDataFrame(rows, DOCS)
    wanted = brute_manifest([tuple(r) for r in df.select(*merkle.COLUMNS).collect()])
    got = merkle.digest(df.repartition(5)).drop("source")
    assert multiset(got.collect()) == multiset(wanted)
    assert any(r[-1] for r in wanted) and not all(r[-1] for r in wanted)


def test_merkle_paths_and_edge_tables(spark):
    df = spark.createDataFrame([(1, "a\n", "en", "s", 2)], DOCS)
    (only,) = merkle.digest(clash(df)).collect()  # a lone leaf is the root
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == sha("")
    assert merkle.digest(df.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None,) * 5] * 4, DOCS)
    assert multiset(merkle.digest(nulls).drop("source").collect()) == multiset(brute_manifest([(None,) * 5] * 4))
    rows = merkle.manifest(spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(10)], DOCS), paths=True).collect()
    for r in rows:
        assert merkle.fold(r.leaf, [(s.at, s.siblings) for s in r.path]) == r.root


def test_merkle_any_column_can_be_claimed(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(9)], DOCS)
    rows = merkle.manifest(df, {"lang": F.when(F.col("doc_id") == 4, "fr").otherwise(F.col("lang"))}).collect()
    assert [r.doc_id for r in rows if not r.verified] == [4]
    assert all((r.folded_root == r.root) == r.verified for r in rows)


# --- BPE ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


PARTS = (
    "' l s d ll re ve the ing aaaa == ! 1 ’ é 😀 中 _ <|endoftext|> <| |> endoftext".split()
    + [" ", "  ", "\n", "\t", "\r\n", "\x1c", "　", " a", "́"]
)


@pytest.mark.parametrize("leaf", [1, 2, 3, 7])
def test_seams_equal_the_library(library, leaf):
    """Halves of a few characters, so that nearly every pair of tokens is a seam."""
    rng = random.Random(leaf)
    coder = bpe.Coder(queries.tokenizer_path(), leaf)
    for _ in range(4000):
        chosen = rng.sample(PARTS, rng.choice((2, 3, len(PARTS))))
        text = "".join(rng.choice(chosen) for _ in range(rng.randrange(40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_a_seam_changes_tokens(library):
    """Without the windows the halves' ids differ from the text's, so the joins decide."""
    coder = bpe.Coder(queries.tokenizer_path(), 4)
    text = "internationalisation of tokenisers"
    apart = [i for at in range(0, len(text), 4) for i in coder.plain(text[at : at + 4])]
    assert apart != coder.encode(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 70_001, " " * 40_001 + "x", "0f3A" * 20_000, "中文字" * 9_000, "x" * 5000 + "'ll" * 5000])
def test_long_unsplit_text(library, text):
    assert bpe.Coder(queries.tokenizer_path()).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_decode_of_broken_ids(library):
    rng = random.Random(8)
    coder = bpe.Coder(queries.tokenizer_path())
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(6))]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_digest(spark, library):
    rng = random.Random(4)
    vocabulary = [f"word{k}" for k in range(300)]
    long = " ".join(rng.choice(vocabulary) for _ in range(20_000))
    texts = [None, "", " ", "one two", "one two", long, long + "<|endoftext|>" + "q" * 70_000, "<|endoftext|>" * 9000, "a <|endoftext|> b"]
    rows = [(i % 7 if i else None, t, "en", "s", 0) for i, t in enumerate(texts)]
    wanted = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    df = spark.createDataFrame(rows, DOCS)
    assert multiset(bpe.digest(clash(df), queries.tokenizer_path()).collect()) == multiset(wanted)
    # Small segments: every text goes through the exchange.
    small = bpe.encode(df, queries.tokenizer_path(), leaf=64, segment=256)
    got = multiset((r.doc_id, r.text) for r in bpe.decode(small, queries.tokenizer_path()).collect())
    assert got == multiset((i, t or "") for i, t, *_ in rows)
    assert bpe.digest(df.limit(0), queries.tokenizer_path()).collect() == []


def test_packing_uses_the_files_own_settings(spark, library):
    """A special token's string in a text is that token."""
    rows = [(1, "a <|endoftext|> b", "en", "s", 0), (2, None, "en", "s", 0), (3, "x" * 9000, "en", "s", 0)]
    got = packing.pack(spark, spark.createDataFrame(rows, DOCS), queries.tokenizer_path()).collect()
    for i, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert sum(r.length for r in got if r.doc_id == i) == len(ids)
        for r in got:
            if r.doc_id == i:
                piece = b"".join(k.to_bytes(4, "little") for k in ids[r.start : r.start + r.length])
                assert r.ids_crc32 == zlib.crc32(piece)


# --- conversations -----------------------------------------------------------------------


def cheapest(rows):
    """Least (cost, audit) over all edits, by their outputs in full; rows are (role, text, must_go, truncated)."""
    ok = re.compile("(s?(ua)*u?)$")
    best = {}
    heap = [(0, "", 0, ())]
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if (i, out) in best:
            continue
        best[i, out] = (cost, audit)
        shape = "".join(r[:1] or "?" for r, _ in out)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out))
        moves = [(2, "I", 0, (role, "")) for role in ("user", "assistant")]
        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            moves.append((3, "D", 1, None))
            if not must_go:
                moves.append((truncated, "K", 1, (role, text)))
                moves += [(2 + truncated, "R", 1, (other, text)) for other in ("user", "assistant")]
        for price, letter, step, row in moves:
            new = out if row is None else (*out, row)
            if ok.match("".join(r[:1] or "?" for r, _ in new)):
                heapq.heappush(heap, (cost + price, audit + letter, i + step, new))


def brute_repair(rows):
    """By the contract's words, over (conv_id, turn, role, text)."""
    out = []
    spaced = lambda v: " " if v is None else v
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, spaced(r[2]), hashlib.md5(spaced(r[3]).encode()).hexdigest()))
        after = []
        for _, turn, role, text in mine:
            role, text = spaced(role), spaced(text)
            kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            after += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        seen, judged, counts = set(), [], collections.Counter()
        for _, role, text in after:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, *cheapest(judged)))
    return out


def test_stacks_merge_by_top():
    stacks = Stacks(Automaton(ROLE_GRAMMAR))
    after = lambda text: [n for n in _run(stacks, text)]
    assert after("ua") == after("sua") == after("uaua") and len(after("ua")) == 1
    for text in ("", "ua", "sua", "suaua"):
        assert any(stacks.complete(n) for n in after(text)), text
    for text in ("s", "u", "suau"):
        assert not any(stacks.complete(n) for n in after(text)), text
    for text in ("a", "us", "ss", "uu", "uas", "uaa"):
        assert after(text) == [], text
    assert len(stacks.nodes) < 20


def _run(stacks, text):
    tops = {stacks.start}
    for symbol in text:
        tops = {n for t in tops for n in stacks.shift(t, symbol)}
    return tops


def test_repair_is_the_cheapest():
    rng = random.Random(6)
    for _ in range(1500):
        rows = [
            (rng.choice(["system", "user", "assistant", "tool", "unknown", " ", ""]), f"t{i}", rng.random() < 0.15, rng.random() < 0.3)
            for i in range(rng.randrange(8))
        ]
        made = repair.Repair()
        for row in rows:
            made.read(*row)
        assert made.end() == cheapest(rows), rows


def test_settling_changes_nothing(monkeypatch):
    """A long conversation read with a common part taken off after every row, late, and never."""
    rng = random.Random(2)
    rows = [(rng.choice(["user", "assistant", "user", "system"]), f"t{i}", rng.random() < 0.1, rng.random() < 0.2) for i in range(4000)]
    results = []
    for limit in (1, 64, 10**9):
        monkeypatch.setattr(repair, "SETTLE", limit)
        made = repair.Repair()
        held = 0
        for row in rows:
            made.read(*row)
            held = max(held, len(made.held))
        results.append(made.end())
        assert held == 4000 if limit == 10**9 else held < 1000
    assert results[0] == results[1] == results[2]


def test_repair_digest(spark):
    rng = random.Random(9)
    texts = ["Fine.", "No end", "What?", "", " \n", None, "Yes! ", "a "]
    rows = [
        (conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(["user", "assistant", "system", None, "User"]), rng.choice(texts))
        for conv in range(60) for turn in range(rng.randrange(1, 7))
    ]
    rows += [(conv, turn, ("user", "assistant")[turn % 2], f"Turn {turn}.") for conv in range(60, 120) for turn in range(6)]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), *[(500, 3, "user", "Same.")] * 3]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Dropped."))
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    got = repair.digest(clash(df)).collect()
    assert multiset(got) == multiset(brute_repair(rows))
    (empty,) = [r for r in got if r.conv_id == gone]
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert repair.digest(df.limit(0)).collect() == []


def test_repair_of_the_given_conversations(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert multiset(queries.op13_conversation_repair(spark, sf_dir).collect()) == multiset(brute_repair(rows))


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_conversation_repair"])
def test_query_equals_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    wanted = con.execute(SQL[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(got.columns)
    assert multiset(got.select(*names).collect()) == multiset(wanted.fetchall())
