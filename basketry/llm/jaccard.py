"""N-gram Jaccard join with a count-vector R-tree.

A document's set are its distinct 5-word shingles (words in lower case A-Z; fewer
words are one shingle). Documents link when their Jaccard similarity is at least 0.8.

1. A sketch of fixed size counts the shingles of all documents and gives an order
   in which frequent ones come last. It only steers the work.
2. Every document gets its set's fingerprint, a point (counts of its shingles in
   ``GROUPS`` hash groups) and its prefix: the first fifth of its shingles in that order, plus
   one. Similar documents share a prefix shingle. Documents with equal sets are one
   class, of which the smallest goes on.
3. A cell is a prefix shingle with the documents that have it. Each member is
   compared with the cell's smallest document; then, with components known, only
   members of different components are: in each cell an R-tree over the points gives the
   pairs whose overlap bound, the sum of coordinate minima, and sizes still allow a link.
   Cells of over ``BLOCK`` members are joined block by block.
4. Pairs that pass the bound are verified on their whole sets.

A group of copies thus costs a link per member, not a pair of members. No cell, bucket
or pair is dropped. Shingles are compared by 64-bit keys.

Without words n_shingles is 0 and the component is the document itself, also for
null text. Rows with the same doc_id count as one document with the links of each.
A null doc_id has no component. An empty table gives no rows. Extra columns pass
through ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import binary_column, fresh, key_filter, map_words, releasing, small_batches, split_by_keys
from basketry.llm.graph import components
from basketry.llm.words import LOWER, Words, mix
from basketry.session import materialize

SHINGLE = 5
GROUPS = 64
SKETCH_BITS = 20
SKETCH_SHARDS = 64
BLOCK = 4096
FILTER_BITS = 20, 27  # 16 for an id, up to 16 MB
_LEAF, _FAN = 32, 16


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the distinct shingles, by document and key."""
    at, keys = words.windows(SHINGLE)
    docs = words.documents_of(at)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        docs, keys = np.concatenate([docs, short]), np.concatenate([keys, words.sequences()[short]])
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
    return docs[new], keys[new]


def _slot(keys: np.ndarray) -> np.ndarray:
    """The sketch counter of a shingle."""
    return mix(keys + np.uint64(1)) >> np.uint64(64 - SKETCH_BITS)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """A bit for each counter whose count stands out: the shingles of the most documents are in these."""
    per = (1 << SKETCH_BITS) // SKETCH_SHARDS

    @releasing
    def count(batches):
        from basketry.llm.words import SPACE, find_words, text_chunks

        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                total += np.bincount(_slot(shingles(find_words(LOWER[data], offsets, SPACE))[1]).astype(np.int64), minlength=len(total)).astype(np.uint32)
        if total.any():
            parts = total.reshape(SKETCH_SHARDS, per)
            for k in range(SKETCH_SHARDS):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), binary_column([parts[k].tobytes()])], names=["shard", "counts"])

    @releasing
    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums.setdefault(k, np.zeros(per, np.int64))
                sums[k] += np.frombuffer(blob.as_py(), np.uint32)
        for k, c in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), binary_column([c.tobytes()])], names=["shard", "counts"])

    partial = docs.select("text").mapInArrow(count, "shard int, counts binary")
    merged = partial.repartition(SKETCH_SHARDS, "shard").mapInArrow(merge, "shard int, counts binary")
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in merged.toLocalIterator():  # SKETCH_BITS fix the size
        total[r["shard"] * per : (r["shard"] + 1) * per] = np.frombuffer(r["counts"], np.int64)
    mean = total.mean()
    return total > mean + 8 * mean**0.5 + 32


def feature_table(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, n, f1, f2 (fingerprint), point, prefix of every document with words."""
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent, bitorder="little"))

    def emit(ids: np.ndarray, words: Words) -> list:
        bits = sent.value
        docs_, keys = shingles(words)
        n = np.bincount(docs_, minlength=len(ids))
        slot = _slot(keys)
        late = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
        first = np.concatenate([[0], np.cumsum(n)])
        prints = [np.add.reduceat(np.append(x, np.uint64(0)), first[:-1]) for x in (mix(keys), mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
        points = np.bincount(docs_ * GROUPS + (keys >> np.uint64(58)).astype(np.int64), minlength=len(ids) * GROUPS).reshape(-1, GROUPS).astype("<i4")
        ordered = keys[np.lexsort((keys, late, docs_))]
        some = np.flatnonzero(n)
        return [
            ids[some], n[some], prints[0][some].view(np.int64), prints[1][some].view(np.int64),
            binary_column(points[k].tobytes() for k in some),
            binary_column(ordered[first[k] : first[k] + n[k] // 5 + 1].tobytes() for k in some),
        ]

    schema = "doc_id long, n long, f1 long, f2 long, point binary, prefix binary"
    return map_words(docs, "doc_id", "text", schema, emit, lower=LOWER)


_PREFIX_ROW = "token long, doc long"


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("prefix")]
        if keys:
            ids = np.repeat(batch.column("doc_id").to_numpy(), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(ids)], names=["token", "doc"])


def may_link(overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of a and b members with that overlap reach 0.8: 100 * overlap >= 80 * (a + b - overlap)."""
    return 9 * overlap >= 4 * (a + b)


def _points(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), "<i4").reshape(-1, GROUPS)


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, b) whose summed coordinate minima allow a link."""
    for x in ("a", "b"):
        pairs = pairs.join(points.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("point").alias(f"p{x}")), x)

    @releasing
    def run(batches):
        for batch in batches:
            if len(batch):
                bound = np.minimum(_points(batch.column("pa")), _points(batch.column("pb"))).sum(1)
                ok = may_link(bound, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long")


def _fine(keys: np.ndarray) -> bytes:
    """The point of one set in about a quarter as many groups as it has members."""
    bits = max(6, (len(keys) // 4).bit_length())
    return np.bincount((keys >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u2" if len(keys) < 65536 else "<u4").tobytes()


def _fine_bound(a: bytes, na: int, b: bytes, nb: int) -> int:
    """Summed coordinate minima; the point with more groups is folded."""
    x, y = (np.frombuffer(p, "<u2" if n < 65536 else "<u4").astype(np.int64) for p, n in ((a, na), (b, nb)))
    size = min(len(x), len(y))
    return int(np.minimum(x.reshape(size, -1).sum(1), y.reshape(size, -1).sum(1)).sum())


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose sets link, each once. Finer points are compared before whole sets are."""
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair_ids")

    def emit(ids_: np.ndarray, words: Words) -> list:
        docs_, keys = shingles(words)
        first = np.searchsorted(docs_, np.arange(len(ids_) + 1))
        own = [keys[a:b] for a, b in zip(first, first[1:], strict=False)]
        return [ids_, pa.array([len(k) for k in own], pa.int64()), binary_column(map(_fine, own)), binary_column(k.tobytes() for k in own)]

    # A few sets that no pair asks for do no harm: texts are neither joined nor shuffled, and go through one worker.
    least, most = FILTER_BITS
    held = key_filter(ids.select(F.xxhash64("doc_id").alias("h")), "h", min(most, max(least, (16 * ids.count()).bit_length())))
    sets = map_words(docs, "doc_id", "text", "doc_id long, n long, fine binary, keys binary", emit, lower=LOWER, among=held)
    sets = materialize(sets, "sets")
    for x in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("fine").alias(f"f{x}")), x)

    @releasing
    def bound(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("fa", "na", "fb", "nb")]
            ok = [
                n.as_py() > 0 and bool(may_link(_fine_bound(x.as_py(), n.as_py(), y.as_py(), m.as_py()), n.as_py(), m.as_py()))
                for x, n, y, m in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = pairs.select("a", "b", "na", "nb", "fa", "fb").mapInArrow(bound, "a long, b long")
    with small_batches(docs.sparkSession, 2000):
        left = materialize(left.distinct(), "bounded_pairs")
    for x in ("a", "b"):
        left = left.join(sets.select(F.col("doc_id").alias(x), F.col("keys").alias(f"k{x}")), x)

    @releasing
    def verify(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("ka"), batch.column("kb"), strict=True):
                s, t = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                ok.append(bool(may_link(np.intersect1d(s, t, assume_unique=True).size, len(s), len(t))))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    verified = left.select("a", "b", "ka", "kb").mapInArrow(verify, "a long, b long").distinct()
    with small_batches(docs.sparkSession, 200):  # a row holds two sets
        return materialize(verified, "verified_pairs")


class RTree:
    """Points of documents in leaves and nodes; a node knows the largest of each coordinate and its range of sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        # Tiles: runs by size, inside each by the coordinate that varies most.
        order = np.argsort(sizes, kind="stable")
        step = _LEAF * max(1, int((len(order) / _LEAF) ** 0.5))
        parts = []
        for a in range(0, len(order), step):
            part = order[a : a + step]
            parts.append(part[np.argsort(points[part][:, points[part].var(0).argmax()], kind="stable")])
        self.order = np.concatenate(parts) if parts else order
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes, self.sizes)]
        for fan in (_LEAF, _FAN):
            top, low, high = self.levels[-1]
            cuts = np.arange(0, len(low), fan)
            self.levels.append((np.maximum.reduceat(top, cuts, 0), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))

    def _near(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        top, low, high = self.levels[level]
        sized = (5 * high[a] >= 4 * low[b]) & (5 * high[b] >= 4 * low[a])
        out = np.zeros(len(a), bool)
        at = np.flatnonzero(sized)
        for k in range(0, len(at), 1 << 14):
            x, y = a[at[k : k + (1 << 14)]], b[at[k : k + (1 << 14)]]
            out[at[k : k + (1 << 14)]] = may_link(np.minimum(top[x], top[y]).sum(1), low[x], low[y])
        return out

    def pairs(self):
        """Arrays (i, j), i < j in tree order, of the pairs of points that may link, piece by piece."""
        roots = np.arange(len(self.levels[2][1]))
        for r in roots.tolist():
            a, b = np.full(len(roots) - r, r), roots[r:]
            near = self._near(2, a, b)
            a, b = a[near], b[near]
            for level, fan in ((1, _FAN), (0, _LEAF)):
                n = len(self.levels[level][1])
                found_a, found_b = [], []
                grid = np.arange(fan * fan)
                for k in range(0, len(a), 256):
                    x = (a[k : k + 256, None] * fan + grid // fan).ravel()
                    y = (b[k : k + 256, None] * fan + grid % fan).ravel()
                    ok = (x < n) & (y < n) & ((x < y) if level == 0 else (x <= y))
                    x, y = x[ok], y[ok]
                    near = self._near(level, x, y)
                    if level:
                        found_a.append(x[near])
                        found_b.append(y[near])
                    elif near.any():
                        yield self.order[x[near]], self.order[y[near]]
                if level:
                    a, b = (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (a[:0], b[:0])


def _cell_pairs(members: DataFrame) -> DataFrame:
    """Pairs of different labels that may link, of every (token, x, y); members come sorted by it."""
    names = ("token", "x", "y", "doc", "block", "n", "label", "point")

    def join(cell: dict[str, np.ndarray]):
        points = cell["point"]
        x, y = cell["x"][0], cell["y"][0]
        if cell["label"].min() == cell["label"].max():
            return
        for i, j in RTree(points, cell["n"]).pairs():
            ok = cell["label"][i] != cell["label"][j]
            if x != y:
                ok &= cell["block"][i] != cell["block"][j]
            a, b = cell["doc"][i[ok]], cell["doc"][j[ok]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    @releasing
    def run(batches):
        open_: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = {c: _points(batch.column(c)) if c == "point" else batch.column(c).to_numpy() for c in names}
            if open_ is not None:
                rows = {c: np.concatenate([open_[c], rows[c]]) for c in names}
            change = np.zeros(len(rows["token"]), bool)
            for c in ("token", "x", "y"):
                change[1:] |= rows[c][1:] != rows[c][:-1]
            cuts = [0, *np.flatnonzero(change).tolist()]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    yield from join({c: v[a:b] for c, v in rows.items()})
            open_ = {c: v[cuts[-1] :] for c, v in rows.items()}
        if open_ is not None and len(open_["doc"]) > 1:
            yield from join(open_)

    return members.select(*names).mapInArrow(run, "a long, b long")


def _set_sizes(docs: DataFrame) -> DataFrame:
    """doc_id and n_shingles of rows without a doc_id."""

    def emit(ids: np.ndarray, words: Words) -> list:
        return [pa.nulls(len(ids), pa.int64()), np.bincount(shingles(words)[0], minlength=len(ids))]

    return map_words(docs.withColumn("doc_id", F.lit(0)), "doc_id", "text", "doc_id long, n_shingles long", emit, lower=LOWER)


def linked_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    with small_batches(docs.sparkSession, 1000):
        return _linked_components(docs)


def _linked_components(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where(F.col("doc_id").isNotNull())
    features = materialize(feature_table(known, frequent_shingles(known)), "features")
    fingerprint = ["n", "f1", "f2"]
    classes = features.groupBy(*fingerprint).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last")
    # Most sets are of one document: only those that may be a copy's are looked up.
    copies = features.join(classes, fingerprint).where("doc_id <> rep").select("doc_id", *fingerprint, "rep")
    copies = materialize(copies, "copies")
    prefixes = (_prefix_rows, _PREFIX_ROW)
    unsure, single = split_by_keys(features.select("doc_id", *fingerprint, "prefix"), copies, "doc_id", rest=prefixes)
    unsure = unsure.join(copies, ["doc_id", *fingerprint], "left_anti").dropDuplicates(["doc_id", *fingerprint])
    chosen = single.unionByName(unsure.select("doc_id", "prefix").mapInArrow(releasing(_prefix_rows), _PREFIX_ROW))
    cell = Window.partitionBy("token")
    cells = chosen.select("token", "doc", F.min("doc").over(cell).alias("pivot"), F.count("doc").over(cell).alias("members"))
    cells = materialize(cells.where("members > 1"), "cells")

    # A doc_id has a point for each of its texts; a pair goes on if any two of them may link.
    points = features.select("doc_id", *fingerprint, "point").dropDuplicates(["doc_id", *fingerprint]).drop("f1", "f2")
    stars = cells.where("doc > pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    stars = materialize(_bounded(stars, points).distinct(), "star_pairs")
    links = _verified(stars, known)
    label = materialize(components(links), "labels")

    # What is left: members of one cell, but its smallest, that are not known to be connected.
    rest = cells.where("doc > pivot").join(label.withColumnRenamed("node", "doc"), "doc", "left")
    rest = rest.select("token", "doc", F.coalesce("component", "doc").alias("label"))
    mixed = rest.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("m")).where("least < most")
    rest = rest.join(mixed.select("token", "m"), "token").dropDuplicates(["token", "doc"])
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    rest = rest.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    members = rest.join(points.withColumnRenamed("doc_id", "doc"), "doc")
    members = members.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    pairs = _cell_pairs(members).distinct().join(stars, ["a", "b"], "left_anti")
    pairs = materialize(pairs, "cell_pairs")
    more = _verified(pairs, known)

    whole = components(links.unionByName(more).unionByName(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))))
    # One row for each row of docs: those with words from the features, the others with an empty set.
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    empty = docs.where(blank & F.col("doc_id").isNotNull()).select("doc_id", F.lit(0).cast("long").alias("n_shingles"))
    unnamed = _set_sizes(docs.where(F.col("doc_id").isNull()))
    sizes = features.select("doc_id", F.col("n").alias("n_shingles")).unionByName(empty).unionByName(unnamed)
    joined = sizes.join(whole.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents, the one with the smallest doc_id; columns as they were.

    Rows without words or doc_id link with nothing and stay.
    """
    found = linked_components(docs.select("doc_id", "text")).where("n_shingles > 0 and component_id <> doc_id").select("doc_id").distinct()
    # Ids are stored, so that their size is known: while they are few enough to be sent to every task, no text is shuffled.
    left = docs.join(materialize(found, "near_copies"), "doc_id", "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = materialize(repeated, "repeated_ids")
    several = left.join(repeated, "doc_id", "left_semi")
    # Of several rows with the same doc_id and words, one stays.
    names = [fresh(n, docs.columns) for n in ("__own", "__nth")]
    alone = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    own = F.when(alone, F.xxhash64(F.monotonically_increasing_id())).otherwise(F.lit(0))
    nth = F.row_number().over(Window.partitionBy("doc_id", names[0]).orderBy(F.xxhash64("text")))
    first = several.withColumn(names[0], own).withColumn(names[1], nth).where(F.col(names[1]) == 1).drop(*names)
    return left.join(repeated, "doc_id", "left_anti").unionByName(first)
