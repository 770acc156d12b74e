"""Substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words of one document. Words covered by a window
whose word sequence also starts in a document with a smaller doc_id are removed.

0. Documents with equal word sequences are one class. All of its members but the smallest
   lose every word, if they have a window at all; they take no part in what follows.
1. Candidate phrases: of the ``phrase``-word phrases of each window the one with the smallest
   key (about 1 of 20 phrases). Two documents that share a window share its phrase.
   Phrases found in two documents are confirmed by one aggregate.
2. The confirmed phrases, as a filter of fixed size, go to all tasks. Each task
   compiles the phrases that occur in its shard of documents into an Aho-Corasick
   automaton (pyahocorasick) and streams all documents of the shard through it,
   which locates every occurrence. Windows that hold one, and whose own phrase is
   confirmed, are candidates: no other window can be found in two documents.
3. The smallest document of each candidate window is found by an aggregate (folded
   before the shuffle). Windows of two documents are joined back (hot ones are split by
   adaptive execution), and then the texts that have a word to remove. Filters of fixed
   size hold back most other rows before both joins.

The filter and the phrases only choose candidates; step 3 decides. Windows are
compared by 64-bit keys.

Null or empty text has no words. A document of fewer words than a window is
kept. Rows with the same doc_id don't remove words of each other; a null doc_id neither
removes nor is cut. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import KeyFilter, key_filter, small_batches, split_by_keys
from basketry.llm.words import SPACE, Words, find_words, text_chunks
from basketry.session import materialize

WINDOW = 50
PHRASE = 10
FILTER_BITS = 27
COPY_FILTER_BITS = 24
_NONE = np.iinfo(np.uint64).max


def _chosen(words: Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrase chosen in each window: its key, and the window's first word."""
    at, keys = words.windows(phrase)
    least = np.full(len(words.starts) + 1, _NONE)
    least[at] = keys
    width, span = window - phrase + 1, 1
    while 2 * span <= width:
        least[:-span] = np.minimum(least[:-span], least[span:])
        span *= 2
    starts = np.flatnonzero(np.arange(len(words.starts)) + window <= np.repeat(words.first[1:], words.counts))
    return np.minimum(least[starts], least[starts + width - span]), starts


class Copies:
    """The doc_ids of which every row is left out: in the filter of the copies, and not in that of the others found in it.

    Both filters have a fixed size and a doc_id gets the same answer everywhere. A row that is no copy is never
    left out; a copy that is not left out takes part like any document.
    """

    def __init__(self, copies: KeyFilter, others: KeyFilter) -> None:
        self.copies, self.others = copies, others

    def hold(self, hashes: pa.Array) -> np.ndarray:
        keys = hashes.fill_null(0).to_numpy().view(np.uint64)
        known = hashes.is_valid().to_numpy(zero_copy_only=False)
        return known & self.copies.may_hold(keys) & ~self.others.may_hold(keys)


def _live(batch: pa.RecordBatch, copies: Copies) -> pa.RecordBatch:
    return batch.filter(pa.array(~copies.hold(batch.column("h"))))


def _find_copies(whole: DataFrame, copies: DataFrame) -> Copies:
    """Of (doc_id, sha) of all documents and of the copies; only narrow rows that the first filter holds are joined."""
    held = key_filter(copies.select(F.xxhash64("doc_id").alias("h")), "h", COPY_FILTER_BITS)
    maybe = split_by_keys(whole.where("doc_id is not null").select("doc_id", "sha"), held, "doc_id")[0]
    others = maybe.join(copies.select("doc_id", "sha"), ["doc_id", "sha"], "left_anti")
    return Copies(held, key_filter(others.select(F.xxhash64("doc_id").alias("h")), "h", COPY_FILTER_BITS))


def _left_out(copies: DataFrame, found: Copies) -> DataFrame:
    sent = copies.sparkSession.sparkContext.broadcast(found)
    schema = copies.schema

    def run(batches):
        for batch in batches:
            yield batch.select(schema.names).filter(pa.array(sent.value.hold(batch.column("h"))))

    return copies.withColumn("h", F.xxhash64("doc_id")).mapInArrow(run, schema)


def phrase_table(docs: DataFrame, copies: Copies, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """key, doc_id of the candidate phrases of (doc_id, text, h); runs of windows with the same phrase give one row."""
    sent = docs.sparkSession.sparkContext.broadcast(copies)

    def run(batches):
        for batch in batches:
            live = _live(batch, sent.value)
            ids = live.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_chunks(live.column("text")):
                words = find_words(data, offsets, SPACE)
                keys, starts = _chosen(words, window, phrase)
                doc = words.documents_of(starts)
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                columns = [pa.array(keys[new].view(np.int64)), pa.array(ids[a:b][doc[new]], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id"])

    return docs.where("doc_id is not null").select("doc_id", "text", "h").mapInArrow(run, "key long, doc_id long")


def _normalized(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All documents with one space between words and " newline " between documents; where words and documents begin."""
    lengths = words.ends - words.starts
    gap = np.ones(len(lengths) + 1, np.int64)
    filled = np.flatnonzero(words.counts)
    gap[words.first[:-1][filled]] = 3
    begins = np.cumsum(gap[:-1]) + np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    out = np.full(int(begins[-1] + lengths[-1]) + 2 if len(lengths) else 1, 0x20, np.uint8)
    inside = ~SPACE[words.data]
    out[np.arange(int(inside.sum())) + np.repeat(np.cumsum(gap[:-1]), lengths)] = words.data[inside]
    out[begins[words.first[:-1][filled]] - 2] = 0x0A
    return out.tobytes(), begins, begins + lengths


def locate(words: Words, known: KeyFilter, window: int, phrase: int) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """First words of all windows that hold an occurrence of a confirmed phrase, their own chosen one being confirmed; the normalized text and its word bounds."""
    text, begins, ends = _normalized(words)
    at, keys = words.windows(phrase)
    of_window, starts = _chosen(words, window, phrase)
    chosen = np.unique(of_window)
    chosen = chosen[known.may_hold(chosen)] if len(chosen) else chosen
    cover = np.zeros(len(words.starts) + 1, np.int64)
    if len(chosen):
        automaton = ahocorasick.Automaton()
        order = np.argsort(keys, kind="stable")
        for k in at[order[np.searchsorted(keys[order], chosen)]].tolist():
            shape = text[begins[k] - 1 : ends[k + phrase - 1] + 1].decode("latin-1")
            automaton.add_word(shape, len(shape))
        automaton.make_automaton()
        found = np.array([end - size + 2 for end, size in automaton.iter(text.decode("latin-1"))], np.int64)
        hit = np.searchsorted(begins, found)
        first = np.maximum(hit - (window - phrase), words.first[np.searchsorted(words.first, hit, "right") - 1])
        np.add.at(cover, first, 1)
        np.add.at(cover, hit + 1, -1)
    inside = np.cumsum(cover[:-1]) > 0
    own = np.isin(of_window, chosen, kind="sort")
    return starts[inside[starts] & own], text, begins, ends


def _sequences(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha (of the words, one space between)."""
    names = ["doc_id", "n_words", "sha"]

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column("text")):
                words = find_words(data, offsets, SPACE)
                text, begins, ends = _normalized(words)
                shas = [sha256(text[begins[x] : ends[y - 1]] if y > x else b"").hexdigest() for x, y in zip(words.first, words.first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], pa.array(words.counts, pa.int64()), pa.array(shas, pa.string())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, sha string")


def _candidates(docs: DataFrame, copies: Copies, known: KeyFilter, window: int, phrase: int, keep_text: bool) -> DataFrame:
    """A row per document: n_words, sha of its words; for one with candidate windows also text, first words and keys."""
    sc = docs.sparkSession.sparkContext
    sent, skipped = sc.broadcast(known), sc.broadcast(copies)
    schema = "doc_id long, n_words long, sha string, text binary, starts binary, keys binary"

    def run(batches):
        for batch in batches:
            live = _live(batch, skipped.value)
            ids = live.column("doc_id")
            for a, b, data, offsets in text_chunks(live.column("text")):
                words = find_words(data, offsets, SPACE)
                starts, text, begins, ends = locate(words, sent.value, window, phrase)
                at, keys = words.windows(window)
                keys = keys[np.searchsorted(at, starts)]
                cut = np.searchsorted(starts, words.first)
                rows: list[list] = [[], [], [], []]
                for d in range(b - a):
                    first, last = words.first[d], words.first[d + 1]
                    own = text[begins[first] : ends[last - 1]] if last > first else b""
                    some = cut[d + 1] > cut[d]
                    rows[0].append(sha256(own).hexdigest())
                    rows[1].append(own if some or keep_text else None)
                    rows[2].append((starts[cut[d] : cut[d + 1]] - first).astype("<i4").tobytes() if some else None)
                    rows[3].append(keys[cut[d] : cut[d + 1]].tobytes() if some else None)
                kinds = [pa.string(), pa.binary(), pa.binary(), pa.binary()]
                arrays = [ids[a:b], pa.array(words.counts, pa.int64()), *(pa.array(r, k) for r, k in zip(rows, kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "sha", "text", "starts", "keys"])

    return docs.select("doc_id", "text", "h").mapInArrow(run, schema)


def _windows(found: DataFrame, wanted: KeyFilter | None = None) -> DataFrame:
    """key, doc_id, row, at of the candidate windows, or of those that the filter ``wanted`` holds."""
    sent = found.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            rows, ids = batch.column("row").to_numpy(), batch.column("doc_id").to_numpy()
            starts = [np.frombuffer(x.as_py(), "<i4") for x in batch.column("starts")]
            keys = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("keys")]
            if starts:
                n = [len(x) for x in starts]
                columns = [np.concatenate(keys), np.repeat(ids, n), np.repeat(rows, n), np.concatenate(starts)]
                if sent.value is not None:
                    held = sent.value.may_hold(columns[0].view(np.uint64))
                    columns = [c[held] for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "doc_id", "row", "at"])

    given = found.where(F.col("keys").isNotNull() & F.col("doc_id").isNotNull()).select("row", "doc_id", "starts", "keys")
    return given.mapInArrow(run, "key long, doc_id long, row long, at int")


def cut_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (binary: kept words, one space between; null unless ``keep_text``)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    with small_batches(spark, 500):  # of whole texts
        whole = materialize(_sequences(docs), "sequences")
        classes = whole.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
        copies = whole.join(classes, "sha").where("doc_id > first").select("doc_id", "n_words", "sha")
        copies = materialize(copies, "copies")
        skipped = _find_copies(whole, copies)
        copies = _left_out(copies, skipped)
        docs = docs.withColumn("h", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")))
        confirmed = (
            phrase_table(docs, skipped, window, phrase)
            .groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
        )
        known = key_filter(confirmed, "key", FILTER_BITS)
        found = _candidates(docs, skipped, known, window, phrase, keep_text)
        found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "phrase_windows")
    owner = _windows(found).groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    owner = materialize(owner.select("key", "first"), "window_owners")
    repeated = _windows(found, key_filter(owner, "key", FILTER_BITS))
    marks = repeated.join(owner, "key").where("doc_id > first")
    marks = marks.groupBy("row").agg(F.collect_list("at").alias("marks"))  # at most a document's words
    marks = materialize(marks, "marks")
    # Only texts that may have a mark are shuffled.
    marked = key_filter(marks.select(F.xxhash64("row").alias("h")), "h", COPY_FILTER_BITS)
    candidates = found.where("keys is not null")
    touched = split_by_keys(candidates.select("row", "doc_id", "n_words", "sha", "text"), marked, "row")[0].join(marks, "row", "left")
    carried = ["doc_id", "n_words", "sha", F.col("text") if keep_text else F.lit(None).cast("binary").alias("text")]
    untouched = split_by_keys(candidates.select("row", *carried), marked, "row")[1].drop("row")

    def run(batches):
        for batch in batches:
            removed, shas, kept = [], [], []
            for n, sha, text, at in zip(*(batch.column(c).to_pylist() for c in ("n_words", "sha", "text", "marks")), strict=True):
                gone = np.zeros(n + 1, np.int64)
                if at:
                    first = np.unique(np.array(at, np.int64))
                    np.add.at(gone, first, 1)
                    np.add.at(gone, first + window, -1)
                    text = b" ".join(w for w, g in zip(text.split(b" "), np.cumsum(gone)[:-1].tolist(), strict=True) if not g)
                    sha = sha256(text).hexdigest()
                removed.append(int((np.cumsum(gone)[:-1] > 0).sum()))
                shas.append(sha)
                kept.append(text if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"
    with small_batches(spark, 500):
        cut = materialize(touched.select("doc_id", "n_words", "sha", "text", "marks").mapInArrow(run, schema), "cut")
    zero = F.lit(0).cast("long")
    uncut = found.where("keys is null").select(*carried).unionByName(untouched)
    uncut = uncut.select("doc_id", "n_words", zero.alias("n_removed"), F.col("sha").alias("kept_sha256"), F.col("text").alias("kept"))
    gone = F.col("n_words") >= window
    short = F.lit(None).cast("binary")
    if keep_text:  # copies of fewer words than a window are kept as the first of them is
        texts = found.where("doc_id is not null").groupBy("sha").agg(F.min("text").alias("text"))
        copies = copies.join(texts, "sha", "left")
        short = F.when(gone, F.lit(b"")).otherwise(F.col("text"))
    copied = copies.select(
        "doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(zero).alias("n_removed"),
        F.when(gone, F.lit(sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"), short.alias("kept"),
    )
    return cut.unionByName(uncut).unionByName(copied)


def digest(docs: DataFrame) -> DataFrame:
    return cut_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
