"""Quality classification by the perplexity of an interpolated modified Kneser-Ney n-gram model.

The model is over bytes (ASCII letters in lower case) of order seven and trained on
the whole text of all trusted documents. Counts are folded inside tasks, summed
by a shuffle on the n-gram, and the tables of each order - counts, continuation
counts, context totals, discounts - are joined shard by shard into one of final probabilities.

Documents are scored in passes: the table is cut in shards by the two bytes before the predicted
one, as many as keep a shard under ``SHARD_BYTES``. A pass is a job of its own: it broadcasts one shard and adds
up the log-probabilities of the positions it covers, by the digest of the text; the sums of all passes are joined to the documents.
A table of one shard needs no join. A document is low quality if its perplexity exceeds the quantile of the trusted
documents of its language, times a margin. The trusted documents are scored for it as if the position itself had not been counted.

Null or empty text has no perplexity and is not kept. Null lang is a group of its own; a
language without trusted documents takes the quantile of all trusted ones. A repeated trusted
document counts twice. Without any trusted text nothing is rejected but empty texts. Extra
columns pass through ``score``; one that is called like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import append_columns, fresh, key_filter, releasing, small_batches, split_by_keys
from basketry.llm.words import LOWER, text_chunks
from basketry.session import materialize

ORDER = 7  # a key of eight bytes would not fit a signed long
SHARD_BYTES = 32 << 20
FOLD_ROWS = 1 << 20
BATCH_ROWS = 1000  # of texts; executors hold several batches at once
FILTER_BITS = 27
_ROW_BYTES = 16
QUANTILE = 0.995
MARGIN = 2.0
COPIES = 256  # texts with more are joined by a broadcast
_SPREAD = 40503
_HASH = np.uint64(0x9E3779B97F4A7C15)
_PAD = 0x0A  # before the first byte


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-gram that ends at each byte of the documents, and each byte's document."""
    lengths = np.diff(offsets)
    pad = ORDER - 1
    doc = np.repeat(np.arange(len(lengths)), lengths)
    padded = np.full(len(data) + pad * len(lengths), _PAD, np.uint8)
    first = np.arange(len(data)) + pad * doc  # of each byte's n-gram
    padded[first + pad] = LOWER[data]
    keys = np.zeros(max(0, len(padded) - pad), np.int64)
    for k in range(ORDER):
        keys <<= 8
        keys |= padded[k : k + len(keys)]
    return keys[first], doc


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic.

    Membership is settled on ids alone: a filter of fixed size lets the good ones through and a few
    others, which are found by a join of ids and taken out again. Texts are not shuffled while the ids taken out are few
    enough to be broadcast (beyond that Spark joins by a shuffle).
    """
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    good = good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where("doc_id is not null")
    sent = key_filter(good.select(F.xxhash64("doc_id").alias("h")), "h", FILTER_BITS)
    passed = split_by_keys(narrow.select("doc_id"), sent, "doc_id")[0].distinct().join(good, "doc_id", "left_anti")
    with small_batches(docs.sparkSession, BATCH_ROWS):
        others = materialize(passed, "kn_others")
    return split_by_keys(narrow, sent, "doc_id")[0].join(others, "doc_id", "left_anti")


def _fold(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sums of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))  # keys are not negative
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _batches(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "c"])
    for at in range(0, len(keys), 1 << 16):
        yield whole.slice(at, 1 << 16)


def gram_counts(texts: DataFrame) -> DataFrame:
    """(key, c) of all n-grams of the highest order."""

    @releasing
    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                parts.append(np.unique(_grams(data, offsets)[0], return_counts=True))
                held += len(parts[-1][0])
                if held <= FOLD_ROWS:
                    continue
                parts = [_fold(parts)]
                held = len(parts[0][0])
                if held > FOLD_ROWS // 2:  # new n-grams keep coming: on to the shuffle
                    yield from _batches(*parts[0])
                    parts, held = [], 0
        if parts:
            yield from _batches(*_fold(parts))

    return texts.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams counted once to four times."""
    r = counts.agg(*[F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4)]).first()
    n = [max(1, x or 0) for x in r]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.1 * k), 0.9 * k) for k, d in enumerate(raw, 1))  # kept inside (0, k) on tiny tables


def _low(bytes_: int) -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << 8 * bytes_) - 1))


def probability_table(counts: DataFrame) -> DataFrame:
    """(order, key, value, once): probabilities of n-grams (order 1 to ``ORDER``) and, with order -k, the backoff weights of contexts of k bytes.

    ``once``: counted once, so a position that meets it all the way down from the highest order is the one that was counted.
    """
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct bytes to the left
        tables[k] = materialize(tables[k + 1].groupBy(_low(k).alias("key")).agg(F.count("*").alias("c")), f"kn{k}")
    lower: DataFrame | None = None
    rows: list[DataFrame] = []
    for k in range(1, ORDER + 1):
        d = _discounts(tables[k])
        c = F.col("c")
        cut = F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
        same = Window.partitionBy("context")  # at most 256 rows
        joined = tables[k].withColumn("context", F.shiftright("key", 8)).select(
            "key", "c", F.sum("c").over(same).alias("total"), F.sum(cut).over(same).alias("freed"), (F.min("key").over(same) == F.col("key")).alias("first")
        )
        if lower is None:
            base: Column = F.lit(1 / 256)
        else:
            joined = joined.withColumn("suffix", _low(k - 1)).join(lower.select(F.col("key").alias("suffix"), F.col("value").alias("base")), "suffix")
            base = F.col("base")
        weight = F.col("freed") / F.col("total")
        value = (c - cut) / F.col("total") + weight * base
        columns = [value.alias("value"), (c == 1).alias("once"), F.when(F.col("first"), weight).alias("weight"), (F.col("total") == 1).alias("alone")]
        lower = materialize(joined.select("key", *columns), f"kn_p{k}")
        rows.append(lower.select(F.lit(k).alias("order"), "key", "value", "once"))
        contexts = lower.where("weight is not null")  # one row of each context has it
        rows.append(contexts.select(F.lit(1 - k).alias("order"), F.shiftright("key", 8).alias("key"), F.col("weight").alias("value"), F.col("alone").alias("once")))
    table = rows[0]
    for r in rows[1:]:
        table = table.unionByName(r)
    return table


@dataclass
class Shard:
    """Tables of one shard, keys ascending; order as in ``probability_table``. Values of what was counted once are negative."""

    tables: dict[int, tuple[np.ndarray, np.ndarray]]
    _longest: tuple[np.ndarray, np.ndarray, np.ndarray, np.uint64] | None = None

    def _find_longest(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``_find`` of the highest order in keys of any order, by buckets of a hash."""
        if self._longest is None:  # made where it is used, not sent
            known, values = self.tables.get(ORDER, (np.zeros(0, np.int64), np.zeros(0)))
            bits = max(1, len(known).bit_length())
            shift = np.uint64(64 - bits)
            bucket = known.view(np.uint64) * _HASH >> shift
            order = np.argsort(bucket, kind="stable")
            first = np.searchsorted(bucket[order], np.arange((1 << bits) + 1, dtype=np.uint64))
            self._longest = np.append(known[order], -1), np.append(values[order], 0.0), first, shift
        known, values, first, shift = self._longest
        bucket = (keys.view(np.uint64) * _HASH >> shift).view(np.int64)
        at, end = first[bucket], first[bucket + 1]
        seen = known[at] == keys  # of an empty bucket, the next one's: another key, as its hash differs
        todo = np.flatnonzero(~seen & (at + 1 < end))
        while len(todo):
            at[todo] += 1
            same = known[at[todo]] == keys[todo]
            seen[todo] = same
            todo = todo[~same & (at[todo] + 1 < end[todo])]
        return seen, values[at]

    def _find(self, order: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.tables.get(order, (np.zeros(0, np.int64), np.zeros(0)))
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at]

    def log2(self, keys: np.ndarray) -> np.ndarray:
        """Log-probability of the last byte of each n-gram after the others."""
        return np.log2(self._walk(keys, False)[0])

    def log2_both(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``log2``, and for n-grams of the training text the same as if the position itself had not been counted.

        What was counted once goes: an n-gram whose longer one is gone and that has one byte to its left has only that one.
        """
        seen, p = self._find_longest(keys)
        rest = np.flatnonzero(~seen | (p < 0))
        different, back = np.unique(keys[rest], return_inverse=True)
        found, once = self._walk(different, False)
        p[rest] = found[back]
        left_out = p.copy()
        found[once] = self._walk(different[once], True)[0]
        left_out[rest] = found[back]
        return np.log2(p), np.log2(left_out)

    def _walk(self, keys: np.ndarray, left_out: bool) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, from the longest n-gram known, and where something was met that was counted once."""
        p, once = np.zeros(len(keys)), np.zeros(len(keys), bool)
        todo, factor = np.arange(len(keys)), np.ones(len(keys))
        for k in range(ORDER, 0, -1):
            part = keys[todo] & ((1 << 8 * k) - 1)
            seen, value = self._find(k, part)
            once[todo[seen & (value < 0)]] = True
            if left_out:
                seen &= value > 0
            p[todo[seen]] = factor[seen] * np.abs(value[seen])
            todo, factor, part = todo[~seen], factor[~seen], part[~seen]
            seen, weight = self._find(1 - k, part >> 8)
            once[todo[seen & (weight < 0)]] = True
            if left_out:
                seen &= weight > 0
            factor = np.where(seen, factor * np.abs(weight), factor)  # as if the context were not there
        p[todo] = factor / 256
        return p, once


def _shard_of(context: Column, shards: int) -> Column:
    """The shard of n-grams by the last two bytes of their context; ``_shards_of`` is the same."""
    return F.shiftright(context.bitwiseAND(F.lit(0xFFFF)) * _SPREAD, 8) % shards


def _shards_of(contexts: np.ndarray, shards: int) -> np.ndarray:
    return ((contexts & 0xFFFF) * _SPREAD >> 8) % shards


def _bits(texts: pa.Array, shard: Shard, s: int, shards: int) -> list[pa.Array]:
    """The bits of each text at the positions that shard ``s`` covers, as they are and left out."""
    bits: tuple[list, list] = ([np.zeros(0)], [np.zeros(0)])
    covered = _shards_of(np.arange(1 << 16), shards) == s
    for a, b, data, offsets in text_chunks(texts, 1 << 18):
        keys, doc = _grams(data, offsets)
        if shards > 1:
            mine = np.flatnonzero(covered[keys >> 8 & 0xFFFF])
            keys, doc = keys[mine], doc[mine]
        for made, found in zip(bits, shard.log2_both(keys), strict=True):
            made.append(-np.bincount(doc, found, b - a))
    return [pa.array(np.concatenate(made)) for made in bits]


def scorer(
    docs: DataFrame, table: DataFrame, text_column: str = "text", shard_bytes: int = SHARD_BYTES
) -> Callable[..., DataFrame]:
    """Adds ``perplexity`` (double; null without text) to rows of ``docs``. With more than one shard the passes run here, once.

    With ``left_out``, for trusted rows: by a model that has not counted the position.
    """
    spark = docs.sparkSession
    shards = min(1 << 14, max(1, -(-table.count() * _ROW_BYTES // shard_bytes)))
    context = F.when(F.col("order") > 0, F.shiftright("key", 8)).otherwise(F.col("key"))
    everywhere = F.col("order").between(-1, 2)  # contexts shorter than two bytes
    text = F.col(f"`{text_column}`")

    def send(s: int) -> Broadcast:
        own = table.where(everywhere | (_shard_of(context, shards) == s))
        rows = own.select("order", "key", F.when(F.col("once"), -F.col("value")).otherwise(F.col("value")).alias("value")).toArrow()  # at most about shard_bytes
        order, keys, values = (rows.column(c).to_numpy() for c in ("order", "key", "value"))
        tables = {}
        for k in np.unique(order).tolist():
            at = np.flatnonzero(order == k)
            at = at[np.argsort(keys[at], kind="stable")]
            tables[k] = (keys[at], values[at])
        return spark.sparkContext.broadcast(Shard(tables))

    if shards == 1:
        sent = send(0)
    else:
        with small_batches(spark, BATCH_ROWS):
            found = _passes(docs.select(F.sha2(text, 256).alias("digest"), text.alias("text")), send, shards)

    def add(rows: DataFrame, left_out: bool = False) -> DataFrame:
        plain = fresh("__bits", rows.columns)
        out = fresh("__out", [*rows.columns, plain])
        if shards == 1:
            fields = [T.StructField(c, T.DoubleType()) for c in (plain, out)]
            result = append_columns(rows, text_column, fields, lambda texts: _bits(texts, sent.value, 0, 1))
        else:
            result = _join_by_text(rows, text, found, plain, out)
        n_bytes = F.octet_length(text)
        bits = F.col(out if left_out else plain)
        return result.withColumn("perplexity", F.when(n_bytes > 0, F.pow(F.lit(2.0), bits / n_bytes))).drop(plain, out)

    return add


def score(docs: DataFrame, table: DataFrame, text_column: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with ``perplexity``."""
    return scorer(docs, table, text_column, shard_bytes)(docs)


def _passes(texts: DataFrame, send: Callable[[int], Broadcast], shards: int) -> DataFrame:
    """(digest, bits, out, copies) of the different texts, from one pass for each shard."""
    parts: list[DataFrame] = []
    for s in range(shards):
        sent = send(s)

        @releasing
        def run(batches, sent=sent, s=s):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), *_bits(b.column(1), sent.value, s, shards)], names=["digest", "bits", "out"])

        found = texts.where("text <> ''").mapInArrow(run, "digest string, bits double, out double")
        parts.append(materialize(found.select(F.unhex("digest").alias("digest"), "bits", "out"), "kn_bits"))
        sent.destroy()
    rows = parts[0]
    for r in parts[1:]:
        rows = rows.unionByName(r)
    copies = F.count("*") / shards  # equal texts have equal bits
    sums = [(F.sum(c) / copies).alias(c) for c in ("bits", "out")]
    return materialize(rows.groupBy("digest").agg(*sums, copies.alias("copies")), "kn_text_bits")


def _join_by_text(docs: DataFrame, text: Column, found: DataFrame, *names: str) -> DataFrame:
    """``docs`` with the bits of their texts; those of texts with many copies are sent, so that no task gets all copies."""
    digest, light, heavy = (fresh(n, [*docs.columns, *names]) for n in ("__digest", "__light", "__heavy"))

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col("digest").alias(name), *[F.col(c).alias(name + c) for c in ("bits", "out")])

    many, few = side(found.where(F.col("copies") > COPIES), heavy), side(found.where(F.col("copies") <= COPIES), light)
    rows = docs.withColumn(digest, F.unhex(F.sha2(text, 256)))
    rows = rows.join(F.broadcast(many), F.col(digest) == F.col(heavy), "left")
    # Rows that are settled, or have no text, meet nothing and are dealt at random.
    open_ = F.col(heavy).isNull() & (F.octet_length(text) > 0)
    rows = rows.withColumn(digest, F.when(open_, F.col(digest)).otherwise(F.encode(F.rand().cast("string"), "utf-8")))
    rows = rows.join(few, F.col(digest) == F.col(light), "left")
    made = {n: F.coalesce(heavy + c, light + c) for n, c in zip(names, ("bits", "out"), strict=True)}
    return rows.withColumns(made).select(*docs.columns, *names)


def train(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The probability table, and the trusted documents."""
    trusted = trusted_documents(docs, labels)  # read twice, not written
    with small_batches(docs.sparkSession, BATCH_ROWS):
        counts = materialize(gram_counts(trusted), "kn_counts")
    return probability_table(counts), trusted


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``docs`` with perplexity, threshold and kept."""
    table, trusted = train(docs, labels)
    add = scorer(docs, table)
    with small_batches(docs.sparkSession, BATCH_ROWS):
        trusted = materialize(add(trusted, left_out=True).where("perplexity is not null").select("lang", "perplexity"), "trusted_perplexity")
    q = F.percentile_approx("perplexity", quantile, 10_000)
    every = trusted.agg((q * margin).alias("t")).first()["t"]
    language, limit = fresh("__lang", docs.columns), fresh("__limit", docs.columns)
    by = trusted.groupBy("lang").agg((q * margin).alias(limit)).withColumnRenamed("lang", language)
    scored = add(docs).join(by, F.col("lang").eqNullSafe(F.col(language)), "left")
    threshold = F.coalesce(limit, F.lit(every).cast("double"), F.lit(float("inf")))
    kept = F.coalesce(F.col("perplexity") <= threshold, F.lit(False))
    return scored.withColumns({"threshold": threshold, "kept": kept}).drop(language, limit)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, perplexity, threshold and kept."""
    rounded = [F.round(c, 6).alias(c) for c in ("perplexity", "threshold")]
    return classify(docs.select("doc_id", "lang", "text"), labels).select("doc_id", *rounded, "kept")
