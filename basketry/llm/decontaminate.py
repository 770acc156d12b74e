"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over all windows of the documents.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z in lower case.
A window is ``length`` consecutive words of an item; an item of fewer words is
one window as a whole. A document word inside any occurrence of a window is
hit. Keys of windows are looked up first, hits are then compared word by word.

Windows are broadcast as sorted arrays of keys and places in the item text, in blocks of
``block_bytes`` of text and ids; longer items are cut with an overlap. A larger benchmark takes one pass per block
within the same tasks, which then hold all blocks: about five bytes for each byte of the benchmark. Documents are not shuffled.

Null or empty text has no words and no hits. A null item text has no windows; a
null item_id hits words but is not listed. Repeated documents are judged alike;
repeated item_ids count once. Extra columns pass through; one that is called
like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import append_columns, fresh
from basketry.llm.words import LOWER, NOT_ALNUM, find_words, text_chunks

WINDOW = 13
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22


class _Windows(NamedTuple):
    """All windows of one number of words, by key."""

    keys: np.ndarray  # ascending
    places: np.ndarray  # the first word of each
    filter: np.ndarray  # of low key bits, true where a key has them

    def runs(self, wanted: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(position in ``wanted``, first and end row) where a key is held."""
        likely = np.flatnonzero(self.filter[wanted & np.uint64(len(self.filter) - 1)])
        low, up = (np.searchsorted(self.keys, wanted[likely], side) for side in ("left", "right"))
        held = low < up
        return zip(likely[held].tolist(), low[held].tolist(), up[held].tolist(), strict=True)


class WindowIndex:
    """The windows of some items: sorted keys, and places in the items' words, held once with one blank between.

    About five bytes for each byte of ordinary item text.
    """

    def __init__(self, items: list[tuple[str | None, str]], length: int) -> None:
        self.ids = [i for i, _ in items]
        parts, sizes = [], []
        for _, _, data, offsets in text_chunks(pa.array([t for _, t in items], pa.string())):
            words = find_words(LOWER[data], offsets, NOT_ALNUM)
            joined = [words.joined(k) for k in range(len(offsets) - 1)]
            parts += joined
            sizes += map(len, joined)
        self.text = b"".join(parts)
        offsets = np.append(0, np.cumsum(np.array(sizes, np.int64)))
        words = find_words(np.frombuffer(self.text, np.uint8), offsets, NOT_ALNUM)
        small = np.uint32 if len(self.text) < 1 << 32 else np.int64
        self.starts, self.ends, self.first = words.starts.astype(small), words.ends.astype(small), words.first
        self.windows: dict[int, _Windows] = {}
        for n in {min(length, int(c)) for c in np.unique(words.counts) if c}:
            at, keys = words.windows(n)
            own = np.minimum(words.counts, length)[words.documents_of(at)] == n
            at, keys = at[own], keys[own]
            order = np.argsort(keys, kind="stable")
            bits = np.zeros(1 << min(_FILTER_BITS, (8 * len(keys)).bit_length()), bool)
            bits[keys & np.uint64(len(bits) - 1)] = True
            self.windows[n] = _Windows(keys[order], at[order].astype(small), bits)

    def hits(self, words) -> Iterator[tuple[int, int, set[str | None]]]:
        """(first word, number of words, items) of every occurrence."""
        for n, held in self.windows.items():
            at, keys = words.windows(n)
            for k, low, up in held.runs(keys):
                k = int(at[k])
                phrase = _phrase(words, k, n)
                places = [p for p in held.places[low:up].tolist() if self.text[self.starts[p] : self.ends[p + n - 1]] == phrase]
                if places:
                    yield k, n, {self.ids[i] for i in np.searchsorted(self.first, places, "right") - 1}


def _phrase(words, k: int, n: int) -> bytes:
    return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[k : k + n].tolist(), words.ends[k : k + n].tolist(), strict=True))


def _parts(text: str, length: int, block_bytes: int) -> Iterator[str]:
    """``text``, or pieces of about ``block_bytes`` that have all its windows: each but the first repeats ``length`` - 1 words."""
    data = text.encode()
    if len(data) <= block_bytes:
        yield text
        return
    words = find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), NOT_ALNUM)
    k = 0
    while k < len(words.starts):
        end = max(k + length, int(np.searchsorted(words.ends, words.starts[k] + block_bytes, "right")))
        if end >= len(words.starts):
            yield data[words.starts[min(k, max(0, len(words.starts) - length))] :].decode()
            return
        yield data[words.starts[k] : words.ends[end - 1]].decode()
        k = end - length + 1


def blocks(items: DataFrame, length: int, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """(id, text) rows, equal ones once, in lists of about ``block_bytes`` of text and ids; at least one list."""
    rows, size, made = [], 0, False
    for r in items.distinct().toLocalIterator():
        for part in _parts(r["text"], length, block_bytes):
            if rows and size + len(part.encode()) > block_bytes:
                yield rows
                rows, size, made = [], 0, True
            rows.append((r["id"], part))
            size += len(part.encode()) + len(r["id"] or "") + 16
    if rows or not made:
        yield rows


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    length: int = WINDOW,
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words`` long, ``hit_words`` array<int> (positions, ascending) and ``hit_items`` array<string> (sorted)."""
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text")).where(F.col("text").isNotNull())
    result = docs
    parts: list[tuple[str, str]] = []
    for block, rows in enumerate(blocks(items, length, block_bytes)):
        sent = sc.broadcast(WindowIndex(rows, length))
        words_name, items_name = (fresh(f"__{k}{block}", result.columns) for k in ("hit_words", "hit_items"))
        parts.append((words_name, items_name))
        fields = [
            T.StructField("n_words", T.LongType()),
            T.StructField(words_name, T.ArrayType(T.IntegerType())),
            T.StructField(items_name, T.ArrayType(T.StringType())),
        ]

        def compute(texts: pa.Array, sent=sent) -> list[pa.Array]:
            counts, hit_words, hit_items = [], [], []
            for a, b, data, offsets in text_chunks(texts):
                words = find_words(LOWER[data], offsets, NOT_ALNUM)
                counts.append(words.counts)
                at: list[set[int]] = [set() for _ in range(b - a)]
                ids: list[set[str]] = [set() for _ in range(b - a)]
                for k, n, items in sent.value.hits(words):
                    doc = int(np.searchsorted(words.first, k, "right")) - 1
                    at[doc].update(range(k - int(words.first[doc]), k - int(words.first[doc]) + n))
                    ids[doc].update(x for x in items if x is not None)
                hit_words += map(sorted, at)
                hit_items += map(sorted, ids)
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            return [pa.array(counts, pa.int64()), pa.array(hit_words, pa.list_(pa.int32())), pa.array(hit_items, pa.list_(pa.string()))]

        result = append_columns(result, text_column, fields, compute)
    hit_words = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(w) for w, _ in parts]))))
    hit_items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(i) for _, i in parts]))))
    return result.withColumns({"hit_words": hit_words, "hit_items": hit_items}).drop(*[c for p in parts for c in p])


def contaminated():
    """At least one hit word, and a twentieth of all words or more."""
    return (F.size("hit_words") > 0) & (F.lit(20) * F.size("hit_words") >= F.col("n_words"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return scan(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns as they were."""
    # Result columns are computed beside a packed copy, so that columns of the same name survive.
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"] or [F.lit(0)]
    left = scan(docs.select(F.struct(*others).alias("row"), F.col("text")), benchmark).where(~contaminated())
    return left.select(*[F.col("text").alias(c) if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with hit words cut from the texts, with what separates them from the next word; null stays null."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    found = scan(packed, benchmark)

    def compute(texts: pa.Array) -> list[pa.Array]:
        cut = []
        for value in texts.to_pylist():
            if value is None or not value["hits"]:
                cut.append(value and value["text"])
                continue
            raw = value["text"].encode()
            data = np.frombuffer(raw, np.uint8)
            words = find_words(LOWER[data], np.array([0, len(data)]), NOT_ALNUM)
            keep = np.ones(len(data), bool)
            bounds = np.append(words.starts, len(data))
            for k in value["hits"]:
                keep[bounds[k] : bounds[k + 1]] = False
            cut.append(data[keep].tobytes().decode())
        return [pa.array(cut, pa.string())]

    hit = found.select("row", F.struct(F.col("text"), F.col("hit_words").alias("hits")).alias("judged"))
    cut = append_columns(hit, "judged", [T.StructField("__clean", T.StringType())], compute)
    return cut.select(*[F.col("__clean").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
