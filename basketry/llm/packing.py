"""Best-fit packing by linear grouping.

Documents are tokenized inside tasks; longer ones are cut into pieces of at most
``capacity`` tokens, the first of which may be shorter. Only the histogram of piece
lengths (at most ``capacity`` rows) reaches the driver, where the plan is made on
counts, whatever the number of documents:

1. lengths over capacity / 16 are put in ``groups`` groups of equal cardinality and
   rounded up to the largest of their group;
2. configurations of these few sizes are optimised: a linear program over all of them,
   solved by column generation, says how often each is used, rounded down;
3. the actual lengths take the places of the rounded ones;
4. short lengths and sizes left over fill the rest, each in the tightest room that holds it.

Plain best fit of all lengths is planned too; the plan with fewer sequences counts.

The plan says which ranks of each length go where. Ranks are numbered in salted
parts of a length, so that a frequent length is no single task. Pieces find their
place by binary search in the plan, which is bounded by groups and capacity.

Null text is empty; an empty document is one token (the separator). Repeated
rows are packed each. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import bpe
from basketry.llm.common import releasing
from basketry.session import materialize

CAPACITY = 2048
GROUPS = 96
SALTS = 32
#: Columns that may enter the linear program; a bound on planning time, the plan is valid after any number.
ROUNDS = 4000
SEPARATOR = 0


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    @releasing
    def run(batches):
        made = bpe.coder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            ids, texts = batch.column(0), batch.column(1)
            for r in range(len(batch)):
                tokens = np.array([*made.encode(texts[r].as_py() or ""), SEPARATOR], "<u4")
                end = len(tokens) % capacity or capacity
                start = 0
                for piece in range(-(-len(tokens) // capacity)):
                    out.append((ids[r].as_py(), piece, start, end - start, zlib.crc32(tokens[start:end].tobytes())))
                    start, end = end, end + capacity
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Supply:
    """Pieces of one group: (length, count), longest first; hands out ranks of lengths."""

    def __init__(self, runs: list[tuple[int, int]], used: dict[int, int]) -> None:
        self.runs, self.used = list(reversed(runs)), used

    def take(self, n: int) -> list[tuple[int, int, int]]:
        """(length, first rank, count) runs of the next n pieces."""
        out = []
        while n:
            length, count = self.runs.pop()
            m = min(n, count)
            out.append((length, self.used.get(length, 0), m))
            self.used[length] = self.used.get(length, 0) + m
            if count > m:
                self.runs.append((length, count - m))
            n -= m
        return out


def _best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size the most valuable configuration holds (an unbounded knapsack by weight)."""
    value, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for k in np.flatnonzero(prices > 1e-12).tolist():
        s = sizes[k]
        for _ in range(capacity // s):
            new = value[:-s] + prices[k]
            better = new > value[s:] + 1e-12
            if not better.any():
                break
            value[s:][better] = new[better]
            pick[s:][better] = k
    chosen, at = np.zeros(len(sizes)), capacity
    while pick[at] >= 0:
        chosen[pick[at]] += 1
        at -= sizes[pick[at]]
    return chosen


def _optimised(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(numbers of each size, times) of configurations that hold all sizes in the fewest sequences, times rounded down.

    Column generation: a simplex basis of as many configurations as sizes, into which the
    configuration of the greatest value at the basis' prices enters until none is worth more than one sequence.
    """
    basis = np.diag([float(capacity // s) for s in sizes])
    times = np.array(counts, float) / np.diag(basis)
    for _ in range(ROUNDS):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = _best_configuration(sizes, prices, capacity)
        if column @ prices <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, times / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = column
        times = np.maximum(np.linalg.solve(basis, np.array(counts, float)), 0)
    left, made = np.array(counts), []
    for j in np.argsort(-times):
        column = basis[:, j].astype(int)
        n = int(min(np.floor(times[j] + 1e-6), np.min(left[column > 0] // column[column > 0])))
        if n > 0:
            left = left - n * column
            made.append((column.tolist(), n))
    return made


Bins = list[tuple[int, int, list[tuple[int, int]]]]  # count, room left, [(length, first rank)]


def _grouped(histogram: dict[int, int], capacity: int, groups: int) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """Rounded sizes, longest first, and the (length, count) runs of each: large lengths in groups of equal cardinality.

    No more lengths than groups are sizes as they are.
    """
    large = sorted((x for x in histogram.items() if x[0] > capacity // 16 and x[1]), reverse=True)
    if len(large) <= groups:
        return [length for length, _ in large], [[x] for x in large]
    each = max(1, -(-sum(n for _, n in large) // groups))
    grouped: list[list[tuple[int, int]]] = []
    room = 0
    for length, n in large:
        while n:
            if not room:
                grouped.append([])
                room = each
            m = min(n, room)
            grouped[-1].append((length, m))
            n, room = n - m, room - m
    sizes: list[int] = []
    supply: list[list[tuple[int, int]]] = []
    for g in grouped:  # groups of one and the same length are one size
        if sizes and sizes[-1] == g[0][0]:
            supply[-1] += g
        else:
            sizes.append(g[0][0])
            supply.append(g)
    return sizes, supply


def _configurations(histogram: dict[int, int], capacity: int, groups: int) -> tuple[Bins, dict[int, int]]:
    """Sequences of the optimised configurations, and how many of each length they hold."""
    sizes, supply = _grouped(histogram, capacity, groups)
    used: dict[int, int] = {}
    bins: Bins = []
    hands = [_Supply(g, used) for g in supply]
    for numbers, times in _optimised(sizes, [sum(n for _, n in g) for g in supply], capacity) if sizes else []:
        slots = [hands[k].take(times) for k, c in enumerate(numbers) for _ in range(c)]
        cuts = sorted({0, *(c for s in slots for c in np.cumsum([m for _, _, m in s]).tolist())})
        for a, b in zip(cuts, cuts[1:], strict=False):
            content = []
            for s in slots:
                at = 0
                for length, rank, m in s:
                    if at <= a < at + m:
                        content.append((length, rank + a - at))
                        break
                    at += m
            bins.append((b - a, capacity - sum(x for x, _ in content), content))
    return bins, used


def _best_fit(bins: Bins, histogram: dict[int, int], used: dict[int, int], capacity: int) -> None:
    """Adds what ``used`` leaves over, longest first, each to the tightest room that holds it; equal rooms are one run."""
    rooms = sorted((r, i) for i, (_, r, _) in enumerate(bins) if r)
    for length, n in sorted(histogram.items(), reverse=True):
        rank = used.get(length, 0)
        n -= rank
        while n > 0:
            at = bisect_left(rooms, (length, -1))
            if at == len(rooms):
                bins.append((max(1, n // (capacity // length)), capacity, []))
                insort(rooms, (capacity, len(bins) - 1))
                continue
            r, i = rooms.pop(at)
            count, _, content = bins[i]
            fit = min(r // length, n)
            m = min(count, n // fit)
            if m < count:
                bins.append((count - m, r, [(x, k + m) for x, k in content]))
                insort(rooms, (r, len(bins) - 1))
            content = content + [(length, rank + j * m) for j in range(fit)]
            bins[i] = (m, r - fit * length, content)
            if r - fit * length:
                insort(rooms, (r - fit * length, i))
            rank, n = rank + fit * m, n - fit * m


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(length, first rank, count, first sequence, offset) rows, and the number of sequences.

    Optimised configurations lose up to a sequence a group by rounding, so on few pieces plain best fit
    decreasing can be the better; the plan with fewer sequences counts.
    """
    bound = -(-sum(k * n for k, n in histogram.items()) // capacity)
    best: Bins | None = None
    for bins, used in (_configurations(histogram, capacity, groups), ([], {})):
        _best_fit(bins, histogram, used, capacity)
        if best is None or sum(b[0] for b in bins) < sum(b[0] for b in best):
            best = bins
        if sum(b[0] for b in best) <= bound:
            break
    rows, sequence = [], 0
    for count, _, content in best or []:
        offset = 0
        for length, rank in content:
            rows.append((length, rank, count, sequence, offset))
            offset += length
        sequence += count
    return rows, sequence


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int")
    cut = materialize(pieces(docs, tokenizer, capacity).withColumn("salt", salt), "pieces")
    parts = materialize(cut.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, capacity, groups)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    sent = spark.sparkContext.broadcast(table)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    bases = parts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = cut.withColumn("nth", nth).join(F.broadcast(bases), ["length", "salt"])  # capacity x SALTS rows at most
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    @releasing
    def run(batches):
        lengths, firsts, _, sequences, offsets = sent.value.T
        index = lengths << 48 | firsts
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = np.searchsorted(index, length << 48 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequences[row] + rank - firsts[row]), pa.array(offsets[row])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
