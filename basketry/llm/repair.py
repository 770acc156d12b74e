"""Repair of conversation structure by generalised LR parsing with weighted edits.

The rows of a conversation are read in order over a graph-structured stack (``glr``). A row is kept,
given the other role, or deleted, and empty turns are inserted; stacks with equal tops merge to
their minimum (cost, audit). What all living stacks agree on is settled and passed on to the hash, so
a conversation of any length is read as a stream: neither its texts nor its paths are held whole.

Costs (fixed by the contract): keep 0, rerole 2, delete 3, insert 2, and 1 for each truncated row
that stays. Blank and repeated rows have to go. Ties go to the ASCII-least audit.

Exchanges: which (conversation, role, text) occur more than once is found from digests, counted before
they are shuffled; rows then go to their conversation and are sorted there. The hash of a
conversation is over all its texts in order, so one conversation is one task's stream.

Defined cases: null role or text is one space, so such a text is blank and such a role has no legal
place; a null conv_id is a conversation; a null turn comes first and counts for no gap; rows of one
turn are ordered by role and text as they were before damage; equal rows are rows of their own. A
role counts by its first character. A table without rows gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.glr import ROLE_GRAMMAR, Automaton, Node, Stacks

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: A stack dearer than the cheapest by more than this can't win: from any stack two inserts
#: complete a turn (4), and after a whole turn all that another stack can still read is legal but for a head, which is deleted (3).
SLACK = 2 * INSERT + DELETE
#: Rows held before the common part of all paths is looked for.
SETTLE = 64

_ILLEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_SPACE = " \t\n\x0b\x0c\r"


@cache
def _stacks() -> Stacks:
    return Stacks(Automaton(ROLE_GRAMMAR))


class Repair:
    """The cheapest repair of one conversation, row by row."""

    def __init__(self) -> None:
        self.stacks = _stacks()
        self.frontier: dict[Node, tuple[int, str]] = {self.stacks.start: (0, "")}
        self.held: list[tuple[str, str]] = []  # rows of which it is open what becomes of them
        self.limit = SETTLE
        self.audit: list[str] = []  # settled, in pieces
        self.hash = sha256()
        self.turns = 0
        self.due = "u"  # the role a rerole or insert has at the next place

    def _inserted(self) -> dict[Node, tuple[int, str]]:
        best = dict(self.frontier)
        open_ = list(best)
        while open_:
            node = open_.pop()
            cost, audit = best[node]
            for symbol in ROLES:
                for top in self.stacks.shift(node, symbol):
                    new = (cost + INSERT, audit + "I")
                    if top not in best or new < best[top]:
                        best[top] = new
                        open_.append(top)
        return best

    def read(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        after: dict[Node, tuple[int, str]] = {}

        def offer(top: Node, cost: int, audit: str) -> None:
            if top not in after or (cost, audit) < after[top]:
                after[top] = (cost, audit)

        initial, extra = role[:1], TRUNCATED if truncated else 0
        for node, (cost, audit) in self._inserted().items():
            offer(node, cost + DELETE, audit + "D")
            if must_go:
                continue
            for top in self.stacks.shift(node, initial):
                offer(top, cost + extra, audit + "K")
            for symbol in ROLES:
                if symbol != initial:
                    for top in self.stacks.shift(node, symbol):
                        offer(top, cost + extra + REROLE, audit + "R")
        bound = min(cost for cost, _ in after.values()) + SLACK
        self.frontier = {node: path for node, path in after.items() if path[0] <= bound}
        self.held.append((role, text))
        if len(self.held) >= self.limit:
            self._settle()
            self.limit = max(SETTLE, 2 * len(self.held))

    def _settle(self) -> None:
        """Take what all paths have in common off them."""
        audits = [audit for _, audit in self.frontier.values()]
        low, high = min(audits), max(audits)
        size = next((i for i, c in enumerate(low) if high[i : i + 1] != c), len(low))
        self._apply(low[:size])
        self.frontier = {node: (cost, audit[size:]) for node, (cost, audit) in self.frontier.items()}

    def _apply(self, audit: str) -> None:
        row = 0
        for letter in audit:
            if letter == "I":
                self._turn(ROLES[self.due], "")
                continue
            role, text = self.held[row]
            row += 1
            if letter == "K":
                self._turn(role, text)
            elif letter == "R":
                self._turn(ROLES[self.due], text)
        del self.held[:row]
        self.audit.append(audit)

    def _turn(self, role: str, text: str) -> None:
        self.hash.update(f"\n{role}:{text}".encode() if self.turns else f"{role}:{text}".encode())
        self.turns += 1
        self.due = "a" if role[:1] == "u" else "u"

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, hash of the repaired rows)."""
        cost, audit = min(path for node, path in self._inserted().items() if self.stacks.complete(node))
        self._apply(audit)
        return cost, "".join(self.audit), self.hash.hexdigest()


class Conversation:
    """Counts and repair of one conversation whose rows come in order."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last_turn = None
        self.before: str | None = None
        self.last_place: tuple | None = None
        self.repair = Repair()

    def read(self, turn: int | None, role: str, text: str, later: bool, place: tuple) -> None:
        """``later``: the same role and text stood further up; ``place`` is equal only for equal rows of one turn."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        if self.before is not None and (self.before, initial) not in _ILLEGAL:
            self.illegal += 1
        self.before = initial
        shown = text.rstrip(_SPACE)
        blank = not shown
        duplicate = not blank and (later or place == self.last_place)
        truncated = not blank and not duplicate and shown[-1] not in ".!?"
        self.last_place = place
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.repair.read(role, text, blank or duplicate, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.end())


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: (conv_id, turn, role, text, role_before, text_before, copy) of the rows that are left, texts as digests in ``text_before``.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    ``[.!?]`` away, 3 repeats it, 4 makes its role user.
    """
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = spaced
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.col("role").alias("role_before"), F.md5(F.col("text")).alias("text_before"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


_RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_PLACE = ("turn", "role_before", "text_before", "copy")


def _same_text() -> Column:
    """A digest of role and text; the length of the role keeps the two apart."""
    return F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, the counts, cost, audit and hash of every conversation of ``conversations``, repaired from ``rows``.

    ``rows`` has the columns that ``damage`` returns; a conversation without rows costs nothing.
    """
    marked = rows.withColumn("same", _same_text())
    place = F.struct(*(F.col(c) for c in _PLACE))
    # Only what occurs more than once is sent back to the rows; nulls sort first in a struct as in the order below.
    repeated = marked.groupBy("conv_id", "same").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    names = repeated.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    joined = marked.join(names, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    later = F.coalesce(place > F.col("first"), F.lit(False)).alias("later")
    known = joined.select("conv_id", *_PLACE, "role", "text", later, F.lit(True).alias("there"))
    # One row without a place for each conversation, so that one whose rows are all gone is still listed.
    every = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast(conversations.schema["turn"].dataType).alias("turn"),
        *(F.lit(None).cast("string").alias(c) for c in ("role_before", "text_before")), F.lit(-1).alias("copy"),
        F.lit("").alias("role"), F.lit("").alias("text"), F.lit(False).alias("later"), F.lit(False).alias("there"),
    )
    dealt = known.unionByName(every).repartition("conv_id").sortWithinPartitions("conv_id", "there", *_PLACE)
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *(part.split()[0] for part in _RESULT.split(", "))]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        current: list = []  # the conversation being read: its id and its state

        def packed(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[] for _ in names]
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True))]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "there", *_PLACE, "role", "text", "later")]
            for conv, there, turn, role_before, text_before, copy, role, text, late in zip(*columns, strict=True):
                if not there:
                    if current:
                        done.append((current[0], *current[1].result()))
                    current = [conv, Conversation()]
                else:
                    current[1].read(turn, role, text, late, (turn, role_before, text_before, copy, role, text))
            yield packed(done)
        if current:
            yield packed([(current[0], *current[1].result())])

    return dealt.mapInArrow(run, f"conv_id {kind}, {_RESULT}")


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's rows: every conversation, damaged and repaired."""
    return repair(damage(conversations), conversations)
