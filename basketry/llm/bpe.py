"""Byte-level BPE by tree concatenation: parts of a text are encoded apart and joined at their seams.

A text longer than ``LEAF`` characters is halved until its parts are short; the parts are encoded on
their own, those of texts longer than ``SEGMENT`` characters as rows of their own in parallel tasks.
Two neighbours are joined by encoding a window around the seam again: the last tokens of the left
side and the first ones of the right side. Where the new tokens begin with the left window's first
token and end with the right window's last one, both sides agree and everything outside the window
stays; else the window doubles, at most up to both whole sides.

Why that is exact: a sequence of tokens is what merging gives if and only if each two neighbours are
what merging gives for them alone, and outside the window every pair is as it was on its side. The
cut into words depends on the characters to the right of a place only by the class of the next ones,
so it too is the same beyond an agreeing token. Strings of special tokens are cut out first, since a
seam inside one could not be seen from its neighbours.

Defined cases: a null text is encoded as an empty one (no ids); rows of one id are encoded each for
itself, equal ones too; a table without rows gives no rows; columns that are not named are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from basketry.session import materialize, spread

LEAF = 4096  # characters encoded in one go
SEGMENT = 32768  # characters of a row of its own; a power of two, as tokens of equal characters are long by powers of two
WINDOW = 4  # tokens on each side of a seam that are tried first
#: From this size on, texts are merged by the library's own heap: the rank table's merge is quadratic in an unsplit run.
HEAP = 4 * LEAF

#: How a byte-level vocabulary cuts text before merging (fixed by its pre-tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Coder:
    """Encoder and decoder of one vocabulary file of the tokenizers library (byte-level BPE, no normalizer)."""

    def __init__(self, path: str, leaf: int = LEAF) -> None:
        import tiktoken

        self.leaf, self.path = leaf, path
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        cutter, model, added = layout["pre_tokenizer"] or {}, layout["model"], layout["added_tokens"]
        if layout["normalizer"] or model["type"] != "BPE" or cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"]:
            raise ValueError(f"{path} is no byte-level BPE vocabulary without a normalizer")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has special tokens that reach beyond their string")
        # The file writes each byte as a character: printable Latin-1 as itself, the others from U+0100 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        ranks = {token: i for i, token in self.bytes_of.items()}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None

    @cached_property
    def library(self):
        """The library's own tokenizer, loaded where a text is long enough to need it."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def plain(self, text: str) -> list[int]:
        """The ids of a text without special tokens, in one go."""
        if len(text) < HEAP:
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def parts(self, text: str) -> list[str]:
        """The text between special tokens and the tokens themselves, in turn."""
        return self.cut.split(text) if self.cut else [text]

    def text_of(self, ids: Sequence[int]) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])

    def halves(self, text: str) -> list[int]:
        """The ids of a text without special tokens: both halves on their own, then their seam."""
        if len(text) <= self.leaf:
            return self.plain(text)
        middle = self.leaf
        while 2 * middle < len(text):
            middle *= 2
        return self.join(self.halves(text[:middle]), self.halves(text[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of two texts in one, from those of each."""
        if not left or not right:
            return left or right
        size = WINDOW
        while True:
            first, last = self._window(left, right, size)
            a, b = left[first:], right[:last]
            new = self.plain(self.text_of(a + b).decode())
            if (first == 0 or new[0] == a[0]) and (last == len(right) or new[-1] == b[-1]):
                return left[:first] + new + right[last:]
            size *= 2

    def _window(self, left: list[int], right: list[int], size: int) -> tuple[int, int]:
        """So many tokens on each side, and further ones up to whole characters."""
        first, last = max(0, len(left) - size), min(len(right), size)
        while first > 0 and _inside(self.bytes_of[left[first]]):
            first -= 1
        while last < len(right) and _inside(self.bytes_of[right[last]]):
            last += 1
        return first, last

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.parts(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                ids += self.halves(part)
        return ids

    def join_all(self, sides: list[list[int]]) -> list[int]:
        """The ids of neighbouring texts in one, pair by pair."""
        while len(sides) > 1:
            sides = [self.join(sides[i], sides[i + 1]) if i + 1 < len(sides) else sides[i] for i in range(0, len(sides), 2)]
        return sides[0] if sides else []

    def decode(self, ids: Sequence[int]) -> str:
        """As the library's decode, special tokens included: ids it does not know are left out."""
        table = self.bytes_of
        return b"".join([table.get(i, b"") for i in ids]).decode("utf-8", errors="replace")


def _inside(token: bytes) -> bool:
    """Whether a token begins within a character."""
    return token[0] & 0xC0 == 0x80


_coders: dict[tuple[str, int], Coder] = {}


def coder(path: str, leaf: int = LEAF) -> Coder:
    """The vocabulary's coder, made once in each Python worker."""
    if (path, leaf) not in _coders:
        _coders[path, leaf] = Coder(path, leaf)
    return _coders[path, leaf]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _unpacked(blob: bytes) -> list[int]:
    return np.frombuffer(blob, "<u4").tolist()


#: What is made of a text's ids: the values of the result's columns.
Finish = Callable[[Coder, list[int]], tuple]
_SIDE = "seg int, special int, word string"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


def _segments(texts: DataFrame, tokenizer: str, leaf: int, segment: int, finish: Finish, result: str) -> DataFrame:
    """(row, id, result, seg, special, word): the result of a text up to ``segment`` characters, else its segments without one."""
    schema = f"row long, id {texts.schema['id'].dataType.simpleString()}, {result}, {_SIDE}"
    target, width = _arrow(schema), len(_arrow(result))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(tokenizer, leaf)
        nothing = (None,) * width
        for batch in batches:
            out: list[tuple] = []  # the row of the batch, then the values after its id
            for r, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                if len(text) <= segment:
                    out.append((r, *finish(made, made.encode(text)), None, None, None))
                    continue
                sides: list[tuple] = []  # segments are not joined over a special token
                for part in made.parts(text):
                    if part in made.special:
                        sides.append((made.special[part], None))
                    else:
                        sides += [(None, part[at : at + segment]) for at in range(0, len(part), segment)]
                out += [(r, *nothing, seg, *side) for seg, side in enumerate(sides)]
            at, *columns = zip(*out, strict=True) if out else [()] * (width + 4)
            taken = pa.array(at, pa.int64())
            arrays = [batch.column("row").take(taken), batch.column("id").take(taken)]
            arrays += [pa.array(c, f.type) for c, f in zip(columns, list(target)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return texts.mapInArrow(run, schema)


def _join_segments(long: DataFrame, tokenizer: str, leaf: int, finish: Finish, result: str) -> DataFrame:
    """(id, result) of the texts that were cut: segments are encoded where they are dealt to, then joined text by text."""
    kind = long.schema["id"].dataType.simpleString()
    target = _arrow(f"id {kind}, {result}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(tokenizer, leaf)
        for batch in batches:
            blobs = [None if w is None else _packed(made.halves(w)) for w in batch.column("word").to_pylist()]
            arrays = [batch.column("row"), batch.column("id"), batch.column("seg"), batch.column("special"), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "seg", "special", "ids"])

    def join(table: pa.Table) -> pa.Table:
        made = coder(tokenizer, leaf)
        table = table.sort_by("seg")
        ids: list[int] = []
        sides: list[list[int]] = []
        for special, blob in zip(table["special"].to_pylist(), table["ids"].to_pylist(), strict=True):
            if special is None:
                sides.append(_unpacked(blob))
            else:
                ids += [*made.join_all(sides), special]
                sides = []
        ids += made.join_all(sides)
        values = [pa.array([v], f.type) for v, f in zip(finish(made, ids), list(target)[1:], strict=True)]
        return pa.table([table["id"].slice(0, 1), *values], schema=target)

    dealt = long.select("row", "id", "seg", "special", "word").repartition("row", "seg")
    sides = dealt.mapInArrow(encode, f"row long, id {kind}, seg int, special int, ids binary")
    return sides.groupBy("row").applyInArrow(join, f"id {kind}, {result}")


def over_ids(
    docs: DataFrame, tokenizer: str, finish: Finish, result: str, id_column: str = "doc_id", text_column: str = "text",
    leaf: int = LEAF, segment: int = SEGMENT,
) -> DataFrame:
    """(id, result) with what ``finish`` makes of the ids of every whole text, one row for each row of ``docs``.

    The texts are read once: the first pass is written with the results of short texts and the
    segments of long ones. A row number written with them holds the segments of one text together;
    one group has the ids of one text, which was one row before.
    """
    texts = spread(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    first = materialize(_segments(numbered, tokenizer, leaf, segment, finish, result), "bpe-segments")
    short = first.where("seg IS NULL").drop("row", "seg", "special", "word")
    joined = _join_segments(first.where("seg IS NOT NULL"), tokenizer, leaf, finish, result)
    return short.unionByName(joined).withColumnRenamed("id", id_column)


def encode(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", leaf: int = LEAF, segment: int = SEGMENT
) -> DataFrame:
    """(id, ids): the ids of every whole text as little-endian unsigned 32-bit numbers."""
    return over_ids(docs, tokenizer, lambda made, ids: (_packed(ids),), "ids binary", id_column, text_column, leaf, segment)


def decode(encoded: DataFrame, tokenizer: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, text) of (id, ids) rows; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(tokenizer)
        for batch in batches:
            texts = [None if blob is None else made.decode(_unpacked(blob)) for blob in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_column, "text"])

    kind = encoded.schema[id_column].dataType.simpleString()
    return encoded.select(id_column, ids_column).mapInArrow(run, f"`{id_column}` {kind}, text string")


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, from its ids and what they decode to."""

    def hashes(made: Coder, ids: list[int]) -> tuple:
        return len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(made.decode(ids).encode()).hexdigest()

    return over_ids(docs, tokenizer, hashes, "n_tokens long, ids_sha256 string, decoded_sha256 string")
