"""Personal data as format-preserving pseudonyms.

Validated values are permuted within their format by a keyed Feistel network with
cycle walking, so equal values get equal pseudonyms in every document and different
ones stay different:

    email     letters and digits of the mailbox and of the host but its last label
    card      13 to 19 digits with a valid Luhn digit, which stays valid; in one piece, in the groups that cards are
              printed in, or a whole run of groups between the same blanks or hyphens
    phone     +cc or national numbers of 8 to 15 digits; the country code stays, punctuation doesn't count
    ssn       ddd-dd-dddd with area, group and serial in use
    ipv4      four octets up to 255
    date      calendar dates from 1900 to 2099, yyyy-mm-dd or dd/mm/yyyy (mm/dd/yyyy if only that is valid)
    secret    32 hexadecimal digits or more

Letters keep their case and values are compared in lower case. What fails its
validation stays as it is. No value is looked up anywhere, so nothing is shuffled.

Null text stays null, empty text empty. Repeated rows get the same text. Extra
columns pass through. The key is a parameter; without it pseudonyms can be undone.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import append_columns

ROUNDS = 8
#: For tests and checks; a deployment passes its own, or names it in hexadecimal digits by this setting (its name keeps it out of logs).
DEMO_KEY = b"basketry demo key"
KEY_SETTING = "spark.basketry.pii.secret"


def configured_key(spark: SparkSession) -> bytes:
    named = spark.conf.get(KEY_SETTING, None)
    return bytes.fromhex(named) if named else DEMO_KEY


def permute(value: int, size: int, key: bytes, tweak: bytes, inverse: bool = False) -> int:
    """A keyed bijection of range(size), by a Feistel network over two halves and cycle walking."""
    if size < 2:
        return value
    side = isqrt(size - 1) + 1
    width = (side.bit_length() + 7) // 8

    def mixed(n: int, half: int) -> int:
        seed = tweak + bytes([n]) + half.to_bytes(width, "big")
        return int.from_bytes(blake2b(seed, key=key, digest_size=width + 8).digest(), "big")

    while True:
        left, right = divmod(value, side)
        if inverse:
            for n in reversed(range(ROUNDS)):
                left, right = (right - mixed(n, left)) % side, left
        else:
            for n in range(ROUNDS):
                left, right = right, (left + mixed(n, right)) % side
        value = left * side + right
        if value < size:
            return value


_ALPHABETS = {"d": "0123456789", "l": "abcdefghijklmnopqrstuvwxyz", "x": "0123456789abcdef"}


#: Longer values are permuted in chunks of so many characters, which keeps the numbers small and the work linear.
CHUNK = 128


def permute_characters(value: str, kind: str, key: bytes, hexadecimal: bool = False, inverse: bool = False) -> str:
    """``value`` with its digits and ASCII letters permuted together, each within its alphabet; the rest and the case stay.

    A value longer than ``CHUNK`` is permuted chunk by chunk, forwards and then backwards. Each
    chunk's permutation depends on all chunks before it in that direction, so a change anywhere
    changes every chunk.
    """
    upper = hexadecimal and value.upper() == value
    if len(value) <= CHUNK:
        return _permute_chunk(value, kind.encode(), key, hexadecimal, upper, inverse)
    chunks = [value[at : at + CHUNK] for at in range(0, len(value), CHUNK)]
    for forwards in (False, True) if inverse else (True, False):
        seen = blake2b(f"{kind}:{len(value)}:{forwards}".encode(), digest_size=32)
        made = chunks.copy()
        for i in range(len(chunks)) if forwards else reversed(range(len(chunks))):
            made[i] = _permute_chunk(chunks[i], seen.digest(), key, hexadecimal, upper, inverse)
            # Forwards what stood there before permuting counts, backwards what stands there after it: both are known when undoing.
            seen.update((chunks[i] if forwards != inverse else made[i]).lower().encode())
        chunks = made
    return "".join(chunks)


def _permute_chunk(value: str, kind: bytes, key: bytes, hexadecimal: bool, upper: bool, inverse: bool) -> str:
    lower = value.lower()
    sets = []
    for c in lower:
        if hexadecimal and c in _ALPHABETS["x"]:
            sets.append(_ALPHABETS["x"])
        else:
            sets.append(next((a for a in (_ALPHABETS["d"], _ALPHABETS["l"]) if c in a), ""))
    number, size = 0, 1
    for c, a in zip(lower, sets, strict=True):
        if a:
            number, size = number * len(a) + a.index(c), size * len(a)
    tweak = kind + f":{''.join('.xld'[(len(a) == 16) + 2 * (len(a) == 26) + 3 * (len(a) == 10)] for a in sets)}:".encode()
    number = permute(number, size, key, tweak, inverse)
    out = []
    for c, a in zip(reversed(value), reversed(sets), strict=True):
        if a:
            number, k = divmod(number, len(a))
            new = a[k]
            out.append(new.upper() if upper or c.isupper() else new)
        else:
            out.append(c)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def _number(value: str, key: bytes) -> tuple[str, str]:
    digits = re.sub(r"\D", "", value)
    if luhn_digit(digits[:-1]) == digits[-1]:
        body = permute_characters(digits[:-1], "card", key)
        return "card", _refill(value, body + luhn_digit(body))
    return "", value  # no card: without a valid check digit it is any number


#: Country codes of one and two digits; all others have three, and none begins with another.
_COUNTRY = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


def _phone(value: str, key: bytes) -> tuple[str, str]:
    digits = re.sub(r"\D", "", value)
    if not 8 <= len(digits) <= 15:
        return "", value
    at = _COUNTRY.match(digits).end() if value[0] == "+" else 0
    return "phone", _refill(value, digits[:at] + permute_characters(digits[at:], "phone", key))


def _ssn(value: str, key: bytes) -> tuple[str, str]:
    area, group, serial = map(int, value.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return "", value
    areas = [a for a in range(1, 900) if a != 666]
    n = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    n = permute(n, len(areas) * 99 * 9999, key, b"ssn")
    n, serial = divmod(n, 9999)
    area, group = divmod(n, 99)
    return "ssn", f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(value: str, key: bytes) -> tuple[str, str]:
    octets = [int(x) for x in value.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
        return "", value
    n = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, b"ipv4")
    return "ipv4", ".".join(map(str, n.to_bytes(4, "big")))


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _day(y: str, m: str, d: str) -> int | None:
    try:
        n = datetime.date(int(y), int(m), int(d)).toordinal()
    except ValueError:
        return None
    return n if _FIRST <= n <= _LAST else None


def _date(value: str, key: bytes) -> tuple[str, str]:
    a, b, c = re.split(r"[-/.]", value)
    if len(a) == 4:
        n, form = _day(a, b, c), "%Y-%m-%d"
    else:
        n, form = _day(c, b, a), "%d/%m/%Y"
        if n is None:
            n, form = _day(c, a, b), "%m/%d/%Y"
    if n is None:
        return "", value
    made = datetime.date.fromordinal(_FIRST + permute(n - _FIRST, _LAST - _FIRST + 1, key, b"date"))
    parts = [f"{made.year:04d}" if f == "Y" else f"{made.month if f == 'm' else made.day:02d}" for f in re.findall(r"%(\w)", form)]
    marks = re.findall(r"[-/.]", value)
    return "date", parts[0] + marks[0] + parts[1] + marks[1] + parts[2]


def _email(value: str, key: bytes) -> tuple[str, str]:
    body, _, top = value.rpartition(".")
    return "email", permute_characters(body, "email", key) + "." + top


def _secret(value: str, key: bytes) -> tuple[str, str]:
    return "secret", permute_characters(value, "secret", key, hexadecimal=True)


#: Cards in one piece or as printed: 4-4-4-4, 4-4-4-4-3, 4-4-4-1, 4-6-5 and 4-6-4.
_LONGER = r"(?:(?P=gap)\d{3})?"
_CARD = rf"(?<!\w)(?:\d{{13,19}}|\d{{4}}(?P<gap>[ -])(?:\d{{4}}(?P=gap)\d{{4}}(?P=gap)(?:\d{{4}}{_LONGER}|\d)|\d{{6}}(?P=gap)\d{{4,5}}))(?!\w)"
#: Any other whole run of groups that makes 13 to 19 digits.
_RUN = r"(?<!\w)(?<!\d[ -])(?=\d(?:[ -]?\d){12,18}(?![ -]?\d))\d+(?P<mark_>[ -])\d+(?:(?P=mark_)\d+)*(?!\w)(?![ -]\d)"

KINDS: dict[str, tuple[str, Callable[[str, bytes], tuple[str, str]]]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![A-Za-z0-9])", _email),
    "secret": (r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}(?![A-Za-z0-9])", _secret),
    "date": (r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}(?P<mark>[/.])\d{2}(?P=mark)\d{4})(?![\d/-]|\.\d)", _date),
    "ipv4": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _ipv4),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "phone": (r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}(?!\d|\.\d)|(?<![\w(])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)", _phone),
    "number": (rf"{_CARD}|{_RUN}", _number),
}

_ANY = re.compile("|".join(f"(?P<{k}>{pattern})" for k, (pattern, _) in KINDS.items()))
_CARDS = [re.compile(c) for c in (_CARD.replace(_LONGER, ""), _CARD, _RUN)]  # in the order tried
_GROUP = re.compile(r"\d+")
_HINT = re.compile(r"[0-9@]")


def _pseudonym(pattern: str, value: str, key: bytes) -> tuple[str, str]:
    # Long values are not kept: the cache is bounded by their number only.
    return (_remembered if len(value) <= CHUNK else _computed)(pattern, value, key)


def _computed(pattern: str, value: str, key: bytes) -> tuple[str, str]:
    return KINDS[pattern][1](value, key)


_remembered = lru_cache(maxsize=100_000)(_computed)


def _card(text: str, at: int, key: bytes) -> tuple[str, str, int]:
    """Kind, pseudonym and end of the card that begins at ``at``; without one, the first group of digits as it is."""
    for n, form in enumerate(_CARDS):
        m = form.match(text, at)
        # A printed card inside a run counts more than the whole run.
        if m and (n < 2 or not any(_number(c.group(), key)[0] for f in _CARDS[:2] for c in f.finditer(text, at + 1, m.end()))):
            kind, made = _pseudonym("number", m.group(), key)
            if kind:
                return kind, made, m.end()
    m = _GROUP.match(text, at)
    return "", m.group(), m.end()


def pseudonymize(text: str, key: bytes) -> tuple[str, list[str]]:
    """The text with every valid value replaced, and the kinds of those values in order."""
    kinds: list[str] = []
    if not _HINT.search(text):
        return text, kinds
    parts, at = [], 0
    m = _ANY.search(text)
    while m:
        pattern = next(k for k in KINDS if m.group(k) is not None)
        kind, made, end = _card(text, m.start(), key) if pattern == "number" else (*_pseudonym(pattern, m.group(), key), m.end())
        if kind:
            kinds.append(kind)
        parts += text[at : m.start()], made
        at = end
        m = _ANY.search(text, at)
    return "".join(parts) + text[at:], kinds


def mask(docs: DataFrame, key: bytes | None = None, text_column: str = "text", kinds_column: str | None = None) -> DataFrame:
    """``docs`` with the text replaced; ``kinds_column`` (array<string>) gets the kinds found, null for a null text.

    Without a ``key`` the session's setting counts.
    """
    key = configured_key(docs.sparkSession) if key is None else key
    fields = [T.StructField(text_column, T.StringType())]
    if kinds_column:
        fields.append(T.StructField(kinds_column, T.ArrayType(T.StringType())))

    def compute(texts: pa.Array) -> list[pa.Array]:
        made, found = [], []
        for i in range(len(texts)):
            text = texts[i].as_py()
            new, kinds = (None, None) if text is None else pseudonymize(text, key)
            made.append(new)
            found.append(kinds)
        arrays = [pa.array(made, pa.string())]
        return arrays + ([pa.array(found, pa.list_(pa.string()))] if kinds_column else [])

    masked = append_columns(docs, text_column, fields, compute)
    return masked.select(*[F.col(f"`{c}`") for c in [*docs.columns, *([kinds_column] if kinds_column and kinds_column not in docs.columns else [])]])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, text (masked), n_values and the kinds found, comma-joined."""
    found = mask(docs.select("doc_id", "text"), kinds_column="found")
    return found.select(
        "doc_id", "text", F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_values"), F.array_join("found", ",").alias("kinds")
    )
