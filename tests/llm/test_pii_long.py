"""Pseudonyms of very long values."""

import random
import time

import pytest

from basketry.llm import pii

KEY = b"k"


@pytest.mark.parametrize("size", [1, 127, 128, 129, 224, 300, 4096, 100_000])
@pytest.mark.parametrize("hexadecimal", [True, False])
def test_round_trip(size, hexadecimal):
    rng = random.Random(size)
    value = "".join(rng.choice("0123456789abcdef" if hexadecimal else "aB3.-_z9") for _ in range(size))
    made = pii.permute_characters(value, "t", KEY, hexadecimal)
    assert len(made) == size and (size < 5 or made != value)
    assert pii.permute_characters(made, "t", KEY, hexadecimal, inverse=True) == value
    if not hexadecimal:  # kinds and case stay in place
        assert [(c.isdigit(), c.isupper(), c.islower()) for c in made] == [(c.isdigit(), c.isupper(), c.islower()) for c in value]


def test_every_character_counts():
    """A change at either end changes chunks at both."""
    value = "".join(random.Random(1).choice("0123456789abcdef") for _ in range(1000))
    made = pii.permute_characters(value, "t", KEY, True)
    for other in ("0" + value[1:] if value[0] != "0" else "1" + value[1:], value[:-1] + ("0" if value[-1] != "0" else "1")):
        changed = pii.permute_characters(other, "t", KEY, True)
        assert changed[:128] != made[:128] and changed[-128:] != made[-128:]


def test_long_values_in_text():
    rng = random.Random(2)
    dump = "".join(rng.choice("0123456789abcdef") for _ in range(1_000_000))
    mailbox = "a" + "".join(rng.choice("abcxyz019._") for _ in range(5000)) + "1@example.org"
    begin = time.perf_counter()
    text, kinds = pii.pseudonymize(f"key {dump} of {mailbox} and {dump}", KEY)
    assert time.perf_counter() - begin < 60
    assert kinds == ["secret", "email", "secret"]
    words = text.split(" ")
    assert words[1] == words[5] and len(words[1]) == len(dump) and words[1] != dump  # equal values stay linked
    assert pii.permute_characters(words[1], "secret", KEY, True, inverse=True) == dump
    assert pii._remembered.cache_info().currsize == 0 or all(len(w) > pii.CHUNK for w in (dump, mailbox))


def test_mask_and_its_key(spark):
    df = spark.createDataFrame([(1, "mail me.you@example.com"), (2, "f0" * 400), (3, None), (4, "")], "doc_id long, text string")
    plain = {r.doc_id: r.text for r in pii.mask(df).collect()}
    spark.conf.set(pii.KEY_SETTING, b"another".hex())
    try:
        other = {r.doc_id: r.text for r in pii.mask(df).collect()}
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert plain[1] != other[1] and plain[2] != other[2] and plain[3] is other[3] is None and plain[4] == other[4] == ""
    assert other[2] == pii.pseudonymize("f0" * 400, b"another")[0]
