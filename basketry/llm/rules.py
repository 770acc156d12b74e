"""Quality rules with thresholds taken from the data: mergeable quantile sketches per language and source.

Measures of a text are built-in expressions only. Base rules are fixed; what else
is rejected depends on the document's own group. Of each (lang, source) and
measure a sketch is kept: counts of buckets with six significant bits (relative
error 1/32). Sketches merge by adding counts, so a hot source is folded on the
map side, and languages and the whole are merged from the groups. A bound is the
outer fence q75 + 3 (q75 - q25) with the whole of the bucket it lies in, as quantiles are
lower edges of buckets, and no tighter than a fixed floor, so that a clean group rejects nothing. Groups of fewer than ``MIN_GROUP`` documents use their
language's sketch, small languages that of all documents.

Null or empty text has no words and fails the base rules. Null lang or source is
a group of its own. Repeated documents count and are judged each. An empty table
gives no rows. Extra columns pass through ``filter_documents``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import fresh
from basketry.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
MIN_GROUP = 50
#: Measure: (numerator, denominator, scale, floor of the bound).
UPPER = {
    "symbols": ("n_symbols", "n_words", 1000, 250),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 350),
    "long_words": ("word_chars", "n_words", 100, 1800),
}
#: Two tables beyond this many groups are joined without a broadcast.
BROADCAST_GROUPS = 50_000
SYMBOLS = "#*$%&|<>"
WHITE_SPACE = " \t\n\x0b\f\r"


def _count_of(text: Column, characters: str) -> Column:
    """How often any of the ASCII ``characters`` occurs."""
    left = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)
    return F.octet_length(text) - F.octet_length(left)


def measure(docs: DataFrame, struct: str, text_column: str = "text") -> DataFrame:
    """``docs`` and a struct column of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    names = [fresh(n, [*docs.columns, struct]) for n in ("__words", "__windows", "__sorted", "__again")]
    words, windows, ordered, again = (F.col(n) for n in names)
    text = F.coalesce(F.col(text_column), F.lit(""))
    k = REPEAT_WINDOW
    docs = docs.withColumn(names[0], F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    docs = docs.withColumn(
        names[1],
        F.when(
            F.size(words) >= k,
            F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Only texts with an equal pair of windows are sorted; .h is the window, .i its place.
    docs = docs.withColumn(
        names[2],
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    docs = docs.withColumn(
        names[3],
        F.array_sort(
            F.transform(
                F.filter(
                    ordered,
                    lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        again,
        F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last")),
        lambda acc, x: F.struct((acc["n"] + F.least(F.lit(k), x - acc["last"])).alias("n"), x.alias("last")),
    )["n"]
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.withColumn(
        struct,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            (F.char_length(text) - _count_of(text, WHITE_SPACE)).cast("long").alias("word_chars"),
            _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        ),
    ).drop(*names)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (F.lit(100) * m["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * m["n_words"])


def _value(m: Column, name: str) -> Column:
    """The measure as an integer: scale * numerator / denominator, rounded down."""
    top, under, scale, _ = UPPER[name]
    return F.call_function("div", F.lit(scale).cast("long") * m[top], F.greatest(m[under], F.lit(1)))


def _shift(v: Column) -> Column:
    return F.greatest(F.length(F.bin(v)) - 6, F.lit(0))


def bucket(v: Column) -> Column:
    """``v`` (0 or more) with all but its six highest bits cleared."""
    return F.call_function("shiftleft", F.call_function("shiftright", v, _shift(v)), _shift(v))


def bucket_end(v: Column) -> Column:
    """The largest value in the bucket of ``v``."""
    return bucket(v) + F.call_function("shiftleft", F.lit(1).cast("long"), _shift(v)) - 1


def sketch(measured: DataFrame, m: Column) -> DataFrame:
    """lang, source, measure, bucket, n: the mergeable sketches of documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(k).alias("measure"), bucket(_value(m, k)).alias("bucket")) for k in UPPER])
    return (
        measured.where(~base_failed(m))
        .select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", F.col("v.measure").alias("measure"), F.col("v.bucket").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def bounds(sketches: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source and a column of each measure: the largest value kept."""
    levels = []
    for keys in (["lang", "source"], ["lang"], []):
        merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        by = Window.partitionBy(*keys, "measure")
        ranked = merged.withColumn("seen", F.sum("n").over(by.orderBy("bucket"))).withColumn("all", F.sum("n").over(by))
        quantile = lambda q: F.min(F.when(F.col("seen") * 100 >= F.col("all") * q, F.col("bucket")))
        levels.append(ranked.groupBy(*keys, "measure").agg(quantile(25).alias("low"), quantile(75).alias("high"), F.max("all").alias("all")))
    group, lang, every = levels
    g, l, e = group.alias("g"), lang.alias("l"), every.alias("e")  # noqa: E741
    chosen = (
        g.join(l, F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.measure") == F.col("l.measure")))
        .join(e, F.col("g.measure") == F.col("e.measure"))
        .select(
            "g.lang",
            "g.source",
            "g.measure",
            *[
                F.when(F.col("g.all") >= min_group, F.col(f"g.{q}"))
                .when(F.col("l.all") >= min_group, F.col(f"l.{q}"))
                .otherwise(F.col(f"e.{q}"))
                .alias(q)
                for q in ("low", "high")
            ],
        )
    )
    fence = F.col("high") + F.lit(3) * (F.col("high") - F.col("low"))
    return chosen.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == k, F.greatest(bucket_end(fence), F.lit(floor).cast("long")))).alias(k) for k, (_, _, _, floor) in UPPER.items()]
    )


def _judged(measured: DataFrame, m: Column, limits: DataFrame, verdict: str) -> DataFrame:
    limits = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.struct(*UPPER).alias("__bounds"))
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    on = F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source"))
    # A group without bounds has no document that passes the base rules.
    within = reduce(lambda a, b: a & b, [_value(m, k) <= F.col("__bounds")[k] for k in UPPER])
    kept = F.coalesce(~base_failed(m) & within, F.lit(False))
    return measured.join(limits, on, "left").withColumn(verdict, kept).drop("__lang", "__source", "__bounds")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    rows = measure(docs.select("doc_id", "lang", "source", "text"), "m").select("doc_id", "lang", "source", "m")
    measured = materialize(rows, "rules")  # without the texts
    m = F.col("m")
    limits = materialize(bounds(materialize(sketch(measured, m), "sketch")), "bounds")
    return _judged(measured, m, limits, "kept").select(
        "doc_id", *[m[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(m).alias("base_failed"), "kept",
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, columns as they were. Rows are written once with their measures and never shuffled.

    (The measures are read back: inlined into several filters they would be evaluated over and over.)
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "lang", "source", "text")
    measured = materialize(measure(rows, "m").select("row", "lang", "source", "m"), "rules")
    limits = materialize(bounds(materialize(sketch(measured, F.col("m")), "sketch")), "bounds")
    return _judged(measured, F.col("m"), limits, "kept").where("kept").select("row.*")
