"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in NumPy.

Features of a text are its byte 3-grams and 4-grams, hashed into ``BUCKETS`` rows;
ASCII letters are lower-cased, other ASCII becomes a space. A document is the mean
of its rows of the embedding, its class scores are linear in that mean. Since both steps are
linear, prediction uses one table of class scores per bucket.

Training takes at most ``PER_LANGUAGE`` labelled rows of a language (those with the
smallest hash of doc_id and text, equal rows once) whose text is at most ``MAX_TRAINING_BYTES``. A fifth of them
sets the temperature and the rejection score, the score that 99 of 100 correctly
classified calibration texts reach. Prediction reads whole texts.

Null text, and text without a letter, is ``und`` with score 0. Ties go to the
first language in order. Without any training row every text is ``und``. Extra
columns pass through; one that is called like a result column is replaced.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import append_columns
from basketry.llm.words import LOWER, text_chunks

BUCKETS = 1 << 18
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.6
PER_LANGUAGE = 1500
MAX_TRAINING_BYTES = 1 << 15
UNKNOWN = "und"

_TO_FEATURE = LOWER.copy()
_TO_FEATURE[:0x80][~((LOWER[:0x80] >= 0x61) & (LOWER[:0x80] <= 0x7A))] = 0x20


def features(data: np.ndarray) -> np.ndarray:
    """Bucket of the 3-gram and the 4-gram that begin at each byte but the last three; shape (n - 3, 2)."""
    b = _TO_FEATURE[data].astype(np.uint32)
    three = (b[:-3] << np.uint32(16)) | (b[1:-2] << np.uint32(8)) | b[2:-1]
    four = (three << np.uint32(8)) | b[3:]
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    return np.stack([(three * np.uint32(2654435761)) >> shift, (four * np.uint32(2246822519) + np.uint32(0x9E3779B1)) >> shift], 1)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class scores of each document; the mean over the n-grams that lie inside it."""
        lengths = np.maximum(np.diff(offsets) - 3, 0)
        total = np.zeros((len(lengths), len(self.languages)))
        if len(data) > 3 and lengths.any():
            each = self.table[features(data)].sum(1, dtype=np.float32)
            inside = np.repeat(offsets[1:], np.diff(offsets))[: len(each)] > np.arange(len(each)) + 3
            each[~inside] = 0
            full = np.flatnonzero(lengths)
            total[full] = np.add.reduceat(each, np.minimum(offsets[full], len(each) - 1), dtype=np.float64)
        return total / np.maximum(2 * lengths, 1)[:, None] + self.bias

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        z = scores / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" " + text.encode() + b"   ", np.uint8)
    ids, counts = np.unique(features(data), return_counts=True)
    return ids, counts / counts.sum()


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """A model of the texts, every fifth of which is kept for calibration."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    docs = [_document(t) for t in texts]
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    weights += rng.normal(0, 0.1, weights.shape)
    bias = np.zeros(len(languages), np.float32)
    fit = [i for i in range(len(docs)) if i % 5 or len(docs) < 10]
    held = [i for i in range(len(docs)) if i % 5 == 0]
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, share = docs[i]
            mean = share @ embedding[ids]
            z = mean @ weights + bias
            wrong = np.exp(z - z.max())
            wrong /= wrong.sum()
            wrong[target[i]] -= 1
            back = weights @ wrong
            weights -= rate * np.outer(mean, wrong)
            bias -= rate * wrong * 0.1
            embedding[ids] -= (rate * len(ids) ** 0.5 * share)[:, None] * back
    table = (embedding @ weights).astype(np.float32)
    scores = np.array([docs[i][1] @ table[docs[i][0]] + bias for i in held])
    truth = target[held]
    model = Model(languages, table, bias, 1.0, 0.0)

    def loss(t: float) -> float:
        model.temperature = t
        return float(-np.log(np.maximum(model.probabilities(scores)[np.arange(len(truth)), truth], 1e-12)).mean())

    model.temperature = min((2.0**k for k in np.arange(-4, 4.01, 0.25)), key=loss)
    p = model.probabilities(scores)
    right = p.argmax(1) == truth
    model.reject_below = float(np.quantile(p.max(1)[right], 0.01)) if right.any() else 0.0
    return model


def _pack(model: Model) -> bytes:
    out = io.BytesIO()
    np.savez(out, languages=np.array(model.languages, dtype=str), table=model.table, bias=model.bias, rest=np.array([model.temperature, model.reject_below]))
    return out.getvalue()


def _unpack(blob: bytes) -> Model:
    x = np.load(io.BytesIO(blob))
    return Model([str(v) for v in x["languages"]], x["table"], x["bias"], float(x["rest"][0]), float(x["rest"][1]))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, max_bytes: int = MAX_TRAINING_BYTES) -> Model | None:
    """A model of the rows (doc_id, text, lang), trained in one task on the bounded sample; None without rows."""
    rows = labelled.select(F.xxhash64("doc_id", "text").alias("h"), "text", "lang").where(
        F.col("lang").isNotNull() & (F.octet_length("text") <= max_bytes) & F.col("text").rlike(r"\p{L}")
    )
    # Hashes are spread evenly: a language's share of them holds a little over the rows asked for, and only these are ranked.
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    limits = counts.select("lang", (F.lit((1.3 * per_language + 200) * 2.0**63) / F.col("n")).alias("below"))
    near = rows.join(F.broadcast(limits), "lang").where(F.shiftrightunsigned("h", 1) < F.col("below"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = near.dropDuplicates(["lang", "h"]).withColumn("nth", nth).where(F.col("nth") <= per_language).select("h", "text", "lang")

    def run(batches):
        got = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["h"], r["text"], r["lang"]))
        if got:
            model = train([r["text"] for r in got], [r["lang"] for r in got])
            yield pa.RecordBatch.from_arrays([pa.array([_pack(model)], pa.binary())], names=["model"])

    made = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return _unpack(made[0]["model"]) if made else None


def predict(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred string, score double (0 to 1) and rejected boolean (score below the calibrated one)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]

    def compute(texts: pa.Array) -> list[pa.Array]:
        names: list[str] = []
        best: list[float] = []
        m = sent.value
        for a, b, data, offsets in text_chunks(texts):
            if m is None:
                names += [UNKNOWN] * (b - a)
                best += [0.0] * (b - a)
                continue
            p = m.probabilities(m.scores(data, offsets))
            lower = LOWER[data]
            ascii_letters = np.concatenate([[0], np.cumsum((lower >= 0x61) & (lower <= 0x7A))])
            lettered = np.diff(ascii_letters[offsets]) > 0
            for i in np.flatnonzero(~lettered).tolist():
                lettered[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
            top = p.argmax(1)
            names += [m.languages[k] if ok else UNKNOWN for k, ok in zip(top.tolist(), lettered.tolist(), strict=True)]
            best += np.where(lettered, p.max(1), 0.0).tolist()
        low = m.reject_below if m is not None else 0.0
        return [pa.array(names, pa.string()), pa.array(best, pa.float64()), pa.array([s < low for s in best], pa.bool_())]

    return append_columns(docs, text_column, fields, compute)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from rows whose crc32(doc_id) mod 4 is not 2."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = fit(docs.where(~held))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
