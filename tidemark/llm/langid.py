"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed code point n-grams, so its
bucket frequencies are all a model needs. Executors count them over whole texts;
embeddings and softmax are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows, a part of which calibrates the scores (one
temperature) and the score below which a prediction is to be rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, id_remainder, shares, table

BUCKETS = 2048
SIZES = (1, 2, 3, 4)
DIM = 16
#: Rows of each language that the model is fitted to, about.
ROWS_PER_LANGUAGE = 800
#: At most this many rows in all come to the driver, of BUCKETS 4-byte frequencies each.
MOST_ROWS = 6000
#: Share of accepted predictions that shall be right on the calibration rows.
PRECISION = 0.99
UNKNOWN = "und"
_PIECE = 1 << 20
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263], dtype=np.uint32)
_LETTER = regex.compile(r"\p{L}")


def frequencies(texts: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Relative frequencies of hashed n-grams of the lower-cased text; all that is no letter counts as one space."""
    out = np.zeros((len(texts), buckets), dtype=np.float32)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    pieces = [(row, text[a : a + _PIECE + SIZES[-1] - 1]) for row, text in enumerate(texts) for a in range(0, len(text), _PIECE)]
    start = 0
    while start < len(pieces):
        end, held = start, 0
        while end < len(pieces) and (end == start or (held < 1 << 20 and end - start < 256)):
            held += len(pieces[end][1])
            end += 1
        group = [text.lower() for _, text in pieces[start:end]]
        # A space on both sides marks the edges of a text like those of a word.
        codes = np.frombuffer((" " + "  ".join(group) + " ").encode("utf-32-le", "replace"), dtype=np.uint32).copy()
        codes[(codes < 97) | ((codes > 122) & (codes < 0xAA)) | ((codes >= 0x2000) & (codes < 0x2C00)) | ((codes >= 0x3000) & (codes < 0x3040))] = 32
        lengths = np.array([len(t) + 2 for t in group])
        owner = np.repeat(np.arange(len(group), dtype=np.int64) * buckets, lengths)
        counts = np.zeros(len(group) * buckets, dtype=np.int64)
        for n in SIZES:
            if len(codes) < n:
                continue
            mixed = np.zeros(len(codes) - n + 1, dtype=np.uint32)
            for k in range(n):
                mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * _MULTIPLIERS[(k + n) % 4]
                mixed ^= mixed >> np.uint32(15)
            inside = owner[: len(mixed)] == owner[n - 1 :]
            # A run of spaces says nothing.
            inside &= (codes[: len(mixed)] != 32) | (codes[n - 1 :] != 32)
            counts += np.bincount((owner[: len(mixed)] + (mixed >> shift).astype(np.int64))[inside], minlength=len(counts))
        np.add.at(out, [row for row, _ in pieces[start:end]], counts.reshape(len(group), buckets).astype(np.float32))
        start = end
    total = out.sum(axis=1, keepdims=True)
    return np.divide(out, total, out=out, where=total > 0)


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.embedding) @ self.weights + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.logits(x) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, labels: list[str], dim: int = DIM, epochs: int = 30, rate: float = 0.5, batch: int = 32, seed: int = 1) -> Model:
    """Stochastic gradient descent on the cross entropy; a fifth of the rows calibrates."""
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = (order[: len(y) // 5], order[len(y) // 5 :]) if len(y) >= 50 else (order, order)
    buckets = x.shape[1]
    # Frequencies are about 1 / buckets; unit scale for the embeddings' inputs.
    scale = np.float32(np.sqrt(buckets))
    model = Model(languages, rng.normal(0, 0.3, (buckets, dim)).astype(np.float32), np.zeros((dim, len(languages)), np.float32), np.zeros(len(languages), np.float32))
    # Rare languages count as much as common ones.
    seen = np.bincount(y, minlength=len(languages))
    weight = (len(y) / (len(languages) * np.maximum(seen, 1)))[y].astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        shuffled = rng.permutation(used)
        for a in range(0, len(shuffled), batch):
            rows = shuffled[a : a + batch]
            xb = x[rows] * scale
            hidden = xb @ model.embedding
            p = softmax(hidden @ model.weights + model.bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weight[rows, None] / len(rows)
            back = p @ model.weights.T
            model.weights -= step * (hidden.T @ p)
            model.bias -= step * p.sum(axis=0)
            model.embedding -= step * (xb.T @ back)
    model.embedding *= scale
    logits = model.logits(x[held])
    temperatures = np.geomspace(0.25, 20, 60)
    losses = [-np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in temperatures]
    model.temperature = float(temperatures[int(np.argmin(losses))])
    p = softmax(logits / model.temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == y[held]
    falling = np.argsort(-best, kind="stable")
    precise = np.cumsum(right[falling]) >= PRECISION * np.arange(1, len(falling) + 1)
    model.reject_below = float(best[falling][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return model


def count_column(docs: DataFrame, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` without its text, with the bytes of its n-gram frequencies."""

    def make() -> Callable[[list], dict[str, list]]:
        return lambda texts: {"_x": [row.tobytes() for row in frequencies([t or "" for t in texts], buckets)]}

    return annotate(docs, make, [T.StructField("_x", T.BinaryType())], text_col, drop=(text_col,))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """A model of the rows that have text and a language; None if there is no such row."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    chosen = shares(rows.select("_id", "_lang"), F.col("_lang"), rows_per_language, F.col("_id"))
    chosen = chosen.groupBy("_id").agg(F.min("_lang").alias("_only")).orderBy(F.xxhash64("_id"), "_id").limit(MOST_ROWS)
    # At most MOST_ROWS ids.
    sample = rows.join(F.broadcast(chosen), "_id", "left_semi").select("_id", "_lang", "_text")
    found = count_column(sample, "_text").orderBy(F.xxhash64("_id"), "_id").limit(MOST_ROWS).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["_id"] is None, r["_id"] or 0, r["_lang"], r["_x"]))
    return train(np.stack([np.frombuffer(r["_x"], dtype=np.float32) for r in found]), [r["_lang"] for r in found])


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", drop: tuple[str, ...] = ("text",)) -> DataFrame:
    """``docs`` with lang_pred, score and rejected.

    A null text or one without a letter is ``und`` with score 0; rejected is true
    there and where the score is below the calibrated bound. Without a model
    every text is ``und``. Same-named input columns are replaced.
    """

    def make() -> Callable[[list], dict[str, list]]:
        def apply(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts), "rejected": [True] * len(texts)}
            rows = [i for i, t in enumerate(texts) if model is not None and t and _LETTER.search(t)]
            if rows:
                p = model.scores(frequencies([texts[i] for i in rows], model.embedding.shape[0]))
                for i, k, s in zip(rows, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    out["lang_pred"][i], out["score"][i], out["rejected"][i] = model.languages[k], s, s < model.reject_below
            return out

        return apply

    return annotate(docs, make, FIELDS, text_col, drop)


def identify_languages(docs: DataFrame, learn_from: Column, id_col: str = "doc_id") -> DataFrame:
    """Fit to the rows of ``learn_from`` and predict all rows; only their texts are read for that."""
    return predict(docs, fit(docs.filter(learn_from), id_col))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", id_remainder("doc_id", 4) == 2)
    return identify_languages(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score", "rejected")
