"""Quality classifier: hashed word n-gram logistic regression, fitted with FTRL-proximal updates.

A text is split into word tokens (runs of word characters and runs of one other sign, A-Z
lower-cased, letters kept as they are); its unigrams and bigrams are hashed into 2^bits weights.
The score is the sigmoid of a sparse dot product: the mean weight of the n-grams times `SCALE`,
plus a bias. Shape n-grams (a token equal to the one before, a capitalised token) are hashed as
tokens of their own, so that repetition is seen without any hand-set threshold.

Fitting: at most `max_rows` labels (a documented bound; they are taken in the order of a hash of
their id, so the choice does not depend on the layout) are broadcast to the documents, so that only
the chosen rows' texts move; those go through one task in batches, in hash order. That task keeps
2^bits weights and nothing that grows with the corpus. Scoring is narrow.

Defined results: null and empty texts have no n-grams and score sigmoid(bias); a null label or a
null id in the labels is not learnt from; documents with a null id count as training rows; several
labels for one id are all learnt from; with no labelled rows every score is 0.5; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provena.llm.common import LOWER, UPPER, annotate, crc_bucket, mix64, strings

TOKEN = re.compile(r"\w+|([^\w\s])\1*")
FOLD = str.maketrans(UPPER, LOWER)
BITS = 18
SCALE = 24.0
MAX_ROWS = 12_000
CACHE = 300_000


class Features:
    """Hashed n-grams of texts; remembers the hashes of words that it has met."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        words = [m[0] for m in TOKEN.finditer(text)]
        if not words:
            return np.zeros(0, np.int64)
        known, hashes = self.known, []
        if len(known) > CACHE:
            known.clear()
        for word in words:
            h = known.get(word)
            if h is None:
                h = known[word] = xxhash.xxh64_intdigest(word.translate(FOLD)) ^ word[0].isupper()
            hashes.append(h)
        one = np.array(hashes, np.uint64)
        shape = np.empty(len(one), np.uint64)
        shape[0] = 3
        shape[1:] = (one[1:] == one[:-1]).astype(np.uint64)
        two = mix64(one[1:] * np.uint64(0x9E3779B97F4A7C15) + one[:-1])
        return (np.concatenate([mix64(one), two, mix64(shape + np.uint64(0xABCDEF))]) & self.mask).astype(np.int64)


class Ftrl:
    """Follow the regularised leader, per-coordinate, for the logistic loss."""

    def __init__(self, bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def at(self, index: np.ndarray) -> np.ndarray:
        z = self.z[index]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[index])) / self.alpha + self.l2))

    def learn(self, features: np.ndarray, label: float) -> None:
        index, times = np.unique(features, return_counts=True)
        index = np.append(index, len(self.z) - 1)
        x = np.append(times * (SCALE / max(1, len(features))), 1.0)
        w = self.at(index)
        g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        sigma = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += g - sigma * w
        self.n[index] += g * g

    def weights(self) -> np.ndarray:
        return self.at(np.arange(len(self.z))).astype(np.float32)


def score(features: np.ndarray, weights: np.ndarray) -> float:
    total = float(weights[-1]) + (SCALE * float(weights[features].mean()) if len(features) else 0.0)
    return float(1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))))


def fit(labelled: DataFrame, bits: int = BITS, epochs: int = 2) -> np.ndarray:
    """Weights (2^bits and a bias, a size fixed by `bits`) from rows (text, label, order): a bounded number of them, they meet in one task."""
    chosen = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("double").alias("label"), "order").repartition(1).sortWithinPartitions("order", "label")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, model, kept = Features(bits), Ftrl(bits), []
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found = features.of(text).astype(np.uint32)
                model.learn(found, label)
                if epochs > 1:
                    kept.append((found, label))
        for epoch in range(1, epochs):
            for k in np.random.default_rng(epoch).permutation(len(kept)):
                model.learn(*kept[k])
        yield pd.DataFrame({"weights": [model.weights().tobytes()]})

    held = chosen.select("text", "label").mapInPandas(run, "weights binary").collect()
    return np.frombuffer(held[0]["weights"], np.float32) if held else np.zeros((1 << bits) + 1, np.float32)


def apply(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """id, score, predicted for each row; narrow."""
    shared = df.sparkSession.sparkContext.broadcast(weights)
    bits = int(len(weights) - 1).bit_length() - 1

    def worker():
        features, w = Features(bits), shared.value
        return lambda texts: [[score(features.of(t), w) for t in strings(texts)]]

    scored = annotate(df, {"id": F.col(f"`{id_col}`")}, F.col(f"`{text_col}`"), worker, "score double")
    return scored.select(F.col("id").alias(id_col), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """id, held_out, score, predicted: learns from labelled rows whose crc32 remainder is not 0, scores every row."""
    held_out = F.coalesce(crc_bucket(F.col(id_col)) == 0, F.lit(False))
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("label")).filter("label_id is not null and label is not null").filter(crc_bucket(F.col("label_id")) != 0)
    sample = known.withColumn("order", F.xxhash64(F.col("label_id"), F.lit(17))).orderBy("order", "label").limit(max_rows)
    learnt = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col("id") == F.col("label_id"))  # max_rows rows
    weights = fit(learnt)
    scored = apply(docs, weights, id_col, text_col)
    return scored.select(id_col, held_out.alias("held_out"), "score", "predicted")
