"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the distinct hashes of its words, word pairs and pairs
with one word between, in 2^20 places. FTRL-proximal keeps per place a sum of
gradients and of their squares (the per-coordinate rate); its L1 term leaves
most weights at exactly zero, so the model is a short list of (place, weight).

Fitting uses a bounded sample of the labelled rows whose crc32(doc_id) mod 3
is not 1: at most about ``SAMPLE_ROWS`` rows and ``SAMPLE_CHARS`` characters,
chosen by a hash of the doc_id, in one task. Three quarters of it fit the
weights; on the last quarter the bias is set so that toxic and other rows, each
class weighing the same, balance. Weights are collected and broadcast: at most
2^20 of them, 12 MB. Scoring is one pass over the whole texts without shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import write_once

DIM_LOG2 = 20
SAMPLE_ROWS = 12_000
SAMPLE_CHARS = 100_000_000
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.1
EPOCHS = 10
# A feature takes part if so many documents of the sample have it.
MIN_DOCS = 3
# Every so-manyth row of the sample sets the bias; MARGIN lowers it a little,
# in favour of clean documents.
CALIBRATE = 4
MARGIN = 0.5
WORD_CACHE = 300_000
# The bias is a place of its own, after the hashed ones.
_BIAS = 1 << DIM_LOG2
_WORDS = re.compile(r"\w+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(64 - DIM_LOG2)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word) | 1
        return h


_HASHES = _WordHashes()


def features(text: str | None) -> np.ndarray:
    """Places of a text's words, word pairs and skip-pairs; may repeat."""
    words = _WORDS.findall((text or "").lower())
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    one = (h * _M1) >> _SHIFT
    two = ((h[:-1] * _M2 + h[1:]) * _M1) >> _SHIFT
    skip = ((h[:-2] * _M1 + h[2:]) * _M2) >> _SHIFT
    return np.concatenate([one, two, skip]).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """True for the rows kept from fitting: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, x))))


def fit_ftrl(texts: list[str | None], labels: list[int]) -> np.ndarray:
    """Weights (2^20 places and the bias) learned from the rows in their order."""
    found = [np.unique(features(t)).astype(np.int32) for t in texts]
    fitted = [i for i in range(len(found)) if i % CALIBRATE or len(found) < CALIBRATE]
    docs = np.zeros(_BIAS, np.int32)
    for i in fitted:
        docs[found[i]] += 1
    often = docs >= MIN_DOCS
    z, n = np.zeros(_BIAS + 1), np.zeros(_BIAS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1 * (at != _BIAS), 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    rows = [(np.append(found[i][often[found[i]]], _BIAS), labels[i]) for i in fitted]
    for _ in range(EPOCHS):
        for at, y in rows:
            w = weights(at)
            g = _sigmoid(float(w.sum())) - y
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(_BIAS + 1))
    kept = range(0, len(found), CALIBRATE)
    w[_BIAS] += _offset(np.array([w[found[i]].sum() + w[_BIAS] for i in kept]), np.array([labels[i] for i in kept]))
    return w


def _offset(x: np.ndarray, y: np.ndarray) -> float:
    """Shift of the log-odds ``x`` at which both classes, weighing the same,
    balance; 0 if a class is missing."""
    if not len(x) or y.min() == y.max():
        return 0.0
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    low, high = -30.0, 30.0
    for _ in range(60):
        mid = (low + high) / 2
        p = 1 / (1 + np.exp(-np.clip(x + mid, -35, 35)))
        low, high = (low, mid) if (share * (p - y)).sum() > 0 else (mid, high)
    return low - MARGIN


def _fit_sample(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "toxic"])
    w = fit_ftrl(rows["text"].tolist(), rows["toxic"].tolist())
    at = np.flatnonzero(w)
    return pd.DataFrame({"place": at, "weight": w[at]})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> np.ndarray:
    """Weights learned from the labelled rows that aren't held out.

    Rows whose label is neither 0 nor 1 or whose doc_id is null are left out;
    repeated label rows of a document count once, toxic if any says so. Without
    any labelled row all weights are zero and every score is 0.5.
    """
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = write_once(known.filter(~held_out(F.col("doc_id"))), "toxic-labels")
    sizes = docs.select("doc_id", F.length("text").alias("chars")).join(known, "doc_id")
    rows, chars = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("chars"), F.lit(0))).first()
    share = min(1.0, sample_rows / max(1, rows), sample_chars / max(1, chars))
    order = F.xxhash64("doc_id")
    chosen = known.withColumn("order", order).filter(F.pmod(order, F.lit(1_000_000)) < F.lit(math.ceil(1_000_000 * share)))
    sample = docs.select("doc_id", "text").join(write_once(chosen, "toxic-sample"), "doc_id").withColumn("model", F.lit(0))
    model = sample.groupBy("model").applyInPandas(_fit_sample, "place long, weight double")
    w = np.zeros(_BIAS + 1)
    for row in model.toLocalIterator():
        w[row["place"]] = row["weight"]
    return w


def _scored(weights: object, text_at: int, passed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        known = w != 0
        for batch in batches:
            scores = []
            for text in batch.column(text_at):
                at = features(text.as_py())
                at = np.unique(at[known[at]])
                scores.append(_sigmoid(float(w[at].sum() + w[_BIAS])))
            columns = [*batch.columns[:passed], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:passed], "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, columns: list[str], to: str = "score") -> DataFrame:
    """The asked ``columns`` of ``docs``, then ``to``, the score (0 to 1, higher: likelier
    toxic), for every row of ``docs``.

    Only the text is read for the score. Defined cases: a null or empty text
    scores the bias alone; repeated rows score alike; an empty table gives an
    empty result.
    """
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    # Own names through the Python step, so that no column clashes with the score.
    names = [f"c{i}" for i in range(len(columns))]
    sent = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], *([] if "text" in columns else [F.col("text")]))
    text_at = columns.index("text") if "text" in columns else len(columns)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in sent.schema.fields[: len(names)]] + ["score double"])
    out = sent.mapInArrow(_scored(weights, text_at, len(names)), schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(columns, names)], F.col("score").alias(to))


def toxic_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``."""
    scored = score(docs, labels, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score at least ``threshold``."""
    columns = docs.columns
    scored = score(docs, labels, columns, "__toxicity")
    return scored.filter(F.col("__toxicity") < threshold).select(*[F.col(f"`{c}`") for c in columns])
