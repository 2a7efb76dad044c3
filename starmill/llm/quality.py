"""Quality scores by positive-unlabelled learning.

Only trusted positives and unlabelled web text are compared; what is bad is learnt from their difference.  With the share
p of good documents, estimated from the labels, the risk is p R+(good as good) + max(0, R-(web as bad) - p R-(good as
bad)): the second part estimates what bad documents cost without having any, and is kept from falling below zero, where
a flexible model would only be fitting its sample (the non-negative unbiased estimator).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_slices

#: Shares of the 256 byte values, and measures of the whole text.
FEATURES = 256 + 9


def features(text: str | None) -> np.ndarray:
    """What a whole text looks like: its bytes, the shape of its words and lines, and how much of it repeats."""
    out = np.zeros(FEATURES)
    data = (text or "").encode()
    if not data:
        return out
    out[:256] = np.sqrt(np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data))
    words = data.split()
    lines = data.split(b"\n")
    n = max(1, len(words))
    counts = Counter(words)
    most = counts.most_common(1)[0][1] if counts else 0
    out[256:] = (
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log(max(1, len(data) - len(words)) / n),
        len(counts) / n,
        most / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)),
        sum(map(bytes.isalpha, words)) / n,
    )
    return out


def _features(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(-1, FEATURES)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def raw(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh((x - self.mean) / self.scale @ self.weights[0] + self.weights[1])
        return hidden @ self.weights[2] + self.weights[3], hidden

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.raw(x)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def train(
    good: np.ndarray, web: np.ndarray, prior: float, hidden: int = 16, steps: int = 800, batch: int = 512, seed: int = 5
) -> Model | None:
    """Minimise the non-negative risk with the sigmoid loss.  None if there is no positive or no unlabelled row."""
    if not len(good) or not len(web):
        return None
    rng = np.random.default_rng(seed)
    both = np.concatenate([good, web])
    model = Model(
        both.mean(axis=0),
        both.std(axis=0) + 1e-2 * (np.arange(FEATURES) < 256) + 1e-6,
        [
            rng.standard_normal((FEATURES, hidden)) * FEATURES**-0.5,
            np.zeros(hidden),
            rng.standard_normal(hidden) * hidden**-0.5,
            np.zeros(()),
        ],
    )
    first, second = ([np.zeros_like(w) for w in model.weights] for _ in range(2))
    for step in range(1, steps + 1):
        x = np.concatenate([g[rng.integers(0, len(g), batch)] for g in (good, web)])
        z, h = model.raw(x)
        s, (p, u) = _sigmoid(z), (slice(0, batch), slice(batch, None))
        # The loss of calling a row bad is s, that of calling it good 1 - s; their slopes are slope and -slope.
        slope = s * (1 - s)
        below = s[u].mean() - prior * s[p].mean()
        d = np.empty_like(z)
        if below >= 0:
            d[p], d[u] = -2 * prior * slope[p] / batch, slope[u] / batch
        else:
            d[p], d[u] = prior * slope[p] / batch, -slope[u] / batch
        dh = d[:, None] * model.weights[2] * (1 - h * h)
        inputs = (x - model.mean) / model.scale
        grads = [inputs.T @ dh + 5e-3 * model.weights[0], dh.sum(axis=0), h.T @ d + 5e-3 * model.weights[2], d.sum()]
        rate = 0.01 * (1 - step / (steps + 1))
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            ahead = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            model.weights[k] = model.weights[k] - rate * ahead
    return model


def for_training(doc_id: Column) -> Column:
    """Rows of the training part: CRC-32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != 0


def _chosen(ids: DataFrame, most: int) -> DataFrame:
    """About ``most`` ids, chosen by a hash, twice as many at the very most."""
    n = ids.count()
    place = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return ids.where(place < most / max(n, 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * most)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        rows = list(_features(part.column("text").to_pylist()))
        yield pa.RecordBatch.from_pydict(
            {"good": part.column("good"), "features": pa.array(rows, pa.list_(pa.float64()))}
        )


def fit(docs: DataFrame, labels: DataFrame, most: int = 3000) -> Model | None:
    """Learn from about ``most`` trusted positives and as many unlabelled texts of the training part.

    A document is trusted if all its labels are 1; it is unlabelled if it has none.  The prior is the share of good ones
    among all labelled documents of the training part.  Only ids are joined; the texts of the chosen ids, at most
    ``4 * most``, are measured on the executors, and what reaches the driver is ``FEATURES`` numbers for each.
    """
    marked = labels.where(for_training(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marked = stored(marked.groupBy("doc_id").agg(F.min("quality").alias("quality")))
    share = marked.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    if not share:
        return None
    rows = docs.where(for_training(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id")
    trusted = _chosen(rows.join(marked.where("quality = 1"), "doc_id", "left_semi"), most)
    unlabelled = _chosen(rows.join(marked, "doc_id", "left_anti"), most)
    if unlabelled.isEmpty():
        unlabelled = _chosen(rows, most)
    sides = [ids.select("doc_id", F.lit(good).alias("good")) for ids, good in ((trusted, True), (unlabelled, False))]
    picked = stored(sides[0].unionByName(sides[1]))
    texts = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "good", "text")
    found = texts.select("good", "text").mapInArrow(_measured, "good boolean, features array<double>").toArrow()
    x = np.array(found["features"].to_pylist()).reshape(-1, FEATURES)
    good = np.array(found["good"].to_pylist(), bool)
    order = np.lexsort(x.T)
    return train(x[order][good[order]], x[order][~good[order]], float(share))


def _scored(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            x = _features(part.column("text").to_pylist())
            scores = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": scores})

    return score


def classify(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of each whole text of ``docs`` (doc_id, text); the higher, the likelier it is good.

    Null and empty texts have all features zero and a score like others; without a model every score is one half.  Only
    the text is read.  Repeated rows and null ids each get their row; other columns are ignored.
    """
    scores = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scored(model), "doc_id long, score double")
    return scores.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
