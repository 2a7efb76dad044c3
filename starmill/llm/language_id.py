"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes from both ends; at each byte the two states together give a distribution over the
languages.  A document's probabilities are the mean over all its bytes.  States begin anew with each word (and after
``SEGMENT`` bytes of a longer one), so equal words have equal labels wherever they stand: a task labels a word once and
counts it as often as it occurs.  Training is back-propagation through time in numpy on a bounded sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

#: Bytes of a word that are read in one go.
SEGMENT = 24
#: Words whose labels a task remembers before it forgets all and starts again; about 50 MB.
REMEMBERED = 250_000
#: Words that go through the network together; their states stay in the processor's cache.
TOGETHER = 2048
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass
class Model:
    """Weights of both directions: a row of gate inputs per byte value, a matrix of states, and the output layer."""

    languages: list[str]
    inputs: list[np.ndarray]
    states: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Model:
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            languages,
            [draw(256, 3 * hidden, scale=0.3) for _ in range(2)],
            [draw(hidden, 3 * hidden, scale=hidden**-0.5) for _ in range(2)],
            draw(2 * hidden, len(languages), scale=hidden**-0.5),
            np.zeros(len(languages), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.out, self.bias]

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (words, bytes, languages) for words of equal length given as rows of bytes."""
        states = np.concatenate([_run(self, 0, data)[0], _run(self, 1, data)[0]], axis=2)
        return _softmax(states @ self.out + self.bias).transpose(1, 0, 2)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def _run(model: Model, side: int, data: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States (bytes, words, hidden) of one direction, and what the way back needs if ``keep``."""
    table, matrix = model.inputs[side], model.states[side]
    hidden = matrix.shape[0]
    steps = range(data.shape[1]) if side == 0 else range(data.shape[1] - 1, -1, -1)
    states = np.empty((data.shape[1], len(data), hidden), np.float32)
    h, trace = np.zeros((len(data), hidden), np.float32), []
    for t in steps:
        x, u = table[data[:, t]], h @ matrix
        gates = _sigmoid(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(x[:, 2 * hidden :] + r * u[:, 2 * hidden :])
        if keep:
            trace.append((t, h, z, r, n, u[:, 2 * hidden :]))
        h = n + z * (h - n)
        states[t] = h
    return states, trace


def _back(model: Model, side: int, data: np.ndarray, trace: list, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the byte table and the state matrix, from the gradients of the states."""
    matrix = model.states[side]
    hidden = matrix.shape[0]
    d_table, d_matrix = np.zeros_like(model.inputs[side]), np.zeros_like(matrix)
    dh = np.zeros((len(data), hidden), np.float32)
    for t, before, z, r, n, u in reversed(trace):
        dh = dh + given[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        dr = dn * u * r * (1 - r)
        du = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(d_table, data[:, t], np.concatenate([dz, dr, dn], axis=1))
        d_matrix += before.T @ du
        dh = dh * z + du @ matrix.T
    return d_table, d_matrix


def gradients(model: Model, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes of words of equal length, and its gradients in the order of ``weights``."""
    runs = [_run(model, side, data, True) for side in (0, 1)]
    states = np.concatenate([run[0] for run in runs], axis=2)
    chances = _softmax(states @ model.out + model.bias)
    rows = np.arange(len(data))
    loss = -np.log(chances[:, rows, labels] + 1e-9).mean()
    error = chances
    error[:, rows, labels] -= 1
    error /= data.size
    given = error @ model.out.T
    hidden = given.shape[2] // 2
    sides = [_back(model, s, data, runs[s][1], given[:, :, s * hidden : (s + 1) * hidden]) for s in (0, 1)]
    flat = error.reshape(-1, error.shape[2])
    out = states.reshape(-1, states.shape[2]).T @ flat
    return float(loss), [sides[0][0], sides[1][0], sides[0][1], sides[1][1], out, flat.sum(axis=0)]


def segments(word: bytes) -> list[bytes]:
    return [word[i : i + SEGMENT] for i in range(0, len(word), SEGMENT)]


def train(
    texts: list[tuple[str, str]], hidden: int = 16, steps: int = 1000, batch: int = 512, seed: int = 7
) -> Model | None:
    """Fit a network to (text, language) pairs; the languages weigh alike.  None without any pair."""
    languages = sorted({language for _, language in texts})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    model = Model.new(languages, hidden, rng)
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    pools: list[list[bytes]] = [[] for _ in languages]
    for text, language in texts:
        pools[languages.index(language)] += [s for w in text.encode().split() for s in segments(w)]
    fewest = max(1, min(batch * steps // 4 // len(languages), max(map(len, pools), default=1)))
    for label, pool in enumerate(pools):
        for k in rng.integers(0, len(pool), fewest) if pool else []:
            by_length.setdefault(len(pool[k]), []).append((pool[k], label))
    if not by_length:
        return model
    lengths = sorted(by_length)
    chance = np.array([len(by_length[n]) for n in lengths], float)
    rows = {n: np.frombuffer(b"".join(w for w, _ in by_length[n]), np.uint8).reshape(-1, n) for n in lengths}
    labels = {n: np.array([label for _, label in by_length[n]]) for n in lengths}
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    for step in range(1, steps + 1):
        n = lengths[rng.choice(len(lengths), p=chance / chance.sum())]
        pick = rng.integers(0, len(rows[n]), min(batch, 4 * len(rows[n])))
        _, grads = gradients(model, rows[n][pick], labels[n][pick])
        rate = 0.02 * (1 - step / (steps + 1))
        for w, g, a, b in zip(model.weights(), grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


def position_labels(model: Model, words: list[bytes]) -> dict[bytes, np.ndarray]:
    """The number of the language of each byte, for each different word."""
    parts: dict[int, list[tuple[bytes, int]]] = {}
    found = {word: np.empty(len(word), np.int64) for word in words}
    for word in found:
        for at, part in enumerate(segments(word)):
            parts.setdefault(len(part), []).append((word, at * SEGMENT))
    for n, places in parts.items():
        for k in range(0, len(places), TOGETHER):
            some = places[k : k + TOGETHER]
            data = np.frombuffer(b"".join(word[at : at + n] for word, at in some), np.uint8).reshape(-1, n)
            for (word, at), labels in zip(some, model.positions(data).argmax(axis=2), strict=True):
                found[word][at : at + n] = labels
    return found


class Labeller:
    """Sums of position probabilities of words, each word labelled once while it is remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, int] = {}
        self.sums = np.empty((0, len(model.languages)))

    def of(self, words: list[bytes]) -> np.ndarray:
        """One row for each word, in order."""
        if len(self.known) > REMEMBERED:
            self.known, self.sums = {}, np.empty((0, len(self.model.languages)))
        new = list(set(words).difference(self.known))
        if new:
            self.sums = np.concatenate([self.sums, self._labelled(new)])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        return self.sums[list(map(self.known.__getitem__, words))]

    def _labelled(self, words: list[bytes]) -> np.ndarray:
        sums = np.zeros((len(words), len(self.model.languages)))
        by_length: dict[int, list[tuple[bytes, int]]] = {}
        for k, word in enumerate(words):
            for part in segments(word) if len(word) > SEGMENT else (word,):
                by_length.setdefault(len(part), []).append((part, k))
        for n, parts in by_length.items():
            data = np.frombuffer(b"".join(p for p, _ in parts), np.uint8).reshape(-1, n)
            owner = np.array([k for _, k in parts])
            for at in range(0, len(data), TOGETHER):
                found = self.model.positions(data[at : at + TOGETHER]).sum(axis=1)
                np.add.at(sums, owner[at : at + TOGETHER], found)
        return sums


def _judged(labeller: Labeller | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    if labeller:
        words = [t.encode().split() if t and _LETTER.search(t) else [] for t in texts]
        rows = labeller.of([w for doc in words for w in doc])
        ends = np.cumsum([len(doc) for doc in words])
        total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0)])
        for k, doc in enumerate(words):
            if doc:
                pooled = total[ends[k]] - total[ends[k] - len(doc)]
                best = int(pooled.argmax())
                names[k], scores[k] = labeller.model.languages[best], min(1.0, pooled[best] / pooled.sum())
    return names, scores


def _predicted(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model) if model is not None else None
        for part in text_slices(batches):
            names, scores = _judged(labeller, part.column("text").to_pylist())
            ids = part.column("doc_id")
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "lang_pred": pa.array(names, pa.string()), "score": scores})

    return predict


#: A text of which the network gives no language this share has no language.  Low, so that short clean texts stay.
LEAST = 0.3


def language(model: Model | None, least: float = 0.0):
    """A function of a text column: the language of each text, ``und`` where there is none or its score is below ``least``."""

    @F.arrow_udf("string")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model) if model is not None else None
        for column in texts:
            whole = pa.RecordBatch.from_arrays([column], ["text"])
            parts = text_slices(iter([whole]))
            judged = [_judged(labeller, p.column("text").to_pylist()) for p in parts]
            found = [name if score >= least else "und" for part in judged for name, score in zip(*part, strict=True)]
            yield pa.array(found, pa.string())

    return of.asNondeterministic()  # so that a filter on the result does not run the network again


def for_training(doc_id: Column) -> Column:
    """Rows of the training part: CRC-32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 != 1


def sample(docs: DataFrame, per_language: int = 150, chars: int = 3000, most: int = 256) -> list[tuple[str, str]]:
    """At most about ``per_language`` texts of each of the ``most`` commonest languages of the training part.

    Texts are chosen by a hash of the id, about evenly; of a longer one a stretch of ``chars`` at a hashed place is read.
    These three numbers bound what reaches the driver.
    """
    rows = docs.where(for_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    shares = {r["lang"]: min(1.0, per_language / r["n"]) for r in counts.collect()}
    if not shares:
        return []
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    start = F.greatest(F.length("text") - chars, F.lit(0)) * F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1024)) / 1024
    chosen = rows.where(place < share).select(
        "doc_id", F.substring("text", start.cast("int") + 1, F.lit(chars)).alias("part"), "lang"
    )
    found = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "part").limit(2 * per_language * len(shares)).collect()
    return [(r["part"], r["lang"]) for r in found]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score): the language of each whole text of ``docs`` (doc_id, text) and its pooled probability.

    Null texts, texts without a letter, and all texts if there is no model are ``und`` with score 0.  Only the text is
    read for a prediction.  Repeated rows and null ids each get their row; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _predicted(model), "doc_id long, lang_pred string, score double"
    )


def fit(docs: DataFrame, **bounds: int) -> Model | None:
    """A network trained on a bounded sample of the training part of ``docs`` (doc_id, text, lang)."""
    return train(sample(docs, **bounds))


def _spanned(model: Model):
    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            known = position_labels(model, list({w for t in texts for w in t.split()}))
            rows = []
            for text in texts:
                spans: list[dict] = []
                for word in _WORD.finditer(text):
                    labels = known[word[0]]
                    cuts = [0, *(np.nonzero(np.diff(labels))[0] + 1).tolist(), len(labels)]
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        name, start, end = model.languages[labels[a]], word.start() + a, word.start() + b
                        if spans and spans[-1]["lang"] == name:
                            spans[-1]["end"] = end
                        else:
                            spans.append({"start": start, "end": end, "lang": name})
                rows.append(spans)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "spans": pa.array(rows, _SPANS)})

    return span


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def language_spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans): the runs of bytes of each text that have the same language; white space joins its neighbours.

    Null and empty texts have no spans.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _spanned(model), "doc_id long, spans array<struct<start: long, end: long, lang: string>>"
    )


def with_language(docs: DataFrame, model: Model | None, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose language can be told, with the predicted language as ``lang``; other columns unchanged.

    Null and empty texts and those without a letter go, and those whose score is below ``least``.  Without a model all texts
    with a letter stay and keep their ``lang``.  Repeated rows and null ids are judged like others; a very long text
    is read whole.
    """
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = docs.withColumn("lang", language(model, least)(F.col("text")))
    return told.where(F.col("lang") != "und")
