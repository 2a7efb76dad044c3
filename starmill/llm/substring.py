"""Substring deduplication with suffix trees that are partitioned by prefix.

What repeats is a window of words that also starts in an earlier document: an internal node of the suffix tree of all
documents, at the depth of a window or deeper.  Only suffixes that can lie below such a node are looked at:

1. Each window picks an anchor, the k words in it whose hash is smallest, so equal windows pick equal anchors.  About one
   word in five starts an anchor.  Anchors that only one document has cannot lie in a repeat.
2. The suffixes at windows with a shared anchor are partitioned by prefix: by the anchor's k words, and by a whole window
   where many suffixes have the same anchor.  Documents of such a window are dealt into parts, so that no partition
   gets all of a passage that very many documents hold; the first document of each part is compared with the others'.
   What a document repeats, anchor or window, is one row of it.
3. Within a partition the suffixes are sorted, which walks the subtree of each prefix depth first: neighbours of equal
   window are the leaves below one deep internal node, its smallest document first.  All later documents lose them.

Edges of the tree are labelled by 64-bit hashes of their words.  Overlapping windows of a document join to its maximal
repeats at the end, when its words are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices

#: Words of an anchor.
ANCHOR = 5
#: Suffixes with one anchor above which the whole window is their prefix.
HEAVY = 1 << 9
#: Bits of a prefix's hash that tell the partitions apart.
PREFIX_BITS = 24
#: Parts into which the documents of a heavy anchor's windows are dealt.
PARTS = 32
#: Set in the prefix of a window that is dealt into parts.
SPLIT = 1 << PREFIX_BITS
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums, so that their order is like chance."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, from the hashes of the words."""
    n = max(0, len(words) - length + 1)
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total = total * _MIX + words[k : k + n]
    return _mixed(total)


class _Texts:
    """The words of some texts in one row, and their anchors.

    ``window`` holds where a window starts that lies in one text, ``anchor`` where its anchor starts.
    """

    def __init__(self, texts: list[str | None], window: int):
        words = [(t or "").encode().split() for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        digest = xxhash.xxh64_intdigest
        self.hashes = np.array([digest(w) for doc in words for w in doc], np.uint64)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        short = _runs(self.hashes, ANCHOR)
        self.short = short
        n = max(0, len(self.hashes) - window + 1)
        inside = np.nonzero(self.owner[:n] == self.owner[window - 1 :][:n])[0]
        self.window, self.anchor = inside, inside
        if len(inside):
            least = np.lib.stride_tricks.sliding_window_view(short, window - ANCHOR + 1)
            picks = np.empty(len(least), np.int64)
            for at in range(0, len(least), 1 << 16):
                picks[at : at + (1 << 16)] = least[at : at + (1 << 16)].argmin(axis=1)
            self.anchor = inside + picks[inside]


def _in_text(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are also different in different texts."""
    return _mixed(hashes + owner.astype(np.uint64) * _MIX)


def _once(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each hash in its text, in order, and whether the text has it again."""
    _, first, times = np.unique(_in_text(hashes, owner), return_index=True, return_counts=True)
    order = np.argsort(first)
    return first[order], times[order] > 1


def _marked(place: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Places in a text; a negative one stands for all places with what is there."""
    return np.where(again, -1 - place, place).astype(np.int32)


def _anchors(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = _Texts(part.column("text").to_pylist(), window)
            at = np.unique(texts.anchor)
            first, again = _once(texts.short[at], texts.owner[at])
            at = at[first]
            owner = texts.owner[at]
            yield pa.RecordBatch.from_pydict(
                {
                    "prefix": texts.short[at].view(np.int64),
                    "doc_id": part.column("doc_id").to_numpy(zero_copy_only=False)[owner],
                    "place": _marked(at - texts.start[owner], again),
                }
            )

    return find


def _suffixes(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = _Texts(part.column("text").to_pylist(), window)
            shared, heavy = np.zeros(len(texts.hashes), bool), np.zeros(len(texts.hashes), bool)
            places = part.column("places")
            flat = places.flatten()
            owner = np.repeat(np.arange(part.num_rows), places.value_lengths().to_numpy())
            place = flat.field("place").to_numpy()
            at = texts.start[owner] + np.where(place < 0, -1 - place, place)
            # Rows that repeat an id may be shorter than the one a place comes from.
            fits = at + ANCHOR <= texts.start[owner + 1]
            at, owner, again = at[fits], owner[fits], place[fits] < 0
            full = flat.field("heavy").to_numpy(zero_copy_only=False)[fits]
            shared[at] = True
            heavy[at] = full
            if again.any():
                here = np.unique(texts.anchor)
                here = here[np.isin(texts.owner[here], owner[again])]
                here_key, key = _in_text(texts.short[here], texts.owner[here]), _in_text(texts.short[at], owner)
                shared[here[np.isin(here_key, key[again])]] = True
                heavy[here[np.isin(here_key, key[again & full])]] = True
            keep = shared[texts.anchor]
            start, anchor = texts.window[keep], texts.anchor[keep]
            deep = _runs(texts.hashes, window)[start] if len(start) else np.empty(0, np.uint64)
            owner = texts.owner[start]
            first, again = _once(deep, owner)
            owner, anchor, deep = owner[first], anchor[first], deep[first]
            place = start[first] - texts.start[owner]
            doc, split = part.column("doc_id").to_numpy(zero_copy_only=False)[owner], heavy[anchor]
            dealt = _mixed(deep + _mixed(doc.astype(np.uint64)) % np.uint64(PARTS) * _MIX)
            prefix = np.where(split, dealt, texts.short[anchor]) >> np.uint64(64 - PREFIX_BITS)
            yield pa.RecordBatch.from_pydict(
                {
                    "prefix": (prefix.astype(np.int32) | np.where(split, SPLIT, 0)).astype(np.int32),
                    "deep": deep.view(np.int64),
                    "doc_id": doc,
                    "place": _marked(place, again),
                }
            )

    return emit


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Suffixes sorted by prefix, window and document: their columns, and the first document below the same node."""
    last: tuple[int, int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        prefix, deep, doc, place = (c.to_numpy() for c in batch.columns)
        new = np.ones(len(doc), bool)
        new[1:] = (prefix[1:] != prefix[:-1]) | (deep[1:] != deep[:-1])
        starts = np.nonzero(new)[0]
        first = np.repeat(doc[starts], np.diff(np.concatenate([starts, [len(doc)]])))
        if last and last[:2] == (prefix[0], deep[0]):
            first[: starts[1] if len(starts) > 1 else len(doc)] = last[2]
        last = (prefix[-1], deep[-1], first[-1])
        yield prefix, deep, doc, place, first


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes whose node has a leaf in an earlier document."""
    for _, _, doc, place, first in _walked(batches):
        later = doc > first
        yield pa.RecordBatch.from_pydict({"doc_id": doc[later], "place": place[later]})


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first leaves of nodes of which other parts lie elsewhere."""
    for prefix, deep, doc, place, first in _walked(batches):
        open_ = (doc == first) & (prefix & SPLIT != 0)
        yield pa.RecordBatch.from_pydict({"deep": deep[open_], "doc_id": doc[open_], "place": place[open_]})


def _everywhere(places: np.ndarray, words: list[bytes], window: int) -> np.ndarray:
    """Where all the windows start that ``places`` stand for."""
    last = len(words) - window
    again = -1 - places[places < 0]
    places = places[(places >= 0) & (places <= last)]
    if len(again):
        deep = _runs(np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64), window)
        places = np.concatenate([places, np.nonzero(np.isin(deep, deep[again[again <= last]]))[0]])
    return places


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts, places = part.column("text").to_pylist(), part.column("places").to_pylist()
            sizes, removed, kept, spans = [], [], [], []
            for text, starts in zip(texts, places, strict=True):
                words = (text or "").encode().split()
                change = np.zeros(len(words) + window + 1, np.int64)
                starts = _everywhere(np.array(starts or [], np.int64), words, window)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
                gone = np.cumsum(change)[: len(words)] > 0
                edges = np.nonzero(np.diff(np.concatenate([[False], gone, [False]])))[0].reshape(-1, 2)
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode())
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n_words": pa.array(sizes, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept_text": pa.array(kept, pa.string()),
                    "removed": pa.array(spans, _SPANS),
                }
            )

    return cut


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
KEPT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start: long, end: long>>"


def drop_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): (doc_id, n_words, n_removed, kept_text, removed).

    Each word is removed that lies in a window of ``window`` words whose words, unchanged, also start in a document with a
    smaller doc_id.  ``removed`` holds the maximal repeats as word numbers, ``kept_text`` the other words joined by one
    space.  Null and empty texts have no words and stay empty; texts shorter than a window lose nothing.  Rows that repeat
    a doc_id are one document and do not make each other smaller; if their texts differ, a place removed in one is removed
    in all.  Rows without doc_id are neither cut nor looked at by others.  Other columns are ignored; an empty table gives
    an empty result.
    """
    if window <= ANCHOR:
        raise ValueError(f"a window has more than {ANCHOR} words")
    texts = docs.select("doc_id", "text")
    if dict(texts.dtypes)["doc_id"] != "bigint":
        texts = texts.withColumn("doc_id", F.col("doc_id").cast("long"))
    named = texts.where("doc_id is not null")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Used twice, below the same exchange: Spark deals the texts out once.
    by_id = named.repartition(partitions, "doc_id")
    same = Window.partitionBy("prefix")
    anchors = named.mapInArrow(_anchors(window), "prefix long, doc_id long, place int")
    met = anchors.select(
        "doc_id",
        "place",
        (F.min("doc_id").over(same) < F.max("doc_id").over(same)).alias("shared"),
        (F.count("*").over(same) > HEAVY).alias("heavy"),
    ).where("shared")
    shared = met.groupBy("doc_id").agg(F.collect_list(F.struct("place", "heavy")).alias("places"))
    suffixes = by_id.join(shared.hint("shuffle_hash"), "doc_id").mapInArrow(
        _suffixes(window), "prefix int, deep long, doc_id long, place int"
    )
    subtrees = suffixes.repartition("prefix").sortWithinPartitions("prefix", "deep", "doc_id")
    # Of a node in parts, each part's first leaf is compared with those of the other parts: at most PARTS rows a node.
    firsts = subtrees.mapInArrow(_firsts, "deep long, doc_id long, place int")
    earliest = F.min("doc_id").over(Window.partitionBy("deep"))
    beaten = firsts.withColumn("later", F.col("doc_id") > earliest).where("later").select("doc_id", "place")
    repeats = subtrees.mapInArrow(_leaves, "doc_id long, place int").unionByName(beaten)
    covered = repeats.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    marked = by_id.join(covered.hint("shuffle_hash"), "doc_id", "left")
    unnamed = texts.where("doc_id is null").withColumn("places", F.array().cast("array<int>"))
    return marked.unionByName(unnamed).mapInArrow(_cut(window), KEPT)
