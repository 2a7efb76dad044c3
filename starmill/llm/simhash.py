"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared as vertical bit planes.

Two fingerprints that differ in at most r bits agree in all but r of m blocks of bits.  So for each choice of the m - r
blocks that agree, fingerprints are dealt into buckets by the bits of these blocks, and only members of a bucket are
compared.  In a sorted run of buckets, plane b holds bit b of 64 neighbouring fingerprints in one machine word; the
fingerprint and the one s places further on are compared by combining each plane with itself shifted by s.  Carry-save
counters hold the distances of all 64 pairs, and a word is abandoned once all its pairs are over the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, merged, stored, text_slices

SEED = 42
#: Rows of whole buckets that are compared together.
RUN = 1 << 16
#: Buckets with more fingerprints are cut into tiles of about half as many, compared two by two.
BUCKET = 1 << 13
#: Expected fingerprints in a bucket above which one more block is cut.
CROWDED = 64
#: Links that are held before they are merged.
PENDING = 1 << 20


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """A hash of each ``width``-word shingle of a text, A-Z lower-cased; of all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    ends = ends[min(width, len(words)) - 1 :].tolist()
    return [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends, strict=False)]


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of the ``width``-word shingles of a text, A-Z lower-cased; 0 without a word."""
    hashes = shingle_hashes(text, width)
    if not hashes:
        return 0
    ones = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = 2 * ones.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            values = np.array([fingerprint(t.as_py(), width) for t in part.column("text")], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "fp": values.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, "doc_id long, fp long")


def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 rows of machine words: bit i of row b is bit b of fingerprint i.  One spare word of zeros follows."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return _words(bits)


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, axis=-1, bitorder="little")
    spare = -packed.shape[-1] % 8 + 8
    return np.concatenate([packed, np.zeros((*packed.shape[:-1], spare), np.uint8)], axis=-1).view("<u8")


def near_at(planes: np.ndarray, valid: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Positions i, of those set in ``valid``, whose fingerprint may be within ``radius`` of the one at i + shift.

    The counters hold distances up to the next power of two, so some that are just over the radius may remain.
    """
    wanted = _words(valid)
    at = np.nonzero(wanted)[0]
    alive = wanted[at]
    word, bit = divmod(shift, 64)
    right, left = np.uint64(bit), np.uint64(64 - bit)
    counters = [np.zeros(len(at), np.uint64) for _ in range(radius.bit_length())]
    for b in range(0, 64, 2):
        differ = []
        for plane in planes[b : b + 2]:
            moved = plane[at + word] >> right
            if bit:
                moved |= plane[at + word + 1] << left
            differ.append(plane[at] ^ moved)
        x, y = differ
        both = counters[0] ^ x
        carry = (counters[0] & x) | (both & y)
        counters[0] = both ^ y
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        alive &= ~carry
        if b % 8 == 6:
            stay = np.nonzero(alive)[0]
            if not len(stay):
                return stay
            if len(stay) < len(at):
                at, alive = at[stay], alive[stay]
                counters = [c[stay] for c in counters]
    ones = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, offset = np.nonzero(ones)
    return at[row] * 64 + offset


def linked_rows(buckets: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by bucket: the first row that each is connected with by links inside buckets."""
    n = len(fps)
    planes, root = planes_of(fps), np.arange(n)
    starts = np.nonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))[0]
    longest = int(np.diff(np.concatenate([starts, [n]])).max())
    planes = np.concatenate([planes, np.zeros((64, longest // 64 + 2), np.uint64)], axis=1)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merge() -> np.ndarray:
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        return merged(root, i, j)

    for shift in range(1, longest):
        valid = buckets[:-shift] == buckets[shift:]
        i = near_at(planes, valid, shift, radius)
        i = i[root[i] != root[i + shift]]
        i = i[np.bitwise_count(fps[i] ^ fps[i + shift]) <= radius]
        if len(i):
            held.append((i, i + shift))
            if sum(len(a) for a, _ in held) > PENDING:
                root = merge()
    return merge() if held else root


def _links(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(rows: list[np.ndarray]) -> pa.RecordBatch:
            buckets, fps, nodes = rows
            root = linked_rows(buckets, fps.view(np.uint64), radius)
            moved = np.nonzero(root != np.arange(len(root)))[0]
            return pa.RecordBatch.from_pydict({"a": nodes[moved], "b": nodes[root[moved]]})

        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
            # The last bucket may go on in the next batch.
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole and len(held[0]) >= RUN:
                yield edges([h[:whole] for h in held])
                held = [h[whole:] for h in held]
        if len(held[0]):
            yield edges(held)

    return link


def block_masks(distinct: int, radius: int) -> list[int]:
    """Masks of the bits that must agree, one for each way to choose them; finer ones for more fingerprints."""
    blocks = radius + 1
    while blocks < 2 * radius + 2 and distinct > CROWDED << (64 * (blocks - radius) // blocks):
        blocks += 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    bits = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(bits, blocks - radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect nodes (node, fp) just as the pairs within ``radius`` do."""
    masks = block_masks(nodes.count(), radius)
    keys = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(masks)])
    entries = nodes.select("fp", "node", F.explode(keys).alias("bucket"))
    crowded = stored(
        entries.groupBy("bucket")
        .agg(F.count("*").alias("members"))
        .where(F.col("members") > BUCKET)
        .select("bucket", F.ceil(F.col("members") / (BUCKET // 2)).cast("long").alias("tiles"))
    )
    tile = F.pmod(F.xxhash64("node"), "tiles")
    partner = F.expr("filter(sequence(0L, tiles - 1), t -> t <> tile)")
    pair = F.xxhash64("bucket", F.least("tile", "partner"), F.greatest("tile", "partner"))
    dealt = (
        entries.join(crowded, "bucket", "left")
        .withColumn("tile", tile)
        .withColumn("partner", F.explode(F.coalesce(partner, F.array(F.lit(0).cast("long")))))
        .select(F.when(F.col("tiles").isNull(), F.col("bucket")).otherwise(pair).alias("bucket"), "fp", "node")
    )
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``fingerprint`` in hex, ``component_id`` and ``kept``.

    Texts link if their fingerprints differ in at most ``radius`` bits; equal fingerprints are one node.  Texts that are
    null or have no word all have fingerprint zero and link like others.  Texts shorter than a shingle are one shingle.
    Rows that repeat a doc_id share its group, and stay together if that id is kept.  A null doc_id links with nothing
    and is kept.  Other columns are ignored; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, width))
    nodes = stored(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    classes = components(links(nodes, radius))
    groups = nodes.join(classes, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return prints.join(groups, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
