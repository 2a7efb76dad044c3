"""A trie of conversation prefixes: who shares them, and how many words a cache of prefixes saves.

A prefix is known by a digest of its turns, a polynomial of turn digests modulo a prime, so the digest of a long prefix is
made of those of its stretches.  Turns are dealt by ranges of (conversation, turn) and every task runs its digests on; what
a conversation brings along from the tasks before is added afterwards, so one very long conversation is many tasks' work.

A shard is some conversations, or bands of them, in one task.  It enumerates their distinct prefix digests and gives each
a slot by a minimal perfect hash; a slot counts only if the digest kept there is the one looked up.  Counts are scattered
into flat arrays by slot, and subtree sums run through the array of parent slots from the deepest nodes up.  A node that
several shards hold has a part of its counts and sums in each; one row per shard and node is added up by Spark, so a prefix
of very many conversations is never gathered in one place.  A node's own value enters the sums in one shard only, that of
its smallest member, whose path holds all nodes above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import lookup
from .common import stored, word_count

#: Digests are numbers below this prime; ``BASE`` is any number that is not a small power in its field.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefix").digest()[:15], "big")
WIDTH = 16
ROOT = bytes(WIDTH)
#: Prefixes of a shard, and of one conversation in a shard.
SHARD = 1 << 18
BAND = 1 << 16
#: Conversations whose numbers are joined to one text.
LISTED = 1 << 12


# Digests


def turn_digest(role: Column, text: Column) -> Column:
    """The first 120 bits of the SHA-256 of a turn; role and text cannot run into each other."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 30))


def _after(digest: int, turn: bytes) -> int:
    return (digest * BASE + int.from_bytes(turn, "big") + 1) % PRIME


SCANNED = "conv_id long, turn binary, words long, place long, before binary, node binary, part int"


def _scan(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, words), sorted within ranges of conversations, with place and digests counted per task."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, place, digest = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            convs, turns = batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist()
            places, digests, befores = [], [], []
            for this, turn in zip(convs, turns, strict=True):
                if this != conv:
                    conv, place, digest = this, 0, 0
                befores.append(digest.to_bytes(WIDTH, "big"))
                place, digest = place + 1, _after(digest, turn)
                places.append(place)
                digests.append(digest.to_bytes(WIDTH, "big"))
            arrays = [pa.array(places, pa.int64()), pa.array(befores, pa.binary()), pa.array(digests, pa.binary())]
            parts = pa.array(np.full(len(convs), part, np.int32))
            given = [batch.column(c) for c in ("conv_id", "turn", "words")]
            yield pa.RecordBatch.from_arrays([*given, *arrays, parts], [c.split()[0] for c in SCANNED.split(", ")])

    return rows.mapInArrow(of, SCANNED)


def _brought(scanned: DataFrame) -> dict[int, tuple[int, int, int]]:
    """For each task that goes on with a conversation: it, its turns in the tasks before, and the digest it had there.

    One row per task comes to the driver.
    """
    last = F.max(F.struct("conv_id", "place", "node")).alias("last")
    tasks = scanned.groupBy("part").agg(F.min("conv_id").alias("first"), last).orderBy("part").collect()
    brought, open_conv, turns, digest = {}, None, 0, 0
    for task in tasks:
        conv, place, node = task["last"]
        node = int.from_bytes(node, "big")
        if task["first"] == open_conv:
            brought[task["part"]] = (open_conv, turns, digest)
        if conv == open_conv:
            turns, digest = turns + place, (digest * pow(BASE, place, PRIME) + node) % PRIME
        else:
            open_conv, turns, digest = conv, place, node
    return brought


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (conv_id, turn, words and the columns of ``order``) with ``place`` in their conversation, from 1.

    ``node`` is the digest of the turns up to this one, ``before`` that of the turns before it.
    """
    by = ["conv_id", *order]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may be dealt to several tasks
    dealt = tied.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").select("conv_id", "turn", "words")
    scanned = stored(_scan(dealt))
    brought = _brought(scanned)
    if not brought:
        return scanned

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("conv_id", "part", "place", "before", "node")}
            for n, (conv, part) in enumerate(zip(columns["conv_id"], columns["part"], strict=True)):
                if part in brought and brought[part][0] == conv:
                    _, turns, digest = brought[part]
                    place = columns["place"][n]
                    for name, power in (("before", place - 1), ("node", place)):
                        own = int.from_bytes(columns[name][n], "big")
                        columns[name][n] = ((digest * pow(BASE, power, PRIME) + own) % PRIME).to_bytes(WIDTH, "big")
                    columns["place"][n] = place + turns
            new = {c: pa.array(columns[c], batch.schema.field(c).type) for c in ("place", "before", "node")}
            yield pa.RecordBatch.from_arrays(
                [new.get(f.name, batch.column(f.name)) for f in batch.schema], schema=batch.schema
            )

    # Only the tasks that go on with a conversation need the second look.
    late = F.col("part").isin(list(brought))
    return stored(scanned.where(~late).unionByName(scanned.where(late).mapInArrow(of, SCANNED)))


# Rebuilt conversations


def cached_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its twenty."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame, group: int = 20) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and their rebuilt turns (conv_id, turn, words, place, before, node).

    A conversation starts with the first h turns of the first one of its group, then come its own after the first h.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        F.col("turn").alias("nth"),
        role.alias("role"),
        turn_digest(role, text).alias("turn"),
        word_count(text).alias("words"),
    )
    original = numbered(rows, ["nth", "role", "turn"])
    ids = stored(original.select("conv_id").distinct())
    own = original.where(F.col("place") > cached_turns(F.col("conv_id"))).select("conv_id", "turn", "words", "place")
    first = original.where(F.col("place") < 4).select(F.col("conv_id").alias("base"), "turn", "words", "place")
    taken = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base")
    taken = taken.where(F.col("place") <= cached_turns(F.col("conv_id"))).select("conv_id", "turn", "words", "place")
    joined = taken.unionByName(own).withColumnRenamed("place", "nth")
    return ids, numbered(joined, ["nth"]).drop("part")


# Shards


def _keys(column: pa.Array) -> np.ndarray:
    """The digests of an Arrow column as rows of two unsigned 64-bit numbers."""
    if not len(column):
        return np.empty((0, 2), np.uint64)
    _, offsets, values = column.buffers()
    start = int(np.frombuffer(offsets, np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(values, np.uint64, 2 * len(column), start).reshape(-1, 2)


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) + keys[:, 1] + np.uint64(level * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """A minimal perfect hash of distinct digests: n digests have the slots 0 to n - 1.

    On each level the digests that are left are thrown at twice as many bits; those that hit a bit alone have it, the
    others go one level down.  The slot is the number of bits set before.  ``held`` keeps the digest of each slot, and a
    digest is found only if it is the one kept there.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, slots = keys, 0
        while len(left):
            size = np.uint64(2 * len(left))
            at = (_mixed(left, len(self.levels)) % size).astype(np.int64)
            alone = np.bincount(at, minlength=int(size)) == 1
            ranks = slots + np.cumsum(alone) - alone
            self.levels.append((alone, ranks))
            slots += int(alone.sum())
            left = left[~alone[at]]
        self.held = np.empty((slots, 2), np.uint64)
        if slots:
            self.held[self._guess(keys)] = keys

    def _guess(self, keys: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (alone, ranks) in enumerate(self.levels):
            at = (_mixed(keys[left], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[at]
            slots[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return slots

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Slots of ``keys``, -1 for those that are not in the table."""
        slots = self._guess(keys)
        known = slots >= 0
        known[known] = (self.held[slots[known]] == keys[known]).all(axis=1)
        return np.where(known, slots, -1)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    return keys[np.append(True, (keys[1:] != keys[:-1]).any(axis=1))] if len(keys) else keys


def _binary(keys: np.ndarray) -> pa.Array:
    ends = np.arange(0, WIDTH * (len(keys) + 1), WIDTH, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())])


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict[str, pa.Array]]:
    """Columns of runs of about ``most`` rows, cut where a conversation ends; one conversation has a band of rows at most."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def columns(table: pa.Table) -> dict[str, pa.Array]:
        return {c: pa.concat_arrays(table.column(c).chunks) for c in table.column_names}

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            table = pa.Table.from_batches(held)
            ends = np.flatnonzero(np.diff(table.column("conv_id").to_numpy()))
            if len(ends):
                yield columns(table.slice(0, int(ends[-1]) + 1))
                table = table.slice(int(ends[-1]) + 1)
                held, rows = table.to_batches(), table.num_rows
    if rows:
        yield columns(pa.Table.from_batches(held))


COUNTED = "node binary, parent binary, depth long, words long, n_convs long, conv_id long"


def _counted(most: int):
    """Per shard and node: members, the smallest of them, and what all rows of the node have in common."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, most):
            nodes = _keys(shard["node"])
            table = SlotTable(_distinct(nodes))
            slots, size = table(nodes), len(table.held)
            members = np.bincount(slots, minlength=size)
            smallest = np.full(size, np.iinfo(np.int64).max)
            np.minimum.at(smallest, slots, shard["conv_id"].to_numpy())
            parent, depth, words = np.empty((size, 2), np.uint64), np.empty(size, np.int64), np.empty(size, np.int64)
            parent[slots] = _keys(shard["before"])
            depth[slots], words[slots] = shard["place"].to_numpy(), shard["words"].to_numpy()
            arrays = [_binary(table.held), _binary(parent), *map(pa.array, (depth, words, members, smallest))]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in COUNTED.split(", ")])

    return of


SUMMED = "node binary, saved long, leaves long, outside boolean"


def _summed(most: int):
    """Per shard and node the sums over its subtree; ``outside`` are sums for nodes above the shard."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, most):
            nodes = _keys(shard["node"])
            table = SlotTable(_distinct(nodes))
            slots, size = table(nodes), len(table.held)
            parents, depth = np.empty((size, 2), np.uint64), np.empty(size, np.int64)
            parents[slots], depth[slots] = _keys(shard["before"]), shard["place"].to_numpy()
            parent_slot = table(parents)
            sums = np.zeros((size, 2), np.int64)
            for n, name in enumerate(("saved", "leaves")):
                np.add.at(sums[:, n], slots, shard[name].to_numpy())
            order = np.argsort(-depth, kind="stable")
            for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
                inner = level[parent_slot[level] >= 0]
                np.add.at(sums, parent_slot[inner], sums[inner])
            tops = (parent_slot < 0) & (depth > 1)
            for keys, values, outside in ((table.held, sums, False), (parents[tops], sums[tops], True)):
                flags = pa.array(np.full(len(keys), outside))
                yield pa.RecordBatch.from_arrays(
                    [_binary(keys), pa.array(values[:, 0]), pa.array(values[:, 1]), flags],
                    [c.split()[0] for c in SUMMED.split(", ")],
                )

    return of


# The trie


def _subtree_sums(rows: DataFrame, nodes: DataFrame, deepest: int, band: int, shard: int) -> DataFrame:
    """(node, saved_tokens, n_leaves), the deepest band of turns first, so that each band meets the sums from below."""
    parts, below = [], None
    for first in range((max(deepest, 1) - 1) // band * band, -1, -band):
        here = F.col("place").between(first + 1, first + band)
        own = nodes.select("node", "conv_id", F.col("depth").alias("place"), "saved", "leaves").where(here)
        if below is not None:
            added = below.select("node", F.col("saved").alias("more"), F.col("leaves").alias("more_leaves"))
            own = own.join(added, "node", "left").withColumns(
                {
                    "saved": F.col("saved") + F.coalesce("more", F.lit(0)),
                    "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
                }
            )
        paths = rows.where(here).select("conv_id", "place", "before", "node")
        valued = paths.join(own.select("conv_id", "place", "saved", "leaves"), ["conv_id", "place"], "left")
        dealt = valued.fillna(0, ["saved", "leaves"]).repartition("conv_id").sortWithinPartitions("conv_id", "place")
        found = stored(dealt.mapInArrow(_summed(shard), SUMMED))
        added_up = found.groupBy("outside", "node").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        parts.append(added_up.where("NOT outside"))
        below = stored(added_up.where("outside"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select("node", F.col("saved").alias("saved_tokens"), F.col("leaves").alias("n_leaves"))


def _end_digests(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, ends_sha256): the conversations that end at a node, first joined to texts and then hashed text by text."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct("place", "node")).alias("last"))
    ends = ids.join(last, "conv_id", "left")
    ends = stored(ends.select("conv_id", F.coalesce("last.node", F.lit(bytearray(ROOT))).alias("node")))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, convs, done = None, [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _ in done], pa.binary()),
                    pa.array([c[0] for _, c in done], pa.int64()),
                    pa.array([",".join(map(str, c)) for _, c in done], pa.string()),
                ],
                ["node", "first", "convs"],
            )

        for given in batches:
            for this, conv in zip(given.column("node").to_pylist(), given.column("conv_id").to_pylist(), strict=True):
                if this != node or len(convs) == LISTED:
                    if convs:
                        done.append((node, convs))
                    node, convs = this, []
                convs.append(conv)
            if done:
                yield batch()
                done = []
        if convs:
            done.append((node, convs))
            yield batch()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])

        for given in batches:
            done = []
            for this, convs in zip(given.column("node").to_pylist(), given.column("convs").to_pylist(), strict=True):
                if this != node:
                    if digest is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = this, hashlib.sha256(convs.encode())
                else:
                    digest.update(b"," + convs.encode())
            yield batch(done)
        if digest is not None:
            yield batch([(node, digest.hexdigest())])

    sorted_ends = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    lists = sorted_ends.mapInArrow(listed, "node binary, first long, convs string")
    whole = lists.repartition("node").sortWithinPartitions("node", "first")
    return whole.mapInArrow(hashed, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, group: int = 20, band: int = BAND, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of rebuilt conversations ``turns`` (conv_id, turn, role, text).

    Turns go by ``turn``, null first, equal ones by role and then by the digest of role and text.  Null role or text is
    empty.  One row per node: ``conv_id``, its smallest member; ``depth``; ``parent_conv_id``, null for the root;
    ``n_convs``; ``n_children``; ``n_leaves``; ``saved_tokens``; ``ends_sha256``; and the digests ``node`` and ``parent``.

    Rows without conv_id belong to no conversation and are left out; a conv_id below 0 has the group that Spark's % gives.
    Repeated rows are turns of their own.  Of a text only digest and words are kept, however long it is.  A conversation
    of more than ``band`` turns takes one job for each band.  Other columns are ignored.  An empty table has no node.
    """
    spark = turns.sparkSession
    ids, rows = rebuilt(turns, group)
    members = ids.agg(F.count("*"), F.min("conv_id")).first()
    partial = rows.select("conv_id", "place", "words", "before", "node").mapInArrow(_counted(shard), COUNTED)
    merged = partial.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.max("words").alias("words"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
    )
    merged = stored(merged)
    children = merged.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0)).alias("n_children")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    counted = merged.join(children, "node", "left").select(*merged.columns, n_children, saved)
    nodes = stored(counted.withColumn("leaves", (F.col("n_children") == 0).cast("long")))

    total = nodes.agg(F.max("depth"), F.sum("saved"), F.sum("leaves"), F.sum((F.col("depth") == 1).cast("long"))).first()
    deepest, all_saved, leaves, tops = (v or 0 for v in total)
    root = [(ROOT, None, 0, members[0], members[1], tops, all_saved, leaves or 1)] if members[0] else []
    columns = ["node", "parent", "depth", "n_convs", "conv_id", "n_children", "saved_tokens", "n_leaves"]
    kinds = dict.fromkeys(columns, "long") | {"node": "binary", "parent": "binary"}
    root = spark.createDataFrame(root, ", ".join(f"{c} {kind}" for c, kind in kinds.items()))

    inner = nodes.join(_subtree_sums(rows, nodes, deepest, band, shard), "node").select(*columns)
    tree = stored(inner.unionByName(root).join(_end_digests(ids, rows), "node", "left"))
    tree = lookup(tree, tree.select("node", "conv_id"), {"parent": "node"}, {"parent_conv_id": "conv_id"})
    none = hashlib.sha256(b"").hexdigest()
    return tree.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        "node",
        "parent",
    )
