"""Best-fit packing of tokenised documents into sequences of one length, planned over counts of lengths.

Documents are tokenised once and written as pieces of at most ``capacity`` tokens.  The plan sees one number per length:
from the longest to the shortest, all pieces of a length go into the open sequences with the least sufficient room.
Sequences with equal room are one interval of numbers, so a step moves intervals and not sequences, and the plan has a
size set by the capacity, however many documents there are.  Each step is a run of slots: so many pieces of one length,
so many to a sequence, from this sequence on, at this offset.  A piece takes the slot of its rank within its length.

Ranks need no sort: a task numbers its pieces of each length as it writes them, and the counts of the tasks before it
are added.  A length that very many documents share is spread over all tasks.
"""

from __future__ import annotations

import bisect
import os
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_slices

PIECES = "doc_id long, piece int, start long, length long, tokens binary, part int, place long"
SLOTS = "length long, first long, last long, per_sequence long, first_sequence long, offset long"
#: Characters that are tokenised in one call.
CALL = 1 << 20
#: The longest stretch whose tokens are remembered, and how many of them a task remembers.
SHORT, MEMO = 48, 1 << 19
#: Bytes of tokens in a batch that goes back to Spark.
BATCH = 4 << 20

# In the pattern of the byte-level vocabularies a token holds white space only in front of anything else, and only the
# end of a run of white space looks ahead.  So a token always ends before white space that follows anything else.  It also
# ends between a letter and a mark other than the apostrophe, and between a single line feed and a letter.
_LETTER = r"[^\W\d_\u0800-\U0010ffff]"
_STRETCH = re.compile(
    rf"[ \t\n\r]*{_LETTER}++(?=[ \t\n\r.,;:!?\"()-]|\Z)|\n(?={_LETTER})|[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+"
)
_RARE_SPACE = re.compile(r"[^\S \t\n\r]")
_STRETCH_END = re.compile(r"(?<=\S)(?=[ \t\n\r])")


@lru_cache
def _tokenizer(file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


#: How byte-level vocabularies write a space.
_SPACE = chr(256 + 32)


@lru_cache
def _visible() -> dict[int, int]:
    """How byte-level vocabularies write bytes: visible ones as the character of that number, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {byte: 256 + n for n, byte in enumerate(b for b in range(256) if b not in visible)}


def _word_ids(tokenizer, part: str) -> list[int] | None:
    """The ids of a word of letters, with or without a space before it, which no pattern cuts; None for anything else."""
    spaced = part.startswith(" ")
    body = part[1:] if spaced else part
    if not body.isalpha():
        return None
    if not body.isascii():
        if max(body) >= "\u0800":
            return None
        body = body.encode().decode("latin-1").translate(_visible())
    return [token.id for token in tokenizer.model.tokenize(_SPACE + body if spaced else body)]


class _Memo:
    """The tokens of the stretches met last: two generations of which the older one goes when the newer one is full."""

    def __init__(self, file: str) -> None:
        self.tokenizer = _tokenizer(file)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of(self, parts: list[str]) -> bytes:
        """The tokens of stretches, end to end; those that are not known are tokenised."""
        if len(self.known) > MEMO // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        rest = []
        for part in set(parts).difference(known):
            tokens = older.get(part)
            if tokens is None:
                ids = _word_ids(self.tokenizer, part)
                if ids is None:
                    rest.append(part)
                    continue
                tokens = array("I", ids).tobytes()
            known[part] = tokens
        for run in _runs(rest):
            found = self.tokenizer.encode_batch_fast(run, add_special_tokens=False)
            known.update((part, array("I", e.ids).tobytes()) for part, e in zip(run, found, strict=True))
        tokens = b"".join(map(known.__getitem__, parts))
        for part in rest:
            if len(part) > SHORT:
                del known[part]
        return tokens


def _runs(parts: list[str]) -> Iterator[list[str]]:
    """Runs of parts with about ``CALL`` characters."""
    run, size = [], 0
    for part in parts:
        run.append(part)
        size += len(part)
        if size > CALL:
            yield run
            run, size = [], 0
    if run:
        yield run


@lru_cache
def _memo(file: str) -> _Memo:
    return _Memo(file)


def stretches(text: str) -> list[str]:
    """A text cut into about its words, where tokenising the parts one by one gives the tokens of the whole."""
    return _STRETCH_END.split(text) if _RARE_SPACE.search(text) else _STRETCH.findall(text)


def token_ids(file: str, text: str | None, end_id: int | None) -> np.ndarray:
    """The ids of a text, ``end_id`` after the last; a null text is empty.  Each new stretch is tokenised once."""
    tokens = _memo(file).of(stretches(text or ""))
    ids = np.frombuffer(tokens if end_id is None else tokens + array("I", [end_id]).tobytes(), np.uint32)
    return ids.astype("<u4", copy=False)


def pieces(docs: DataFrame, file: str, capacity: int, end_id: int | None = 0) -> DataFrame:
    """The tokens of each document, cut from behind: all pieces but the first have ``capacity`` tokens.

    ``tokens`` holds little-endian unsigned 32-bit ids; ``part`` is the task and ``place`` counts the task's pieces of
    this length.  Write the result before using ``place``.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, rows, size = TaskContext.get().partitionId(), Counter(), [], 0

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        for given in text_slices(batches):
            for doc_id, text in zip(*(given.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                tokens = token_ids(file, text, end_id)
                start, number = 0, 0
                end = len(tokens) % capacity or min(capacity, len(tokens))
                while start < len(tokens):
                    length = end - start
                    rows.append((doc_id, number, start, length, tokens[start:end].tobytes(), part, seen[length]))
                    seen[length] += 1
                    size += 4 * length
                    start, end, number = end, end + capacity, number + 1
                    if size >= BATCH:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    return docs.select("doc_id", "text").mapInArrow(of, PIECES)


def plan(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots for ``counts`` pieces of each length by best fit, longest first.

    A slot is (length, first and last rank within the length, pieces to a sequence, first sequence, offset): rank q sits in
    sequence ``first_sequence + (q - first) // per_sequence`` behind ``(q - first) % per_sequence`` others of its length.
    A touched interval of sequences is split into three at most, and its room at least halves, so there are at most
    some ``6 * log2(capacity)`` slots for each length.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)
    rooms: list[int] = []  # the keys of ``room``, sorted
    slots, opened = [], 0

    def add(free: int, first: int, n: int) -> None:
        if n and free:
            if free not in room:
                bisect.insort(rooms, free)
            room[free].append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                new = -(-left // (capacity // length))
                add(capacity, opened, new)
                opened += new
                at = bisect.bisect_left(rooms, length)
            free = rooms[at]
            first, n = room[free].pop()
            if not room[free]:
                del room[free], rooms[at]
            per = free // length
            full = min(n, left // per)
            rest = left - full * per if full < n else 0  # fewer than would fill the next sequence
            taken = full * per + rest
            slots.append((length, rank, rank + taken - 1, per, first, capacity - free))
            add(free - per * length, first, full)
            if rest:
                add(free - rest * length, first + full, 1)
            add(free, first + full + (rest > 0), n - full - (rest > 0))
            rank, left = rank + taken, left - taken
    return slots


def pack(docs: DataFrame, file: str, capacity: int = 2048, end_id: int | None = 0) -> DataFrame:
    """Pack ``docs`` (doc_id, text), tokenised by the vocabulary in ``file``, into as few sequences as best fit finds.

    One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (tokens of its document before it), ``length``, ``tokens``
    (little-endian unsigned 32-bit ids), ``sequence_id`` and ``offset``.  ``end_id`` follows each text.  Only documents of
    more than ``capacity`` tokens are cut; their first piece may be shorter.  A null or empty text is ``end_id`` alone,
    or gives no row if that is None.  Texts are tokenised stretch by stretch, so very long ones too.  Rows that repeat a doc_id, or have
    none, are packed like others.  Other columns are ignored; an empty table gives an empty result.

    To the driver comes one count per length, and back goes the plan, both bounded by the capacity.
    """
    cut = stored(pieces(docs, file, capacity, end_id))
    per_task = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = dict(per_task.groupBy("length").agg(F.sum("n")).collect())
    slots = docs.sparkSession.createDataFrame(plan(counts, capacity), SLOTS)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(offsets, ["part", "length"]).withColumn("rank", F.col("place") + F.col("earlier"))
    nth = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & F.expr("rank BETWEEN first AND last")).select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "tokens",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("offset") + F.pmod(nth, "per_sequence") * ranked["length"]).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``tokens`` end to end, and ``pieces`` with doc_id, piece, offset and length.

    A group is one sequence, so the capacity bounds it.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "tokens")))
    return packed.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id",
        F.expr("aggregate(inside, cast('' as binary), (all, p) -> concat(all, p.tokens))").alias("tokens"),
        F.expr("transform(inside, p -> struct(p.doc_id, p.piece, p.offset, p.length))").alias("pieces"),
    )
