"""Best-fit packing against plain Python: tokens of whole texts, cuts, places and the number of sequences."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starmill.llm.packing import pack, plan, sequences, token_ids
from starmill.llm.queries import op13_best_fit_packing

FILE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
WHOLE = Tokenizer.from_file(FILE)
WHOLE.encode_special_tokens = True


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab'slvre 1.,-\t\n\r\x0b\x0c\x1c\x85\xa0 　é中!́<|>"), max_size=24))
def test_stretches_give_the_tokens_of_the_whole(text):
    assert token_ids(FILE, text, 0).tolist() == ids_of(text)


def placed(slots, counts, capacity):
    """Every piece of a plan: (sequence, offset, length)."""
    seen = Counter()
    for length, first, last, per, sequence, offset in slots:
        assert first == seen[length]
        for nth in range(last - first + 1):
            yield sequence + nth // per, offset + nth % per * length, length
        seen[length] = last + 1
    assert seen == Counter(counts)


def check_places(rows, capacity):
    """Sequences are gapless from 0 and not too long; returns how many there are."""
    ends = defaultdict(int)
    for sequence, offset, length in sorted(rows):
        assert offset == ends[sequence]
        ends[sequence] += length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def best_fit(lengths, capacity):
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, free in enumerate(room) if free >= length]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= length
        else:
            room.append(capacity - length)
    return len(room)


def test_plan_needs_no_more_sequences_than_best_fit_over_documents():
    for seed in range(60):
        r = random.Random(seed)
        capacity = r.choice([7, 32, 100])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 300))]
        lengths += [r.randint(1, capacity)] * r.choice([0, 150])
        used = check_places(placed(plan(Counter(lengths), capacity), Counter(lengths), capacity), capacity)
        assert used <= best_fit(lengths, capacity)


def test_plan_does_not_grow_with_the_documents():
    r = random.Random(5)
    counts = {length: r.randint(1, 9) for length in range(1, 2049)}
    few, many = plan(counts, 2048), plan({k: n * 10**9 + 1 for k, n in counts.items()}, 2048)
    assert len(few) < 6 * 11 * 2048 and len(many) < 6 * 11 * 2048


def expected(docs, capacity):
    rows = []
    for doc_id, text in docs:
        ids = ids_of(text)
        start, end, piece = 0, len(ids) % capacity or capacity, 0
        while start < len(ids):
            crc = zlib.crc32(np.array(ids[start:end], "<u4").tobytes())
            rows.append((doc_id, piece, start, end - start, crc))
            start, end, piece = end, end + capacity, piece + 1
    return rows


def test_query_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in op13_best_fit_packing(spark, SF).collect()]
    want = expected(docs, 2048)
    assert sorted(r[:5] for r in found) == sorted(want)
    used = check_places([(r[5], r[6], r[3]) for r in found], 2048)
    assert used <= best_fit([r[3] for r in want], 2048)
    assert op13_best_fit_packing(spark, SF).dtypes[1] == ("piece", "int")


def test_odd_rows(spark):
    long = "many words of one kind " * 40000
    docs = [(1, None), (2, ""), (None, "no id"), (3, "a"), (3, "a"), (4, long), (5, "x" * 70000), (6, "<|endoftext|>")]
    docs += [(100 + k, "copy") for k in range(500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as part", "2 as length", "3 as rank")
    packed = pack(frame.repartition(7), FILE, 64)
    found = [tuple(r) for r in packed.selectExpr("doc_id", "piece", "start", "length", "crc32(tokens)", "sequence_id", "offset").collect()]
    order = lambda r: str(r)
    assert sorted((r[:5] for r in found), key=order) == sorted(expected(docs, 64), key=order)
    assert check_places([(r[5], r[6], r[3]) for r in found], 64) <= best_fit([r[3] for r in found], 64)
    for row in sequences(packed).collect():
        tokens = np.frombuffer(row["tokens"], "<u4")
        assert len(tokens) == sum(p["length"] for p in row["pieces"]) <= 64
        assert [p["offset"] for p in row["pieces"]] == sorted(p["offset"] for p in row["pieces"])
    assert pack(frame.limit(0), FILE).count() == 0
    assert pack(frame.where("doc_id < 3"), FILE, end_id=None).count() == 0
