"""The trie of conversation prefixes against plain Python, its slots and its digests."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from starmill.llm import prefix_trie as trie
from starmill.llm.queries import op12_prefix_trie

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = sha(f"{len(role.encode())}:{role}{text}")
            turns[conv].append(((turn is not None, turn or 0), role.encode(), tie, (role, text)))
    original = {c: [t[-1] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in turns.items()}
    whole = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = tuple(original.get(base, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
    saved, leaves = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode().split())
        leaves[node] += not children[node]
        if node:
            saved[node[:-1]] += saved[node]
            leaves[node[:-1]] += leaves[node]
    return sorted(
        (
            min(cs),
            len(node),
            min(members[node[:-1]]) if node else -1,
            len(cs),
            len(children[node]),
            leaves[node],
            saved[node],
            sha(",".join(str(c) for c in sorted(cs) if whole[c] == node)),
        )
        for node, cs in members.items()
    )


def found(df):
    return sorted(tuple(r) for r in df.fillna(-1, ["parent_conv_id"]).select(*COLUMNS).collect())


def test_query_equals_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op12_prefix_trie(spark, SF)) == expected(rows)


def odd_rows(r):
    rows = []
    for conv in [*range(60), 10**12, -3, -40]:
        for turn in range(r.randint(1, 6)):
            rows.append((conv, turn, r.choice(["user", "assistant", None]), r.choice(["a", "b c", "", None, "d\te\nf"])))
    rows += [(7, None, "user", "late"), (7, None, None, None), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (None, 1, "user", "x")]
    rows += [(500, t, "user", f"w{t} v") for t in range(900)] + [(501, t, "user", f"w{t} v") for t in range(700)]
    rows += [(600, None, "user", "same")] * 400
    rows += [(1000 + k, t, "user", f"common {t}") for k in range(300) for t in range(2)]
    return rows


@pytest.fixture
def many_tasks(spark):
    """Small ranges stay apart, so that conversations go on from task to task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows_long_conversations_bands_and_shards(spark, many_tasks):
    rows = odd_rows(random.Random(3))
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as node", "1 as place", "2 as base", "3 as words")
    want = expected(rows)
    assert found(trie.prefix_trie(frame.repartition(11))) == want
    assert found(trie.prefix_trie(frame, band=100, shard=64)) == want
    assert trie.prefix_trie(frame.limit(0)).count() == 0
    assert found(trie.prefix_trie(frame.where("conv_id = 10"))) == expected([r for r in rows if r[0] == 10])


def test_conversation_of_several_tasks_has_the_digests_of_one(spark, many_tasks):
    rows = spark.range(5000).selectExpr("7L as conv_id", "id as nth", "unhex(substring(sha2(cast(id as string), 256), 1, 30)) as turn", "1L as words")
    digest, want = 0, []
    for n in range(5000):
        before, digest = digest, trie._after(digest, bytes.fromhex(sha(str(n))[:30]))
        want.append((n + 1, before, digest))
    given = trie.numbered(rows, ["nth"]).orderBy("place").collect()
    assert len({r["part"] for r in given}) > 1
    assert [(r["place"], int.from_bytes(r["before"], "big"), int.from_bytes(r["node"], "big")) for r in given] == want


def test_slots_are_minimal_perfect_and_verified():
    r = np.random.default_rng(1)
    for size in (0, 1, 2, 1000, 50000):
        keys = trie._distinct(r.integers(0, 2**63, (size, 2)).astype(np.uint64))
        table = trie.SlotTable(keys)
        assert sorted(table(keys).tolist()) == list(range(len(keys)))
        assert (table(r.integers(2**63, 2**64 - 1, (1000, 2), dtype=np.uint64)) == -1).all()
