"""Collocations against plain Python, in the broadcast and in the salted form, and the plan of the merge-joins."""

from __future__ import annotations

import re
from collections import Counter

from starmill.llm import collocation
from starmill.llm.queries import op11_collocations

SF = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, longest=3, least=10, percent=50, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    counts[lang, tuple(words[k : k + size])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                inner = (lang, words[k : k + size])
                longer[inner] = max(longer[inner], a)
    rows = []
    for (lang, words), a in candidates.items():
        if (lang, words) in longer and 100 * longer[lang, words] >= percent * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), left, right))
    rows.sort()
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in rows:
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def found(df):
    return sorted(tuple(r) for r in df.collect())


def odd_docs():
    docs = [(None, None), ("en", ""), ("en", "A. b,c;D!"), (None, "one Two\tthree " * 30), ("und", "one two. three " * 30)]
    docs += [("de", "hot pair " * 3 + "Ärger\x0bhot pair\xa0x hot\rpair")] * 40 + [("en", "x" * 5000 + " hot pair")] * 9
    docs += [("en", "p q r s " * 4000), ("en", "a \t b a b\x1ca b\na b  c" * 12)]
    return docs


def test_query_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert found(op11_collocations(spark, SF)) == expected(docs)


def test_odd_rows(spark):
    docs = odd_docs()
    frame = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 as block", "'p' as phrase", "2 as a", "3 as n")
    assert found(collocation.collocations(frame)) == expected(docs)
    assert found(collocation.collocations(frame.repartition(5), longest=4, least=2, percent=80, top=3)) == expected(docs, 4, 2, 80, 3)
    assert found(collocation.collocations(frame, limit_bytes=0)) == expected(docs)
    assert collocation.collocations(frame.limit(0)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("starmill_")]


def test_occurrences_are_not_shuffled_or_sorted_again(spark):
    blocks = spark.createDataFrame([(k, "en", "a b c d " * 50) for k in range(40)], "block long, lang string, text string")
    ids = spark.createDataFrame([("en", w, n) for n, w in enumerate("abcd")], "lang string, word string, id long")
    with collocation._relations(spark) as relations:
        dealt = collocation._occurrences(blocks.repartition(collocation._buckets(spark), "block"))
        words = relations.write(collocation._with_ids(dealt, ids, ["lang", "word"], 1 << 20))
        pairs = collocation._extended(words.withColumn("place", words["place"] + 1), words)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert pairs.count() == 40 * 199
        named = pairs.select("head", "tail").distinct().selectExpr("*", "10 * head + tail as id")
        longer = relations.write(collocation._with_ids(pairs, named, ["head", "tail"], 1 << 20))
        triples = collocation._extended(longer, words)
        plan = triples._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Sort [" not in plan
        assert triples.count() == 40 * 198


def test_scores_are_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "x y", 2, 3 * 10**12 + 1), ("en", "x", 1, 4 * 10**12 + 7), ("en", "y", 1, 5 * 10**12 + 9)],
        "lang string, phrase string, words int, a long",
    )
    row = collocation._scored(counts.where("words > 1"), counts).first()
    a, left, right = 3 * 10**12 + 1, 4 * 10**12 + 7, 5 * 10**12 + 9
    assert tuple(row) == ("en", "x y", a, left, right, 1000000 * a * a // (left * right))


def test_words_are_cut_in_generated_code(spark):
    blocks = spark.createDataFrame(
        [(1, "en", "ABC. ÀB\tKZ\xa0Q  İ,;x\x0bY\x85z"), (2, "en", ""), (3, "en", ".\n"), (4, "en", "end")],
        "block long, lang string, text string",
    )
    occurrences = collocation._occurrences(blocks)
    # A lambda would be called word by word outside the generated code.
    assert "lambdafunction" not in occurrences._jdf.queryExecution().executedPlan().toString()
    words = [(r.block, r.place, r.word) for r in occurrences.orderBy("block", "place").collect()]
    assert [w for _, _, w in words] == ["abc", "Àb", "Kz\xa0q", "İ", "x", "y\x85z", "end"]
    places = [p for b, p, _ in words if b == 1]
    assert [b - a > 1 for a, b in zip(places, places[1:])] == [True, False, False, True, True]


def test_ids_are_ints_without_gaps(spark):
    counts = spark.range(0, 1000, 1, 7).selectExpr("id AS head", "id % 20 AS a").repartition(5)
    numbered = collocation._numbered(counts, 10)
    assert dict(numbered.dtypes)["id"] == "int" and numbered.columns == ["head", "a", "id"]
    assert sorted(r.id for r in numbered.collect()) == list(range(500))
    assert collocation._numbered(counts, 50).count() == 0
