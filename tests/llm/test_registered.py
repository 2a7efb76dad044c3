"""The registered queries and the pipeline on whole tables."""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from starmill.llm.queries import ORACLE, QUERIES
from tests.llm.test_pairs import fingerprint, smallest_reachable
from tests.llm.test_single import shares
from tests.oracle_check import database, mismatch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_all_operators_and_the_pipeline_are_registered():
    assert {re.match(r"op(\d+)_", name)[1] for name in QUERIES} <= {str(n) for n in range(1, 14)}
    assert queries().keys() >= {*QUERIES, "pipeline"} and oracle_sql().keys() >= ORACLE.keys()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert mismatch(spark, con, SF, name) is None


@pytest.mark.parametrize("name", ["op7_decontaminate", "op8_mix_sources"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_or_crashes(spark, name):
    df = QUERIES[name](spark, SF)
    assert not re.search("CartesianProduct|NestedLoop", df._jdf.queryExecution().executedPlan().toString())
    assert df.count() > 0


def normal(text):
    return " ".join(text.lower().translate(str.maketrans(string.whitespace, " " * 6, string.punctuation)).split())


def test_pipeline_equals_plain_python(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    items = [normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(i, t, s) for i, t, s in docs if t and any(c.isalpha() for c in t)]
    texts = {(text, source) for _, text, source in docs}
    pages, seen = Counter(s for _, s in texts), defaultdict(int)
    for text, source in texts:
        for line in {line.strip(" ") for line in text.split("\n")} - {""}:
            seen[source, line] += 1
    least = {s: min(5, max(2, -(-n // 2))) for s, n in pages.items()}
    common = {k for k, n in seen.items() if n >= least[k[0]] and n > 0.02 * pages[k[0]]}
    docs = [(i, "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in common), s) for i, t, s in docs]
    prints = [(i, fingerprint(t)) for i, t, _ in docs]
    links = [(i, j) for i, p in prints for j, q in prints if i < j and (p ^ q).bit_count() <= 3]
    root = smallest_reachable({i for i, _ in prints}, links)
    docs = [d for d in docs if root[d[0]] == d[0]]
    docs = [d for d in docs if not any(f" {x} " in f" {normal(d[1])} " for x in items)]
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(text.split())

    mixed = corpus_pipeline.run(spark, SF).collect()
    kept = {i: (t, s) for i, t, s in docs}
    taken = Counter()
    for row in mixed:
        assert kept[row["doc_id"]] == (row["text"], row["source"])
        assert row["n_chars"] == len(row["text"]) and row["copies"] in (1, 2)
        taken[row["source"]] += row["copies"] * len(row["text"].split())
    for source, target in shares(sizes, (3, 1, 2), 1.5, 2).items():
        assert abs(taken[source] - target) <= max(len(t.split()) for t, s in kept.values() if s == source)


def test_one_document_of_a_large_group_of_copies_stays_whole(spark):
    words = [f"w{k}" for k in range(60)]
    copied = "\n".join(" ".join(words[k : k + 20]) for k in (0, 20, 40))
    rows = [(k, copied, "a") for k in range(30)] + [(40, copied.upper(), "a")]
    rows += [(100 + k, f"menu\nown x{k} y{k} z{k} u{k} v{k}", "a") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "'en' as lang", "0L as n_chars")
    left = corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, SF), SF).collect()
    assert {r["doc_id"] for r in left} == {0, *range(100, 160)}
    assert next(r["text"] for r in left if r["doc_id"] == 0) == copied


def test_columns_named_like_those_of_the_stages(spark):
    names = ("copies", "mix_copies", "n_lines", "N_Dropped", "__lines", "kept", "fingerprint", "found", "threshold")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) as `{n}`" for n in names]).withColumn("lang", F.lit(None).cast("string"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
        if name != "mix":
            assert docs.columns == columns
    assert docs.count() > 10
    for row in docs.collect():
        given = {n: row["given_copies" if n == "copies" else "given_mix_copies" if n == "mix_copies" else n] for n in names}
        assert given == {n: f"{n}{row['doc_id']}" for n in names} and row["copies"] in (1, 2)


def test_stages_keep_the_columns_and_accept_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (None, "some words here", "en", "a", 3)]
    rows += [(3, "some words here", "en", "a", 3), (3, "some words here", "en", "a", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema).selectExpr("*", "1 as copy_key", "'x' as point")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
            assert docs.columns == (columns if name != "mix" else [*columns, "copies"])
