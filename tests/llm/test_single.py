"""Operators on single documents, pages and conversations against plain Python, round trips and held-out rows."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.llm import chat, language_id, lines, mixing, quality, warc
from starmill.sources import scratch_root

# Chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", ">", "|", "im_end|>", "s>", "SYS>>", "a", "\n", "é"]), max_size=12))
def test_escaping_is_reversible_and_hides_control_strings(parts):
    text = "".join(parts)
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)


TURNS = (
    [(1, 0, "system", "be kind"), (1, 1, "user", "q" * 90), (1, 2, "assistant", "a" * 400)]
    + [(1, k, ("user", "assistant")[k % 2 == 0], f"turn {k} " * (k % 7)) for k in range(3, 30)]
    + [(2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "<|im_end|>\\<|im_end|>")]
    + [(3, None, None, None), (3, 0, "assistant", None), (3, 0, "assistant", ""), (3, 1, "tool\n<|im_sep|>", "x\ny")]
    + [(4, 1, "assistant", "twice"), (4, 1, "assistant", "twice"), (None, 5, "user", "none"), (None, 6, "assistant", "né🙂")]
    + [(5, 0, "user", "long " * 40000), (5, 1, "assistant", "end")]
)


def ordered():
    conversations = defaultdict(list)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(TURNS, key=key):
        conversations[conv].append((role or "", text or ""))
    return conversations


def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as window_no", "'x' as tokens", "0 as loss"
    )


@pytest.mark.parametrize("budget", [1, 60, 10**6])
def test_every_turn_is_formatted_once_and_read_back(spark, budget):
    found = {r["conv_id"]: r for r in chat.format_and_read(turns(spark), budget=budget).collect()}
    want = ordered()
    assert found.keys() == want.keys()
    for conv, parts in want.items():
        said = "".join(t for role, t in parts if role == "assistant")
        row = found[conv]
        assert row["n_turns"] == len(parts)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in parts).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert row["n_windows"] == 1 or budget < 10**6


def test_windows_keep_to_the_budget_and_repeat_what_came_before(spark):
    windows = chat.format_windows(turns(spark), budget=60, history=2).where("conv_id = 1").orderBy("window_no").collect()
    parts, at = ordered()[1], 0
    assert len(windows) > 3
    for w in windows:
        said = [(role, text) for role, text, _, _ in chat.parsed(w["text"])]
        head, new = said[: w["n_repeated"]], said[w["n_repeated"] :]
        assert w["first_turn"] == at and new == parts[at : at + w["n_turns"]]
        assert w["tokens"] <= 60 or len(new) == 1
        if at:
            assert head[0] == parts[0] and len(head) <= 3
            assert head[1:] == parts[1:at][len(parts[1:at]) - len(head) + 1 :]
        masked = [w["text"][s["start"] : s["end"]] for s in w["loss"]]
        assert masked == [chat.escape(t) for r, t in new if r == "assistant" and t]
        at += w["n_turns"]
    assert at == len(parts)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_and_read(empty).count() == 0


# WARC

PAGES = [
    (1, "http://www.B.example/x?q=1", "<p>same</p>"),
    (2, "https://a.example:8080/ü \r\nHost: evil", "<p>same</p>"),
    (3, "http://b.example/x?q=1", "<p>é🙂</p>" * 5000),
    (4, None, None),
    (5, "", ""),
    (6, "http://[bad", ""),
    (7, "http://b.example/", "a\r\n\r\nContent-Length: 3"),
    (None, "http://c.example/", "<p>same</p>"),
    (None, "http://c.example/", "alone"),
    (8, "http://d.example/", "WARC/1.1\r\n"),
    (9, "http://d.example/", "twice"),
    (9, "http://d.example/", "twice"),
]


@pytest.mark.parametrize("file_bytes", [1, 64 << 20])
def test_archives_read_back(spark, file_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as sha1", "'x' as first")
    folder = scratch_root(spark)
    runs = warc.write_archives(pages, folder, file_bytes=file_bytes)
    histories = warc.capture_histories(runs).collect()
    keys = [(r["urlkey"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in histories]
    assert keys == sorted(keys) and len(keys) == len(PAGES)
    assert {"example,b)/x?q=1", "-", "example,d)/"} <= {k[0] for k in keys}
    found = warc.read_captures(warc.capture_histories(runs), folder).drop("urlkey").collect()
    largest = defaultdict(lambda: None)
    for page, _, html in PAGES:
        if page is not None:
            largest[html or ""] = max(page, largest[html or ""] or page)
    want = []
    for page, _, html in PAGES:
        data, first = (html or "").encode(), largest[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        other = None if page == first else first
        want.append((page, len(data), digest, "response" if other is None else "revisit", other))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), max_size=6), max_size=9))
def test_loser_tree_merges_sorted_runs(runs):
    merged = [head for _, head in warc.LoserTree([iter(sorted((x,) for x in run)) for run in runs])]
    assert merged == sorted((x,) for run in runs for x in run)


def test_damaged_records_are_refused():
    record = warc._record({"page_id": 1, "url": "u", "html": "abc", "refers_to": None}, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload_bytes"] == 3
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record.replace(b"abc", b"abd"))


# Mixing


def shares(sizes, weights, share, most):
    """Targets by sharing out what is left among those that are not full, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, target = set(), {}
    while True:
        rest = share * sum(sizes.values()) - sum(target[s] for s in full)
        live = [s for s in names if s not in full]
        target |= {s: rest * weight[s] / sum(weight[x] for x in live) for s in live}
        above = [s for s in live if target[s] > most * sizes[s]]
        if not above:
            return target
        full |= set(above)
        target |= {s: most * sizes[s] for s in full}


def test_mix_meets_its_targets(spark):
    rng = random.Random(2)
    rows = [(k, " ".join("w" * rng.randrange(0, 60)), rng.choice("aaaaaabbcdé")) for k in range(3000)]
    rows += [(5000, None, "a"), (5001, "", "b"), (5002, " \t", None), (5003, "x\x0by\rz", None), (None, "u v", "c"), (7, "again and again", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "'x' as point", "0 as mix_copies")
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    found = mixed.select("text", "source", "mix_copies").collect()
    sizes, taken = Counter(), Counter()
    for text, source, copies in found:
        sizes[source] += len((text or "").split())
        taken[source] += copies * len((text or "").split())
        assert 0 <= copies <= 2
    want = shares(sizes, (3, 1, 2), 1.5, 2)
    assert len(found) == len(rows)
    for source, target in want.items():
        assert abs(taken[source] - target) <= 60
    sized = mixing.sized(docs)
    bounds = {r["source"]: r["target"] for r in mixing.thresholds(sized).collect()}
    assert bounds == pytest.approx(want)
    again = sorted(map(str, mixing.mix_sources(docs.repartition(5)).collect()))
    assert again == sorted(map(str, mixed.collect()))


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert mixing.mix_sources(blank).count() == 2


# Lines


def test_boilerplate_is_relative_to_its_site(spark):
    rows = [(k, f"head\nline {k}\n\n  foot \nline {k}", "big") for k in range(50)]
    rows += [(100 + k, f"head\nown {k}", "other") for k in range(4)] + [(200 + k, "foot\nhead", None) for k in range(6)]
    rows += [(300, None, "big"), (301, "", "big"), (302, "rare\nhead\nrare", "big"), (0, "head\nline 0", "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "1 as host", "'x' as keys", "0 as n_lines", "0 as line", "1 as __lines", "2 as __kept")
    out = lines.drop_boilerplate(docs, ratio=0.5, min_pages=5)
    found = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()]
    want = [(k, f"line {k}\n\nline {k}", 5, 2) for k in range(50)]
    # Half the pages of a small site are enough; copies are one page, and one page has no boilerplate.
    want += [(100 + k, f"own {k}", 2, 1) for k in range(4)] + [(200 + k, "foot\nhead", 2, 0) for k in range(6)]
    want += [(300, None, 0, 0), (301, "", 1, 0), (302, "rare\nrare", 3, 1), (0, "line 0", 2, 1)]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert out.columns == ["doc_id", "text", "source", "host", "keys", "line", "__lines", "__kept", "n_lines", "n_dropped"]


def test_a_copied_text_is_not_boilerplate(spark):
    copied = "its first line\nits second line\nmenu"
    rows = [(k, copied, "a") for k in range(30)] + [(100 + k, f"menu\nown {k}", "a") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = lines.drop_boilerplate(docs)
    found = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in cut.collect()}
    assert found == {k: ("its first line\nits second line", 1) for k in range(30)} | {100 + k: (f"own {k}", 1) for k in range(60)}
    # Without copies there are 61 pages; with them the copied text is more than a fiftieth of 90.
    assert {r["text"] for r in lines.drop_boilerplate(docs, copies=True).collect() if r["doc_id"] < 30} == {""}


def test_lines_of_small_sites_and_of_a_long_page(spark):
    rows = [(10 * n + k, f"menu\nown {n} {k}", f"s{n}") for n in range(1, 13) for k in range(n)]
    rows += [(1000 + k, "\n".join(["menu", *[f"l{j} {k}" for j in range(20000)]]), "long") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    dropped = {r["doc_id"]: r["n_dropped"] for r in lines.drop_boilerplate(docs).collect()}
    assert dropped == {i: int(s != "s1") for i, _, s in rows}
    some = spark.createDataFrame(
        [(k, f"own {k}" + ("\nseen" if k < n else ""), f"s{size}") for size, n in ((4, 1), (6, 3), (8, 3), (40, 5), (41, 4)) for k in range(size)],
        "doc_id long, text string, source string",
    )
    cut = lines.drop_boilerplate(some).groupBy("source").sum("n_dropped").collect()
    assert dict(map(tuple, cut)) == {"s4": 0, "s6": 3, "s8": 0, "s40": 5, "s41": 0}


def test_lines_of_nothing(spark):
    assert lines.drop_boilerplate(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


# Language

SYLLABLES = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ein", "ung", "er"], "zz": ["eaux", "é", "tion", "que"]}


def prose(rng, language, n):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = language_id.Model.new(["a", "b", "c"], 4, rng)
    for name in ("inputs", "states"):
        setattr(model, name, [w.astype(np.float64) for w in getattr(model, name)])
    model.out, model.bias = model.out.astype(np.float64), rng.standard_normal(3)
    data, labels = rng.integers(97, 103, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = language_id.gradients(model, data, labels)
    for w, g in zip(model.weights(), grads, strict=True):
        at = tuple(int(k) for k in np.unravel_index(np.abs(g).argmax(), g.shape))
        kept, step = w[at], 1e-3
        w[at] = kept + step
        up = language_id.gradients(model, data, labels)[0]
        w[at] = kept - step
        down = language_id.gradients(model, data, labels)[0]
        w[at] = kept
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.02)


def test_language_of_held_out_texts(spark, monkeypatch):
    monkeypatch.setattr(language_id, "REMEMBERED", 50)
    rng = random.Random(1)
    rows = [(k, prose(rng, name, rng.randrange(20, 200)), name) for k in range(300) for name in [rng.choice("xxx yyy zzz".split())[:2]]]
    rows += [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 -- 3", None), (1003, prose(rng, "yy", 30000), None)]
    rows += [(None, prose(rng, "zz", 40), None), (1004, "x" * 5000 + "einerungschein" * 900, None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'x' as lang_pred")
    model = language_id.fit(docs)
    assert model.languages == ["xx", "yy", "zz"]
    found = language_id.identify(docs, model).collect()
    truth = {i: name for i, _, name in rows}
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 300]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found) and len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "yy", "zz"]
    assert by_id[1002]["score"] == 0
    kept = language_id.with_language(docs, model)
    assert kept.columns == docs.columns
    placed = {r["doc_id"]: r["lang_pred"] for r in found if r["lang_pred"] != "und" and r["score"] >= language_id.LEAST}
    assert {r["doc_id"]: r["lang"] for r in kept.collect()} == placed and 1000 not in placed and len(placed) > 300
    unlearnt = docs.withColumn("lang", F.lit(None).cast("string"))
    left = language_id.with_language(unlearnt, language_id.fit(unlearnt)).collect()
    assert len(left) == len(rows) - 3 and {r["lang"] for r in left} == {None}
    assert [(r["lang_pred"], r["score"]) for r in language_id.identify(docs.limit(1), None).collect()] == [("und", 0.0)]


def test_repeated_words_are_labelled_like_single_ones():
    model = language_id.Model.new(["a", "b"], 4, np.random.default_rng(1))
    words = [b"one", b"two", b"one", b"a" * 60]
    rows = language_id.Labeller(model).of(words)
    long = sum(model.positions(np.frombuffer(p, np.uint8)[None])[0].sum(axis=0) for p in language_id.segments(words[3]))
    assert np.allclose(rows[0], rows[2]) and np.allclose(rows[3], long)
    assert rows.sum() == pytest.approx(69, rel=1e-4)


def test_spans_label_every_byte_once(spark):
    rng = random.Random(9)
    texts = [(k, " ".join(prose(rng, name, 30) for name in ("xx", "yy", "zz"))) for k in range(40)]
    model = language_id.train([(prose(rng, name, 400), name) for name in ("xx", "yy", "zz")], steps=300)
    docs = spark.createDataFrame([*texts, (90, None), (91, " \n"), (92, "x" * 60)], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in language_id.language_spans(docs, model).collect()}
    assert found[90] == [] and found[91] == [] and found[92][-1]["end"] == 60
    covered = Counter()
    for k, text in texts:
        data, spans = text.encode(), found[k]
        ends = [s["end"] for s in spans]
        assert spans[0]["start"] == 0 and ends[-1] == len(data)
        assert all(not data[a:b["start"]].strip() for a, b in zip(ends, spans[1:], strict=False))
        assert all(a["lang"] != b["lang"] for a, b in zip(spans, spans[1:], strict=False))
        for s in spans:
            covered[s["lang"]] += s["end"] - s["start"]
    assert all(covered[name] > 0.2 * sum(covered.values()) for name in ("xx", "yy", "zz"))


def test_language_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.fit(empty) is None
    assert language_id.identify(empty, None).count() == 0


# Quality


def test_positive_unlabelled_learning_separates(spark):
    rng = random.Random(3)
    good = lambda: prose(rng, "xx", 60)
    bad = lambda: " ".join(["!!"] * 20 + [prose(rng, "xx", 1)] * 30)
    rows, labels = [], []
    for k in range(900):
        fine = rng.random() < 0.75
        rows.append((k, good() if fine else bad()))
        if rng.random() < 0.4:
            labels.append((k, int(fine), 0))
    rows += [(2000, None), (2001, ""), (None, good()), (2002, good() * 500), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as quality", "'x' as good", "2 as score")
    marks = spark.createDataFrame([*labels, labels[0], (5000, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, marks)
    found = quality.classify(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    truth = {k: "!!" not in t for k, t in rows if k is not None and k < 900}
    right = [(r["predicted"] == 1) == truth[r["doc_id"]] for r in found if r["doc_id"] in truth]
    assert np.mean(right) > 0.97
    again = quality.classify(docs, quality.fit(docs.repartition(3), marks)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_quality_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, marks) is None
    assert [tuple(r) for r in quality.classify(docs, None).collect()] == [(1, 0.5, 1)]
    assert quality.classify(docs.limit(0), None).count() == 0
    only = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    quality.classify(docs, quality.fit(docs, only)).collect()
