"""Landing with rejects and observed counts, and inferred types that add up."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.sources import (
    TooManyRejects,
    drift,
    file_states,
    inferred_schema,
    land,
    merged_states,
    read_delimited,
    read_table,
    resolved,
    type_states,
)
from starmill.sources.inference import least_kind

SCHEMA = "id long, day date, `the size` int, price double"


def extract(root, *files):
    root.mkdir(parents=True, exist_ok=True)
    for n, lines in enumerate(files):
        (root / f"part{n}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(root)


BAD = {
    "2,2024-02-30,3,1.5,x": "day: not date",
    "3,2024-01-01,3.0,1.5,x": "the size: not int",
    "4,2024-01-01,3,cheap,x": "price: not double",
    "5,2024-01-01,3": "number of fields",
    "6,2024-01-01,3,1.5,x,y": "number of fields",
    "nine,2024-02-30,3,1.5,x": "id: not bigint",
    "7,,3,1.5,x": "day: missing",
    "99999999999999999999,2024-01-01,3,1.5,x": "id: not bigint",
}
GOOD = ["1,2024-01-01,3,1.5,x", '8,2024-01-02,,,"quoted, text"', "10,2024-01-03,-2,1e3,"]
HEADER = "ID,Day,the size,price,more"


def test_rejects_are_kept_and_counts_add_up(spark, tmp_path):
    path = extract(tmp_path / "in", [HEADER, *GOOD, *list(BAD)[:4]], [HEADER, *list(BAD)[4:]])
    landed = land(spark, path, str(tmp_path / "out"), SCHEMA, required=["day"], max_rejected=0.8)
    assert (landed.rows_read, landed.rows_rejected, landed.rows_good) == (11, 8, 3)
    assert sorted(r.id for r in landed.rows.collect()) == [1, 8, 10]
    assert landed.rows.columns == ["id", "day", "the size", "price"]
    assert landed.rows.where("id = 10").first().price == 1000.0
    rejects = landed.rejects.collect()
    assert sorted(r._reject_reason for r in rejects) == sorted(BAD.values())
    assert {r._file for r in rejects} == {"part0.csv", "part1.csv"}
    assert next(r._line for r in rejects if r._line.startswith("6,")) == "6,2024-01-01,3,1.5,x,y"
    assert any('"price":"cheap"' in r._line for r in rejects)


def test_too_many_rejects_stop_after_they_are_stored(spark, tmp_path):
    path = extract(tmp_path / "in", [HEADER, *GOOD, *BAD])
    with pytest.raises(TooManyRejects, match="8 of 11 lines are malformed: id: not bigint \\(2\\); number of fields \\(2\\)"):
        land(spark, path, str(tmp_path / "out"), SCHEMA, required=["day"], max_rejected=0.7)
    assert read_table(spark, f"{tmp_path}/out_rejected").count() == 8


def test_the_text_is_scanned_once(spark, tmp_path, monkeypatch):
    path = extract(tmp_path / "in", [HEADER, *GOOD])
    landed = land(spark, path, str(tmp_path / "out"), SCHEMA)
    plan = landed.rows._jdf.queryExecution().executedPlan().toString()
    assert "csv" not in plan.lower().replace(str(tmp_path).lower(), "") and landed.rows_read == 3


def test_odd_extracts(spark, tmp_path):
    empty = extract(tmp_path / "empty", [HEADER])
    landed = land(spark, empty, str(tmp_path / "out1"), SCHEMA)
    assert (landed.rows_read, landed.rows.count(), landed.rejects.count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="no column price"):
        land(spark, extract(tmp_path / "short", ["id,day,the size", "1,2024-01-01,3"]), str(tmp_path / "out2"), SCHEMA)


def kinds(states):
    return {r.column_name: r.kind for r in resolved(states).collect()}


FIRST = ["a;b;c;d;e;f", "1;2024-01-01;x;;1.5;1", "-2147483648;2024-02-29;1;;2;2024-01-01", "+7;;2;;.5e-3;"]
SECOND = ["a;b;c;d;e;g", "2147483648;2024-13-01;3;9223372036854775808;7;", "5;2024-01-01;4;2;8;t"]


def test_types_of_files_that_disagree(spark, tmp_path):
    one = file_states(spark, extract(tmp_path / "one", FIRST), ";")
    two = file_states(spark, extract(tmp_path / "two", SECOND), ";")
    assert kinds(one) == {"a": "int", "b": "date", "c": "text", "d": "empty", "e": "double", "f": "text"}
    assert kinds(two) == {"a": "long", "b": "text", "c": "int", "d": "double", "e": "int", "g": "text"}
    both = merged_states(one, two)
    assert kinds(both) == {"a": "long", "b": "text", "c": "text", "d": "double", "e": "double", "f": "text", "g": "text"}
    changes = {r.column_name: r.change for r in drift(one, two).collect()}
    assert changes == {"a": "wider", "b": "wider", "c": "narrower", "d": "filled", "e": "narrower", "f": "missing", "g": "new"}
    assert {r.change for r in drift(one, one).collect()} == {"same"}
    empty = file_states(spark, extract(tmp_path / "none", [FIRST[0]]), ";")
    assert set(kinds(empty).values()) == {"empty"}
    assert kinds(merged_states(one, empty)) == kinds(one)


def test_an_inferred_schema_reads_the_file_it_came_from(spark, tmp_path):
    path = extract(tmp_path / "one", FIRST)
    schema = inferred_schema(file_states(spark, path, ";"))
    assert schema == "`a` int, `b` date, `c` string, `d` string, `e` double, `f` string"
    rows = read_delimited(spark, path, schema, ";")
    assert sorted(r.a for r in rows.collect()) == [-2147483648, 1, 7]


def test_the_type_of_a_value_is_found_once(spark):
    """Neither once for each type it could be, nor by casts that fail; both took most of the time."""
    text = spark.createDataFrame([("1", "1-URGENT"), ("2147483648", "n/a")], "a string, b string")
    plan = type_states(text)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("yyyy-MM-dd") == len(text.columns)
    assert "as bigint)" not in plan.split("Aggregate")[-1]


def test_types_at_the_edges(spark):
    kinds_of = {
        "int": ["+1", "-2147483648", "2147483647", "0" * 60 + "5"],
        "long": ["2147483648", "-9223372036854775808", "9223372036854775807"],
        "double": ["9223372036854775808", "1" * 400, ".5", "5.", "1e5"],
        "date": ["2020-01-01", "+12020-01-01"],
        "text": [" 5", "1-URGENT", "2020-02-30", "2020-1-1", "1-2-3", "NaN", "-"],
        "empty": ["", None],
    }
    rows = [(kind, value) for kind, values in kinds_of.items() for value in values]
    frame = spark.createDataFrame(rows, "kind string, value string").withColumn("found", least_kind(F.col("value")))
    assert [tuple(r) for r in frame.where("kind <> found").collect()] == []
