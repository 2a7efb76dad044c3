from __future__ import annotations

import random
from datetime import date

import pytest

from starmill.operators import scd2
from starmill.schemas import DimSpec
from starmill.sources import scratch_root

SPEC = DimSpec("thing_dimension", "thing_key", ("code",), ("name", "size"))
STAGED = "code string, name string, size int"
D1, D2, D3, D4 = (date(2024, m, 1) for m in (1, 2, 3, 4))
OPEN = scd2.OPEN_END


def staged(spark, *members):
    return spark.createDataFrame(list(members), STAGED)


def versions(dim):
    got = [(r.code, r.name, r.size, r.start_date, r.end_date, r.current_flag) for r in dim.collect()]
    return sorted(got, key=lambda v: (v[0], v[3]))


def stored(df):
    path = scratch_root(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_initial_load(spark):
    dim = scd2.scd2_initial(staged(spark, ("a", "x", 1), ("b", None, None)), SPEC, D1)
    assert dim.columns == SPEC.columns
    assert versions(dim) == [
        ("a", "x", 1, D1, OPEN, True),
        ("b", None, None, D1, OPEN, True),
    ]
    assert sorted(r.thing_key for r in dim.collect()) == [1, 2]


def test_each_kind_of_member(spark):
    dim = scd2.scd2_initial(
        staged(spark, ("same", "x", 1), ("null", "x", None), ("gone", "x", 1), ("new_name", "x", 1), ("filled", "x", None)),
        SPEC,
        D1,
    )
    delivery = staged(
        spark, ("same", "x", 1), ("null", "x", None), ("new_name", "y", 1), ("filled", "x", 3), ("added", "z", 1)
    )
    merged = scd2.scd2_merge(dim, delivery, SPEC, D2)
    assert versions(merged) == [
        ("added", "z", 1, D2, OPEN, True),
        ("filled", "x", None, D1, D2, False),
        ("filled", "x", 3, D2, OPEN, True),
        ("gone", "x", 1, D1, OPEN, True),
        ("new_name", "x", 1, D1, D2, False),
        ("new_name", "y", 1, D2, OPEN, True),
        ("null", "x", None, D1, OPEN, True),
        ("same", "x", 1, D1, OPEN, True),
    ]
    keys = [r.thing_key for r in merged.collect()]
    assert sorted(keys) == list(range(1, 9))
    assert {r.code for r in scd2.new_members(dim, delivery, SPEC).collect()} == {"added"}
    assert {r.code for r in scd2.changed_members(dim, delivery, SPEC).collect()} == {"new_name", "filled"}
    assert {r.code for r in scd2.existing_members(dim, delivery, SPEC).collect()} == {
        "same",
        "null",
        "new_name",
        "filled",
    }


def test_steps_add_up_to_the_merge(spark, rows):
    dim = stored(scd2.scd2_initial(staged(spark, ("a", "x", 1), ("b", "x", 1), ("c", "x", 1)), SPEC, D1))
    dim = stored(scd2.scd2_merge(dim, staged(spark, ("a", "y", 1)), SPEC, D2))
    delivery = staged(spark, ("a", "z", 1), ("b", "x", 1), ("d", "x", 1))
    merged = scd2.scd2_merge(dim, delivery, SPEC, D3)
    old = scd2.untouched_rows(dim, delivery, SPEC).unionByName(scd2.closed_rows(dim, delivery, SPEC, D3))
    old_keys = [r.thing_key for r in old.collect()]
    assert rows(old) == rows(merged.where(merged.thing_key.isin(old_keys)))
    opened = merged.where(~merged.thing_key.isin(old_keys))
    delta = scd2.new_members(dim, delivery, SPEC).unionByName(scd2.changed_members(dim, delivery, SPEC))
    assert rows(opened, *delta.columns) == rows(delta)


def test_back_and_forth_makes_three_versions(spark):
    dim = scd2.scd2_initial(staged(spark, ("a", "A", 1)), SPEC, D1)
    dim = stored(scd2.scd2_merge(dim, staged(spark, ("a", "B", 1)), SPEC, D2))
    dim = stored(scd2.scd2_merge(dim, staged(spark, ("a", "A", 1)), SPEC, D3))
    assert sorted((r.start_date, r.end_date, r.name, r.current_flag) for r in dim.collect()) == [
        (D1, D2, "A", False),
        (D2, D3, "B", False),
        (D3, OPEN, "A", True),
    ]


def test_repeated_load_changes_nothing(spark, rows):
    delivery = staged(spark, ("a", "x", None), ("b", "y", 2))
    dim = stored(scd2.scd2_initial(delivery, SPEC, D1))
    assert rows(scd2.scd2_merge(dim, delivery, SPEC, D2)) == rows(dim)


def test_always_versions_what_is_delivered_and_only_that(spark):
    dim = stored(scd2.scd2_initial(staged(spark, ("a", "x", 1), ("b", "x", 1)), SPEC, D1))
    dim = stored(scd2.scd2_merge(dim, staged(spark, ("a", "x", 1)), SPEC, D2, change="always"))
    dim = stored(scd2.scd2_merge(dim, staged(spark, ("a", "x", 1)), SPEC, D3, change="always"))
    assert sorted((r.code, r.start_date, r.end_date) for r in dim.collect()) == [
        ("a", D1, D2),
        ("a", D2, D3),
        ("a", D3, OPEN),
        ("b", D1, OPEN),
    ]


def test_empty_sides(spark, rows):
    nothing = staged(spark)
    dim = stored(scd2.scd2_initial(staged(spark, ("a", "x", 1)), SPEC, D1))
    assert rows(scd2.scd2_merge(dim, nothing, SPEC, D2)) == rows(dim)
    empty = stored(scd2.scd2_initial(nothing, SPEC, D1))
    assert [r.thing_key for r in scd2.scd2_merge(empty, staged(spark, ("a", "x", 1)), SPEC, D2).collect()] == [1]


def test_duplicates_in_a_delivery_give_one_member(spark):
    delivery = staged(spark, *[("a", "x", 1)] * 500, ("a", "b", 2), ("a", None, 9))
    assert [(r.name, r.size) for r in scd2.scd2_initial(delivery, SPEC, D1).collect()] == [(None, 9)]


def test_missing_natural_key_stops_the_load(spark):
    delivery = staged(spark, (None, "x", 1), ("a", "x", 1))
    dim = scd2.scd2_initial(staged(spark, ("a", "x", 2)), SPEC, D1)
    with pytest.raises(Exception, match="NULL in the natural key"):
        scd2.scd2_initial(delivery, SPEC, D1).collect()
    with pytest.raises(Exception, match="NULL in the natural key"):
        scd2.scd2_merge(stored(dim), delivery, SPEC, D2).collect()


def test_unknown_change_mode(spark):
    dim = scd2.scd2_initial(staged(spark, ("a", "x", 1)), SPEC, D1)
    with pytest.raises(ValueError, match="change must be"):
        scd2.scd2_merge(dim, staged(spark, ("a", "x", 1)), SPEC, D2, change="sometimes")


@pytest.mark.parametrize("change", scd2.CHANGE_MODES)
def test_random_loads_against_a_plain_model(spark, change):
    rng = random.Random(7)
    history: list[list] = []
    dim = None
    for day in (D1, D2, D3, D4):
        delivery = {
            f"m{i}": (rng.choice([None, "p", "q"]), rng.choice([None, 1, 2])) for i in rng.sample(range(60), 35)
        }
        for code, attributes in sorted(delivery.items()):
            last = next((v for v in history if v[0] == code and v[4] == OPEN), None)
            if last is not None and change == "attributes" and tuple(last[1:3]) == attributes:
                continue
            if last is not None:
                last[4] = day
            history.append([code, *attributes, day, OPEN])
        frame = staged(spark, *[(c, *a) for c, a in delivery.items()])
        loaded = scd2.scd2_initial(frame, SPEC, day) if dim is None else scd2.scd2_merge(dim, frame, SPEC, day, change, stored)
        dim = stored(loaded)
    got = [(r.code, r.name, r.size, r.start_date, r.end_date) for r in dim.collect()]
    assert sorted(got, key=str) == sorted(map(tuple, history), key=str)
    assert sorted(r.thing_key for r in dim.collect()) == list(range(1, len(history) + 1))
    assert all(r.current_flag == (r.end_date == OPEN) for r in dim.collect())


def test_registered_deliveries_hold_every_order(spark):
    from registered import analogues

    sf_dir = "/root/testdata/sf0.001"
    buyers = {r["o_custkey"] for r in analogues.table(spark, sf_dir, "orders").select("o_custkey").collect()}
    delivered = [analogues.delivery(spark, sf_dir, n).collect() for n in range(len(analogues.LOADS))]
    assert {r["c_custkey"] for part in delivered for r in part} == buyers
    last = analogues.table(spark, sf_dir, "orders").agg({"o_orderdate": "max"}).first()[0].date()
    assert last < analogues.LOADS[-1]


def test_first_load_reads_the_delivery_once(spark, tmp_path):
    spec = DimSpec("d", "d_key", ("code",), ("name",))
    path = str(tmp_path / "delivery")
    spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "y")], "code string, name string").write.parquet(path)
    plans = []

    def store(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        df.write.parquet(str(tmp_path / "members"))
        return spark.read.parquet(str(tmp_path / "members"))

    loaded = scd2.scd2_initial(spark.read.parquet(path), spec, date(2024, 1, 1), store)
    assert sorted((r.code, r.name) for r in loaded.collect()) == [("a", None), ("b", "y")]
    (plan,) = plans
    final = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert final.count("FileScan") == 1
    # Copies are hashed away below whatever sorts.
    assert final.rindex("SortAggregate") < final.rindex("HashAggregate") < final.rindex("FileScan")
    assert "delivery" not in loaded._jdf.queryExecution().executedPlan().toString()
