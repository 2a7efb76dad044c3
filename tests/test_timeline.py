"""Deliveries in any order against the versions that all of them give in the order of their days."""

from __future__ import annotations

import itertools
import random
from datetime import date

import pytest

from starmill.operators.scd2 import OPEN_END
from starmill.operators.timeline import SEEN, timeline_initial, timeline_merge
from starmill.schemas import DimSpec
from tests.test_scd2 import stored

SPEC = DimSpec("thing_dimension", "thing_key", ("code",), ("name", "size"))
STAGED = "code string, name string, size int"
DAYS = [date(2024, m, 1) for m in range(1, 7)]


def versions(deliveries):
    """(code, name, size, start, end, current, days seen) from {day: {code: (name, size)}}."""
    rows = []
    for code in {c for members in deliveries.values() for c in members}:
        states = []
        for day in sorted(deliveries):
            if code in deliveries[day]:
                state = deliveries[day][code]
                if states and states[-1][0] == state:
                    states[-1][1].append(day)
                else:
                    states.append((state, [day]))
        for n, (state, seen) in enumerate(states):
            end = states[n + 1][1][0] if n + 1 < len(states) else OPEN_END
            rows.append((code, *state, seen[0], end, end == OPEN_END, tuple(seen)))
    return sorted(rows, key=str)


def loaded(spark, deliveries, order):
    dims = []
    for n, day in enumerate(order):
        staged = spark.createDataFrame([(c, *state) for c, state in deliveries[day].items()], STAGED)
        dim = timeline_initial(staged, SPEC, day) if n == 0 else timeline_merge(dims[-1], staged, SPEC, day, stored)
        dims.append(stored(dim))
    return dims


def found(dim):
    columns = ("code", "name", "size", "start_date", "end_date", "current_flag")
    return sorted(((*(r[c] for c in columns), tuple(r[SEEN])) for r in dim.collect()), key=str)


def test_every_order_of_three_deliveries_gives_the_same_versions(spark):
    states = [("x", 1), ("y", 1), ("x", None)]
    # A member for each way to be absent, equal or different on three days.
    told = list(itertools.product([None, *states], repeat=3))
    days = DAYS[:3]
    deliveries = {
        day: {f"m{n}": told[n][k] for n in range(len(told)) if told[n][k] is not None} for k, day in enumerate(days)
    }
    want = versions(deliveries)
    for order in itertools.permutations(days):
        dims = loaded(spark, deliveries, order)
        assert found(dims[-1]) == want
        keys = [r.thing_key for r in dims[-1].collect()]
        assert len(set(keys)) == len(keys) and None not in keys


@pytest.mark.parametrize("seed", range(3))
def test_random_deliveries_keys_keep_their_state(spark, seed):
    r = random.Random(seed)
    deliveries = {day: {f"m{n}": (r.choice("xyz"), r.choice([1, None])) for n in range(25) if r.random() < 0.7} for day in DAYS}
    order = r.sample(DAYS, len(DAYS))
    dims = loaded(spark, deliveries, order)
    assert found(dims[-1]) == versions(deliveries)
    state = {}
    for dim in dims:
        for row in dim.collect():
            told = (row.code, row.name, row.size)
            assert state.setdefault(row.thing_key, told) == told  # a key never stands for another state


def test_the_same_delivery_again_changes_nothing_and_another_of_the_day_fails(spark):
    deliveries = {DAYS[0]: {"a": ("x", 1)}, DAYS[2]: {"a": ("y", 1), "b": ("x", None)}}
    dim = loaded(spark, deliveries, [DAYS[2], DAYS[0]])[-1]
    again = spark.createDataFrame([("a", "y", 1), ("b", "x", None)], STAGED)
    assert sorted(map(str, stored(timeline_merge(dim, again, SPEC, DAYS[2])).collect())) == sorted(map(str, dim.collect()))
    with pytest.raises(Exception, match="two deliveries of 2024-03-01 disagree"):
        timeline_merge(dim, spark.createDataFrame([("a", "z", 1)], STAGED), SPEC, DAYS[2]).collect()


def test_empty_sides(spark):
    nothing = spark.createDataFrame([], STAGED)
    empty = stored(timeline_initial(nothing, SPEC, DAYS[1]))
    assert empty.count() == 0
    one = spark.createDataFrame([("a", "x", 1)], STAGED)
    dim = stored(timeline_merge(empty, one, SPEC, DAYS[1]))
    assert found(dim) == [("a", "x", 1, DAYS[1], OPEN_END, True, (DAYS[1],))]
    assert found(timeline_merge(dim, nothing, SPEC, DAYS[0])) == found(dim)


def test_days_before_the_horizon_are_forgotten(spark):
    deliveries = {day: {"a": ("x", 1), "b": ("y", n)} for n, day in enumerate(DAYS[:4])}
    dim = loaded(spark, deliveries, DAYS[:4])[-1]
    late = spark.createDataFrame([("a", "z", 1)], STAGED)
    merged = stored(timeline_merge(dim, late, SPEC, date(2024, 3, 15), stored, horizon=DAYS[2]))
    told = [r for r in found(merged) if r[0] == "a"]
    assert [(r[1], r[3], r[4], r[6]) for r in told] == [
        ("x", DAYS[0], date(2024, 3, 15), (DAYS[0], DAYS[2])),
        ("x", DAYS[3], OPEN_END, (DAYS[3],)),
        ("z", date(2024, 3, 15), DAYS[3], (date(2024, 3, 15),)),
    ]
    with pytest.raises(ValueError, match="older than 2024-03-01"):
        timeline_merge(dim, late, SPEC, DAYS[1], horizon=DAYS[2])
