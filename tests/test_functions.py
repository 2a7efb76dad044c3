from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.functions.clock import hhmm_hour, hhmm_minute, hhmm_second, seconds_of_day
from starmill.functions.measures import total_delay
from starmill.functions.text import fill_undefined, lower_columns, parse_place

CLOCK = [
    (None, None),
    (0, (0, 0)),
    (5, (0, 5)),
    (15, (0, 15)),
    (24, (0, 24)),
    (45, (0, 45)),
    (805, (8, 5)),
    (830, (8, 30)),
    (845, (8, 45)),
    (1230, (12, 30)),
    (2359, (23, 59)),
    (2400, (0, 0)),
    (60, None),
    (1275, None),
    (2401, None),
    (2430, None),
    (-5, None),
    (9999, None),
]


def test_clock_values(spark):
    df = spark.createDataFrame([(v,) for v, _ in CLOCK], "hhmm int")
    t = F.col("hhmm")
    got = {
        r.hhmm: None if r.h is None and r.m is None and r.s is None else (r.h, r.m)
        for r in df.select("hhmm", hhmm_hour(t).alias("h"), hhmm_minute(t).alias("m"), hhmm_second(t).alias("s")).collect()
    }
    assert got == dict(CLOCK)


def test_seconds_of_day(spark):
    df = spark.createDataFrame([(23, 59, 59), (0, 0, 1)], "h int, m int, s int")
    got = [r[0] for r in df.select(seconds_of_day(F.col("h"), F.col("m"), F.col("s"))).collect()]
    assert got == [86399, 1]


@pytest.mark.parametrize(
    ("text", "city", "name"),
    [
        ("Adak, AK: Adak Airport", "Adak", "Adak Airport"),
        ("X, AK: A, B", "X", "A, B"),
        ("No comma here", "No comma here", None),
        ("Y, AK: A: B", "Y", "A: B"),
        ("Z, AK", "Z", None),
        (None, None, None),
    ],
)
def test_place_text(spark, text, city, name):
    df = parse_place(spark.createDataFrame([(text,)], "d string"), "d")
    assert tuple(df.select("city", "place_name").first()) == (city, name)


def test_fill_touches_text_only(spark):
    df = fill_undefined(spark.createDataFrame([(None, None), ("a", 1)], "t string, n int"))
    assert [tuple(r) for r in df.collect()] == [("undefined", None), ("a", 1)]


def test_lower_touches_named_columns_only(spark):
    df = lower_columns(spark.createDataFrame([("AB", "CD", None)], "a string, b string, c string"), ["a", "c"])
    assert tuple(df.first()) == ("ab", "CD", None)


def test_total_delay_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (1.0, None, 3.0, 4.0)], "a double, b double, c double, d double")
    assert [r[0] for r in df.select(total_delay("a", "b", "c", F.col("d"))).collect()] == [10.0, None]
