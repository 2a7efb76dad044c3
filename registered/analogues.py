"""The provided tables seen as flight data.

A line item is a flight, a supplier an airline, a nation an airport, a region a world area, a part an
aircraft, and a part's brand the maker of its engine.  Whole tables are used throughout.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmill.operators.calendar import date_dimension, date_span, monthly_dimension, time_dimension
from starmill.operators.lookups import BROADCAST_BYTES, hot_keys, lookup, measured_bytes
from starmill.plans.facts import Dimensions
from starmill.plans.staging import stage_airline, stage_airport, stage_plane
from starmill.plans.warehouse import load_dimension
from starmill.schemas import AIRLINE, AIRPORT, PLANE, DimSpec
from starmill.sources import replace_table, scratch_root, spread, write_table

HOLIDAYS = ((1, 1), (7, 4), (12, 25))
FORMER_LOAD, LOAD_DATE = date(2023, 1, 1), date(2024, 1, 1)


@lru_cache
def _schema(file: str) -> StructType:
    return SparkSession.getActiveSession().read.parquet(file).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    file = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(file)).parquet(file)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _routes(spark: SparkSession, sf_dir: str, columns: Collection[str]) -> DataFrame:
    """Line items with, where asked for, their order and the nations of customer and supplier.

    ``columns`` names the columns of the four tables that are needed.  Customers are joined to the orders
    before the orders are joined to the much longer line items.
    """
    of_order = [c for c in ("o_orderdate", "o_orderpriority", "c_nationkey") if c in columns]
    of_supplier = [c for c in ("s_nationkey",) if c in columns]
    keys = {"orders": "l_orderkey"} if of_order else {}
    keys |= {"supplier": "l_suppkey"} if of_supplier else {}
    own = set(columns) - {*of_order, *of_supplier} | set(keys.values())
    rows = spread(table(spark, sf_dir, "lineitem").select(*sorted(own)), *(keys.values() or sorted(own)))

    from_orders = ["o_custkey" if c == "c_nationkey" else c for c in of_order]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *from_orders)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    used = {"orders": orders} if of_order else {}
    used |= {"customer": customers} if "c_nationkey" in of_order else {}
    used |= {"supplier": suppliers} if of_supplier else {}
    sizes = dict(zip(used, measured_bytes(*used.values()), strict=True))
    hot = hot_keys(rows, {name: [key] for name, key in keys.items() if sizes[name] > BROADCAST_BYTES})

    if "customer" in used:
        nation = {"c_nationkey": "c_nationkey"}
        orders = lookup(orders, customers, {"o_custkey": "c_custkey"}, nation, table_bytes=sizes["customer"])
    for name, right, key, wanted in (
        ("orders", orders, "o_orderkey", of_order),
        ("supplier", suppliers, "s_suppkey", of_supplier),
    ):
        if name in keys:
            take, size = {c: c for c in wanted}, sizes[name]
            rows = lookup(rows, right, {keys[name]: key}, take, table_bytes=size, hot=hot.get(name))
    return rows


def flights(spark: SparkSession, sf_dir: str, columns: Collection[str] | None = None) -> DataFrame:
    """Line items as flights; with ``columns`` only what these need is read and joined."""
    cancelled, diverted = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    price = F.floor("l_extendedprice")
    # Flight column: its value, and the table columns this is made of.
    values = {
        "l_orderkey": (F.col("l_orderkey"), "l_orderkey"),
        "l_linenumber": (F.col("l_linenumber"), "l_linenumber"),
        "FlightDate": (F.to_date("o_orderdate"), "o_orderdate"),
        "Carrier": (_text("l_suppkey"), "l_suppkey"),
        "TailNum": (_text("l_partkey"), "l_partkey"),
        "OriginAirportID": (_text("c_nationkey"), "c_nationkey"),
        "OriginState": (F.concat(F.lit("S"), _text("c_nationkey")), "c_nationkey"),
        "OriginStateName": (F.concat(F.lit("State "), _text("c_nationkey")), "c_nationkey"),
        "OriginWac": (F.pmod("c_nationkey", F.lit(5)) + 1, "c_nationkey"),
        "DestAirportID": (_text("s_nationkey"), "s_nationkey"),
        "CRSDepTime": (F.pmod(price, F.lit(2401)).cast("int"), "l_extendedprice"),
        "DepTime": (
            F.when(~cancelled, F.pmod(price * 7, F.lit(2460)).cast("double")),
            "l_extendedprice l_returnflag",
        ),
        "Cancelled": (cancelled.cast("double"), "l_returnflag"),
        "CancellationCode": (F.when(cancelled, F.col("o_orderpriority")), "o_orderpriority l_returnflag"),
        "Diverted": (diverted.cast("double"), "l_linestatus"),
        "AirTime": (F.col("l_quantity") * 10, "l_quantity"),
        "WeatherDelay": (F.col("l_quantity"), "l_quantity"),
        "NASDelay": (F.round(F.col("l_discount") * 100), "l_discount"),
        "SecurityDelay": (
            F.when(F.col("l_returnflag") != "N", F.round(F.col("l_tax") * 100)),
            "l_returnflag l_tax",
        ),
        "LateAircraftDelay": (F.col("l_linenumber").cast("double"), "l_linenumber"),
        "TaxiIn": (F.col("l_linenumber").cast("double"), "l_linenumber"),
        "TaxiOut": ((F.col("l_linenumber") * 2).cast("double"), "l_linenumber"),
        "Div1AirportID": (F.when(diverted, _text("c_nationkey")), "l_linestatus c_nationkey"),
        "Div1TailNum": (F.when(diverted, _text("l_partkey")), "l_linestatus l_partkey"),
        "Div2AirportID": (
            F.when(diverted & cancelled, _text("l_linenumber")),
            "l_linestatus l_returnflag l_linenumber",
        ),
        "Div2TailNum": (
            F.when(diverted & cancelled, _text("l_orderkey")),
            "l_linestatus l_returnflag l_orderkey",
        ),
    }
    names = [name for name in values if columns is None or name in columns]
    needed = {c for name in names for c in values[name][1].split()}
    return _routes(spark, sf_dir, needed).select(*[values[name][0].alias(name) for name in names])


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("Code"), F.col("s_name").alias("Description")
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.concat("n_name", F.lit(", R"), _text("n_regionkey"), F.lit(": "), "n_name", F.lit(" Field, North"))
    return table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("Code"), place.alias("Description"))


def wac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).alias("world_area_code"), F.col("r_name").alias("country")
    )


def staged_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = flights(spark, sf_dir, ["OriginAirportID", "OriginState", "OriginStateName", "OriginWac"])
    return stage_airport(airports(spark, sf_dir), seen, wac(spark, sf_dir))


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", "#([0-9]+)", 1).cast("int")


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("N-Number"),
        F.col("p_name").alias("Serial Number"),
        F.col("p_type").alias("Name"),
        F.col("p_brand").alias("MFR MDL Code"),
        (F.lit(1950) + F.nullif("p_size", F.lit(1))).alias("Year MFR"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("City"),
        F.col("p_brand").alias("State"),
        F.col("p_name").alias("Street 1"),
        _brand_number().alias("Eng MFR Code"),
    )


def engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_brand = table(spark, sf_dir, "part").groupBy("p_brand").agg((F.max("p_size") * 10).alias("horsepower"))
    return per_brand.select(
        _brand_number().alias("Eng MFR Code"),
        F.concat(F.lit("Maker "), "p_brand").alias("eng mfr name"),
        F.col("p_brand").alias("engine model name"),
        "horsepower",
    )


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["l_suppkey", "l_quantity", "l_linenumber", "c_nationkey", "s_nationkey", "o_orderdate"]
    return _routes(spark, sf_dir, needed).select(
        _text("l_suppkey").alias("carrier"),
        _text("c_nationkey").alias("origin_airport_id"),
        _text("s_nationkey").alias("dest_airport_id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        (F.col("l_quantity") * F.col("l_linenumber")).alias("freight"),
        F.col("l_quantity").alias("passengers"),
        F.col("l_linenumber").cast("double").alias("mail"),
    )


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension(date_span(table(spark, sf_dir, "orders"), "o_orderdate"), HOLIDAYS)


# Dimension: the attribute that changed since the load before, for members whose number this divides.
CHANGED = {AIRLINE: ("airline_name", 7), AIRPORT: ("city", 3), PLANE: ("registrant_city", 5)}


def _former(staged: DataFrame, spec: DimSpec) -> DataFrame:
    """The same members as they were before: some of them under another description."""
    attribute, divisor = CHANGED[spec]
    changed = F.pmod(F.col(spec.natural_key[0]).cast("int"), F.lit(divisor)) == 0
    return staged.withColumn(attribute, F.when(changed, F.lit("former")).otherwise(F.col(attribute)))


_staged: dict[tuple[str, str], dict[DimSpec, DataFrame]] = {}


def staged_dimensions(spark: SparkSession, sf_dir: str) -> dict[DimSpec, DataFrame]:
    """The staged deliveries, stored once per application: every load reads them several times, and airports come from all flights."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _staged:
        rows = {
            AIRLINE: stage_airline(airlines(spark, sf_dir)),
            AIRPORT: staged_airports(spark, sf_dir),
            PLANE: stage_plane(planes(spark, sf_dir), engines(spark, sf_dir)),
        }
        _staged[known] = {spec: stored(frame) for spec, frame in rows.items()}
    return _staged[known]


_presentation: dict[tuple[str, str], Dimensions] = {}


def presentation(spark: SparkSession, sf_dir: str) -> Dimensions:
    """The dimensions as the fact loads find them: stored after two loads, closed versions included; once per application."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _presentation:
        root = scratch_root(spark)
        staged = staged_dimensions(spark, sf_dir)
        for spec, rows in staged.items():
            load_dimension(spark, f"{root}/{spec.name}", _former(rows, spec), spec, FORMER_LOAD)
        loaded = {s: load_dimension(spark, f"{root}/{s.name}", rows, s, LOAD_DATE) for s, rows in staged.items()}
        days = replace_table(dates(spark, sf_dir), f"{root}/date_dimension")
        _presentation[known] = Dimensions(
            airline=loaded[AIRLINE],
            airport=loaded[AIRPORT],
            plane=loaded[PLANE],
            date=days,
            time=replace_table(time_dimension(spark), f"{root}/time_dimension"),
            month=replace_table(monthly_dimension(days), f"{root}/monthly_dimension"),
        ).measured()
    return _presentation[known]


# Three loads within the days of the flights; a member that changes says something else at each.
HISTORY = (date(1995, 7, 1), date(1997, 3, 1), date(1999, 9, 1))


def history(spark: SparkSession, sf_dir: str) -> Dimensions:
    """Airlines, airports and planes as three loads left them while flights went on, with the calendars."""
    root, present = scratch_root(spark), presentation(spark, sf_dir)
    staged = staged_dimensions(spark, sf_dir)
    loaded = {}
    for spec, rows in staged.items():
        attribute, divisor = CHANGED[spec]
        changed = F.pmod(F.col(spec.natural_key[0]).cast("int"), F.lit(divisor)) == 0
        for number, day in enumerate(HISTORY):
            told = F.when(changed, F.lit(f"load {number}")).otherwise(F.col(attribute))
            loaded[spec] = load_dimension(spark, f"{root}/{spec.name}", rows.withColumn(attribute, told), spec, day)
    return Dimensions(loaded[AIRLINE], loaded[AIRPORT], loaded[PLANE], present.date, present.time, present.month)


# Customers as a dimension with history: what their latest order of a delivery period says about them.
BUYER = DimSpec("buyer_dimension", "buyer_key", ("c_custkey",), ("last_status", "last_priority"))
# The last delivery has no end: together the deliveries hold every order.
LOADS = (date(1996, 5, 1), date(1997, 6, 1), date(2002, 1, 1))


def delivery(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """Customers who ordered from the load before this one on; status P counts as unknown."""
    day = F.col("o_orderdate").cast("date")
    ordered = table(spark, sf_dir, "orders")
    if number:
        ordered = ordered.where(day >= F.lit(LOADS[number - 1]))
    if number < len(LOADS) - 1:
        ordered = ordered.where(day < F.lit(LOADS[number]))
    latest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")).alias("latest")
    return (
        ordered.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(latest)
        .select(
            "c_custkey",
            F.nullif("latest.o_orderstatus", F.lit("P")).alias("last_status"),
            F.col("latest.o_orderpriority").alias("last_priority"),
        )
    )


def stored(df: DataFrame) -> DataFrame:
    """Written to a folder of its own and read back."""
    path = scratch_root(df.sparkSession)
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


_buyers: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def buyers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stored dimension after two loads, closed versions included, and the third delivery, staged."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _buyers:
        root = scratch_root(spark)
        for number in (0, 1):
            dim = load_dimension(spark, root, delivery(spark, sf_dir, number), BUYER, LOADS[number])
        _buyers[known] = (dim, stored(delivery(spark, sf_dir, 2)))
    return _buyers[known]
