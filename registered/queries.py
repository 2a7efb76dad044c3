"""One query per operator.  Each takes the session and the directory of the tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.clock import hhmm_hour, hhmm_minute, hhmm_second
from starmill.functions.measures import DELAY_PARTS, total_delay
from starmill.functions.text import fill_undefined, lower_columns, parse_place
from starmill.operators import scd2
from starmill.operators.audit import load_audit, profile_table
from starmill.operators.calendar import (
    date_dimension,
    date_span,
    extended_span,
    holiday_calendar,
    keep_keys,
    literal_span,
    monthly_dimension,
    time_dimension,
)
from starmill.operators.corrections import DELIVERED, IDENTITY, identity, merge_fact
from starmill.operators.digests import scd2_merge_changed
from starmill.operators.keys import dense_key, next_key
from starmill.operators.lookups import current, lookup
from starmill.operators.sketches import merged_profiles, profile_report, profile_states
from starmill.operators.timeline import SEEN, timeline_initial, timeline_merge
from starmill.plans import dashboards, facts, staging
from starmill.plans.kept_up import keep_up, kept_dashboard
from starmill.sources import (
    file_states,
    land,
    read_delimited,
    read_table,
    replace_table,
    resolved,
    scratch_root,
    spread,
    write_delimited,
    write_table,
)

from .analogues import (
    BUYER,
    HOLIDAYS,
    LOADS,
    airlines,
    buyers,
    dates,
    delivery,
    engines,
    flights,
    history,
    passengers,
    planes,
    presentation,
    staged_airports,
    stored,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

SECOND_DELIVERY = date(1998, 6, 1)


# Sources and sinks


def source_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_root(spark)
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    write_delimited(orders, path, sep=";")
    schema = (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, "
        "o_orderpriority string"
    )
    return read_delimited(spark, path, schema, sep=";")


def source_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commas, quotes and NULLs in comma-separated text, under a header in another order than the schema."""
    path = scratch_root(spark)
    told = F.concat(F.lit('of "'), "p_brand", F.lit('", '), "p_type", F.lit(", size "), F.col("p_size").cast("string"))
    parts = table(spark, sf_dir, "part").select(
        told.alias("told"),
        "p_partkey",
        F.nullif("p_size", F.lit(1)).alias("p_size"),
        F.when(F.col("p_size") > 2, F.col("p_retailprice")).alias("price"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("p_type"),
    )
    write_delimited(parts, path)
    return read_delimited(spark, path, "p_partkey long, told string, p_size int, price double, p_type string")


def reject_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a delivery with fields of another type, fields too many and missing ones: each with its reason, if any."""
    path, number = scratch_root(spark), F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    sent = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(number % 50 != 4, F.col("o_custkey")).alias("o_custkey"),
        F.when(number % 50 == 1, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(number % 50 == 2, F.lit("1996-13-45")).otherwise(day).alias("o_orderdate"),
        F.when(number % 50 == 3, F.lit("one,two")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    sent.write.options(sep=",", header=True, quote="").csv(path)
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string"
    landed = land(spark, path, scratch_root(spark), schema, required=["o_custkey"], max_rejected=0.2)
    if landed.rows.count() + landed.rejects.count() != landed.rows_read:
        raise AssertionError("good and rejected rows do not add up to the lines read")
    key = F.coalesce(F.get_json_object("_line", "$.o_orderkey"), F.split("_line", ",")[0]).cast("long")
    rejects = landed.rejects.select(key.alias("o_orderkey"), F.col("_reject_reason").alias("reason"))
    good = landed.rows.withColumn("reason", F.lit(None).cast("string"))
    return good.unionByName(rejects, allowMissingColumns=True)


def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the values of delimited tables are: counts of each least type and the type that holds them all."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderdate": F.to_date("o_orderdate"),
            "mixed": F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")),
            "wide": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") * 3000000000),
            "number": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(
                F.col("o_totalprice").cast("string")
            ),
            "void": F.lit(None).cast("string"),
        }
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    states = []
    for name, rows in (("orders", orders), ("lineitem", lines)):
        path = scratch_root(spark)
        write_delimited(rows, path, sep=";")
        states.append(resolved(file_states(spark, path, ";")).withColumn("table_name", F.lit(name)))
    return states[0].unionByName(states[1])


def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_root(spark)
    write_table(table(spark, sf_dir, "customer"), path)
    return spark.read.parquet(path)


def sink_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by something computed from itself."""
    root = scratch_root(spark)
    replace_table(table(spark, sf_dir, "customer"), root)
    replace_table(read_table(spark, root).withColumn("c_acctbal", F.col("c_acctbal") * 2), root)
    return read_table(spark, root)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the line items beside those of another delivery, in which P counts as no status."""
    orders = table(spark, sf_dir, "orders").withColumn("o_status", F.nullif("o_orderstatus", F.lit("P")))
    return load_audit(table(spark, sf_dir, "lineitem"), "l_orderkey", orders, "o_status")


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return profile_table(lines).withColumn("mean_value", F.round("mean_value", 4))


def profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in two deliveries, each profiled once; the profile of both comes from the stored states alone."""
    lines = table(spark, sf_dir, "lineitem")
    first = F.col("l_orderkey") % 3 == 0
    states = [stored(profile_states(lines.where(part))) for part in (first, ~first)]
    report = profile_report(merged_profiles(*states))
    quartiles = [F.get("quantiles", F.lit(n)).alias(f"quartile_{n + 1}") for n in range(3)]
    # The list is empty where no value is surely frequent, as in a column of very many different values.
    most = F.get("frequent", F.lit(0))
    most = [most["item"].alias("most_frequent"), most["count"].alias("most_frequent_count")]
    return report.select("*", *quartiles, *most).drop("quantiles", "frequent")


# Projection, filter, scalar functions


def fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return fill_undefined(
        part.select(
            "p_partkey",
            F.nullif("p_type", F.lit("ECONOMY")).alias("p_type"),
            F.nullif("p_size", F.lit(1)).alias("p_size"),
        )
    )


def lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return lower_columns(part, ["p_brand", "p_type"])


def place(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.concat(F.lit(", N"), F.col("s_nationkey").cast("string"), F.lit(": Port, gate: "), "s_name")
    described = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_nationkey") == 3, F.col("s_name")).otherwise(F.concat("s_name", tail)).alias("description"),
    )
    return parse_place(described, "description").select("s_suppkey", "city", "place_name")


def _departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    hhmm = (F.hour("ts") * 100 + F.minute("ts")).alias("hhmm")
    return table(spark, sf_dir, "events").select("event_id", hhmm)


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    hhmm = F.col("hhmm")
    return _departures(spark, sf_dir).select(
        "event_id",
        "hhmm",
        hhmm_hour(hhmm).alias("hour"),
        hhmm_minute(hhmm).alias("minute"),
        hhmm_second(hhmm).alias("second"),
    )


def time_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = clock(spark, sf_dir)
    times = time_dimension(spark)
    on = {"hour": "hour", "minute": "minute", "second": "second"}
    return lookup(decoded, times, on, {"time_key": "time_key"}).select("event_id", "hhmm", "time_key")


def delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir, ["l_orderkey", "l_linenumber", *DELAY_PARTS])
    return rows.select("l_orderkey", "l_linenumber", *DELAY_PARTS, total_delay(*DELAY_PARTS).alias("total_delay"))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return table(spark, sf_dir, "lineitem").select(*columns).distinct()


# Keys


def free_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_key(table(spark, sf_dir, "orders"), "o_orderkey")


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dense_key(customers, ["c_custkey"], "customer_key")


def surrogate_key_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).scalar()
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dense_key(customers, ["c_custkey"], "customer_key", last)


# Staging


def stage_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_airline(airlines(spark, sf_dir))


def stage_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_airports(spark, sf_dir)


def stage_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_plane(planes(spark, sf_dir), engines(spark, sf_dir))


# Dimensions with history


def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged straight from the orders: many rows, copies and contradictions per customer."""
    delivered = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.nullif("o_orderstatus", F.lit("P")).alias("last_status"),
        F.col("o_orderpriority").alias("last_priority"),
    )
    return scd2.scd2_initial(delivered, BUYER, LOADS[0], stored)


def _of_both(step: Callable[..., DataFrame], *more: object) -> Query:
    """A step of the merge, given the stored dimension and the staged delivery."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim, staged = buyers(spark, sf_dir)
        return step(dim, staged, BUYER, *more)

    return query


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_of_both(scd2.scd2_merge, LOADS[2], "attributes", stored)(spark, sf_dir))


def scd2_late_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three deliveries of customers, the last one loaded first and the first one last."""
    root = scratch_root(spark)
    dim = replace_table(timeline_initial(delivery(spark, sf_dir, 2), BUYER, LOADS[2], stored), root)
    for number in (1, 0):
        dim = replace_table(timeline_merge(dim, delivery(spark, sf_dir, number), BUYER, LOADS[number], stored), root)
    return dim.select(
        "c_custkey", "last_status", "last_priority", "start_date", "end_date", "current_flag", F.size(SEEN).alias("seen")
    )


# Calendars


def calendar_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per day after a generated calendar and a delivered one with gaps, which numbers its days from 1 again."""
    root = scratch_root(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("FlightDate"))
    later = F.col("FlightDate") >= F.lit(date(1998, 1, 1))
    generated = replace_table(date_dimension(date_span(orders.where(~later), "FlightDate")), root)
    facts.date_lookup(orders.where(~later), generated).write.parquet(f"{root}/fact/load=1")
    sent_days = orders.where((F.col("FlightDate") >= F.lit(date(1997, 6, 1))) & (F.dayofmonth("FlightDate") % 3 != 0))
    span = literal_span(spark, date(1997, 6, 1), date(2002, 1, 1))
    sent = date_dimension(span).join(sent_days.select(F.col("FlightDate").alias("date")).distinct(), "date")
    merged = replace_table(keep_keys(sent, generated, "date_key", ["date"]), root)
    facts.date_lookup(orders.where(later), merged).write.parquet(f"{root}/fact/load=2")
    fact = spark.read.parquet(f"{root}/fact").groupBy(F.col("flight_date_key").alias("date_key")).count()
    sharing = merged.groupBy("date_key").agg(F.count("*").alias("days_of_key"))
    days = merged.join(sharing, "date_key").join(fact, "date_key", "left")
    return days.select("date", "days_of_key", F.coalesce("count", F.lit(0)).alias("flights"))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holidays of the years of the orders, by rule, with the orders of each."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("holiday_date"))
    days = holiday_calendar(orders.select(F.year("holiday_date").alias("year")))
    placed = orders.groupBy("holiday_date").agg(F.count("*").alias("orders"))
    joined = days.join(placed, "holiday_date", "left")
    return joined.select("holiday_date", "holiday_name", "is_observed", F.coalesce("orders", F.lit(0)).alias("orders"))


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates(spark, sf_dir)


def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second of the day, with the number of events that fell on it."""
    second_of_day = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).alias("time_key")
    events = table(spark, sf_dir, "events").groupBy(second_of_day).agg(F.count("*").alias("events"))
    joined = time_dimension(spark).join(events, "time_key", "left")
    return joined.withColumn("events", F.coalesce("events", F.lit(0)))


def monthly_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_dimension(dates(spark, sf_dir))


# Facts


def fact_date_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per day of a calendar that is shorter than the data: days outside are lost."""
    calendar = date_dimension(literal_span(spark, date(1996, 1, 1), date(2000, 12, 31)), HOLIDAYS)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("FlightDate"))
    return facts.date_lookup(orders, calendar).groupBy("flight_date_key").agg(F.count("*").alias("flights"))


def role_playing_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = presentation(spark, sf_dir)
    columns = ["origin_airport_key", "dest_airport_key", "div1_airport_key", "div2_airport_key", "air_time"]
    return facts.daily_fact(
        flights(spark, sf_dir, facts.flight_columns(columns)), dims, columns, store=stored
    )


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir, facts.flight_columns())
    return facts.daily_fact(rows, presentation(spark, sf_dir), store=stored)


def two_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights per day of a stored fact after two deliveries, the later months first; together they hold all flights."""
    dims, root = presentation(spark, sf_dir), scratch_root(spark)
    columns = ["flight_date_key", "airline_key", "air_time"]
    rows = flights(spark, sf_dir, facts.flight_columns(columns))
    later = F.col("FlightDate") >= F.lit(SECOND_DELIVERY)
    stored_dates = None
    for part in (rows.where(later), rows.where(~later)):
        days = date_dimension(extended_span([date_span(part, "FlightDate")], stored_dates), HOLIDAYS)
        stored_dates = replace_table(days, f"{root}/dates")
        loaded = facts.daily_fact(part, replace(dims, date=stored_dates).measured(), columns)
        month = (F.col("calendar_year") * 12 + F.col("calendar_month")).alias("month")
        months = stored_dates.select(F.col("date_key").alias("flight_date_key"), month)
        write_table(loaded.join(months, "flight_date_key"), f"{root}/fact", ["month"], keep_others=True)
    fact = spark.read.schema(f"{facts.fact_schema(columns)}, month int").parquet(f"{root}/fact")
    per_day = fact.groupBy("flight_date_key").agg(
        F.count("*").alias("flights"), F.count("airline_key").alias("with_airline"), F.sum("air_time").alias("air_time")
    )
    named = per_day.join(stored_dates.select(F.col("date_key").alias("flight_date_key"), "date"), "flight_date_key")
    return named.select("date", "flights", "with_airline", "air_time")


def point_in_time_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with the versions of their day, of dimensions that changed while flights went on."""
    rows = flights(spark, sf_dir, facts.flight_columns())
    return facts.daily_fact(rows, history(spark, sf_dir), store=stored, point_in_time=True)


def point_in_time_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = history(spark, sf_dir)
    return facts.monthly_fact(passengers(spark, sf_dir), dims, store=stored, point_in_time=True)


def fact_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact after a delivery, a later one with late and corrected flights, and an older one that comes last."""
    wanted = ["l_orderkey", "l_linenumber", "FlightDate", "AirTime"]
    month = F.year("FlightDate") * 12 + F.month("FlightDate")
    rows = stored(flights(spark, sf_dir, wanted).withColumn("month", month))
    rows = rows.withColumn(IDENTITY, identity("l_orderkey", "l_linenumber"))
    number, root = F.col("l_orderkey"), scratch_root(spark)
    first = rows.where(number % 10 != 0)
    late = (number % 10 == 0) & (F.col("l_linenumber") % 2 == 1)
    second = rows.where((number % 7 == 0) | late).withColumn("AirTime", F.col("AirTime") + 1)
    third = rows.where(number % 5 == 0).withColumn("AirTime", F.col("AirTime") + 2)
    schema = "l_orderkey long, l_linenumber int, FlightDate date, AirTime double, month int"
    deliveries = ((first, date(2002, 1, 1)), (second, date(2002, 3, 1)), (third, date(2002, 2, 1)))
    for delivered, day in deliveries:
        merge_fact(spark, f"{root}/fact", delivered, "month", day, schema, f"{root}/work")
    fact = spark.read.schema(f"{schema}, {DELIVERED} date").parquet(f"{root}/fact")
    return fact.select("l_orderkey", "l_linenumber", "FlightDate", "AirTime", DELIVERED)


def monthly_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.monthly_fact(passengers(spark, sf_dir), presentation(spark, sf_dir), store=stored)


def monthly_fact_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.monthly_fact(passengers(spark, sf_dir), presentation(spark, sf_dir), dedupe=True, store=stored)


# Dashboards


def _asked(question: Callable[..., DataFrame], dimension: str, *columns: str) -> Query:
    """A dashboard question over the columns of the daily fact it needs."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dims = presentation(spark, sf_dir)
        fact = facts.daily_fact(flights(spark, sf_dir, facts.flight_columns(columns)), dims, columns, store=stored)
        return question(fact, getattr(dims, dimension))

    return query


def cancellation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.cancellation_reasons(flights(spark, sf_dir, ["Cancelled", "CancellationCode"]))


def kept_up_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airlines from sums kept per month, after two deliveries and a correction of flights of some airlines."""
    dims, root = presentation(spark, sf_dir), scratch_root(spark)
    columns = ["flight_date_key", "airline_key", "total_delay", "diverted", "taxi_in", "taxi_out"]
    wanted = ["l_orderkey", "l_linenumber", *facts.flight_columns(columns)]
    month = F.year("FlightDate") * 12 + F.month("FlightDate")
    rows = stored(flights(spark, sf_dir, wanted).withColumn("month", month))
    rows = rows.withColumn(IDENTITY, identity("l_orderkey", "l_linenumber"))
    later = F.col("FlightDate") >= F.lit(SECOND_DELIVERY)
    wrong = (F.col("l_orderkey") % 7 == 0) & (F.year("FlightDate") == 1997)
    deliveries = (rows.where(~later), rows.where(later), rows.where(wrong).withColumn("TaxiIn", F.col("TaxiIn") + 1))
    schema = f"{facts.fact_schema(columns)}, month int"
    for number, delivered in enumerate(deliveries):
        loaded = facts.daily_fact(delivered, dims, columns, keep=["month", IDENTITY])
        day = date(2002, 1, 1 + number)
        done = merge_fact(spark, f"{root}/fact", loaded, "month", day, schema, f"{root}/work")
        fact = spark.read.schema(schema).parquet(f"{root}/fact")
        keep_up(fact, f"{root}/sums", "month", done.touched, ["airlines"])
    return kept_dashboard(spark, f"{root}/sums", "airline_dashboard", dims.airline)


def monthly_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.monthly_dashboard(monthly_fact(spark, sf_dir), presentation(spark, sf_dir).month)


QUERIES: dict[str, Query] = {
    "source_csv_roundtrip": source_csv_roundtrip,
    "source_csv_quoted": source_csv_quoted,
    "reject_bad_rows": reject_bad_rows,
    "infer_types": infer_types,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "sink_swap": sink_swap,
    "load_audit": audit,
    "profile_table": profile,
    "profile_sketch": profile_sketch,
    "fill_undefined": fill,
    "normalize_lower": lower,
    "parse_place_description": place,
    "hhmm_decode": clock,
    "time_key_lookup": time_key,
    "total_delay": delay,
    "distinct_rows": distinct_rows,
    "next_key": free_key,
    "surrogate_key": surrogate_key,
    "surrogate_key_offset": surrogate_key_offset,
    "stage_airline": stage_airline,
    "stage_airport": stage_airport,
    "stage_plane": stage_plane,
    "scd2_initial": scd2_initial,
    "scd2_new_members": _of_both(scd2.new_members),
    "scd2_existing_members": _of_both(scd2.existing_members),
    "scd2_changed_members": _of_both(scd2.changed_members),
    "scd2_closed_rows": _of_both(scd2.closed_rows, LOADS[2]),
    "scd2_untouched_rows": _of_both(scd2.untouched_rows),
    "scd2_merge": _of_both(scd2.scd2_merge, LOADS[2], "attributes", stored),
    "scd2_merge_digests": _of_both(scd2_merge_changed, LOADS[2], stored),
    "scd2_merge_always": _of_both(scd2.scd2_merge, LOADS[2], "always", stored),
    "scd2_current": scd2_current,
    "scd2_late_delivery": scd2_late_delivery,
    "date_dimension": date_dim,
    "time_dimension": time_dim,
    "monthly_dimension": monthly_dim,
    "calendar_redelivery": calendar_redelivery,
    "holiday_calendar": holidays,
    "fact_date_lookup": fact_date_lookup,
    "role_playing_lookup": role_playing_lookup,
    "daily_fact": daily_fact,
    "two_deliveries": two_deliveries,
    "point_in_time_fact": point_in_time_fact,
    "point_in_time_monthly": point_in_time_monthly,
    "fact_late_rows": fact_late_rows,
    "monthly_fact": monthly_fact,
    "monthly_fact_distinct": monthly_fact_distinct,
    "least_delayed_month": _asked(dashboards.least_delayed_month, "date", "flight_date_key", "total_delay"),
    "cancellation_reasons": cancellation_reasons,
    "busiest_destinations": _asked(dashboards.busiest_destinations, "airport", "dest_airport_key"),
    "airline_dashboard": _asked(
        dashboards.airline_dashboard, "airline", "airline_key", "total_delay", "diverted", "taxi_in", "taxi_out"
    ),
    "airport_dashboard": _asked(
        dashboards.airport_dashboard,
        "airport",
        "origin_airport_key",
        "dest_airport_key",
        "div1_airport_key",
        "div2_airport_key",
        "cancelled",
        "diverted",
    ),
    "city_diversions": _asked(
        dashboards.city_diversions,
        "airport",
        "origin_airport_key",
        "dest_airport_key",
        "div1_airport_key",
        "div2_airport_key",
        "cancelled",
        "diverted",
    ),
    "plane_dashboard": _asked(
        dashboards.plane_dashboard, "plane", "plane_key", "diverted", "cancelled", "total_delay"
    ),
    "holiday_trend": _asked(
        dashboards.holiday_trend, "date", "flight_date_key", "cancelled", "diverted", "total_delay"
    ),
    "route_dashboard": _asked(
        dashboards.route_dashboard,
        "airport",
        "origin_airport_key",
        "dest_airport_key",
        "diverted",
        "cancelled",
        "total_delay",
    ),
    "monthly_dashboard": monthly_dashboard,
    "kept_up_dashboard": kept_up_dashboard,
}
