"""Schedules: service dates, trip times and periods, bus counts on conflation segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
PERIODS = ("AMP", "MIDD", "PMP", "WE", "OVN")
#: Five-minute epochs at which the periods of a weekday begin.
MORNING, MIDDAY, EVENING, NIGHT = 6 * 12, 10 * 12, 16 * 12, 20 * 12


def _date(c: str) -> Column:
    return F.to_date(F.col(c), "yyyyMMdd")


def feed_extent(calendar: DataFrame, calendar_dates: DataFrame, feed_info: DataFrame | None = None) -> DataFrame:
    """AGG-26. First and last date over all tables, added dates included, and the days from one to the other."""
    spans = calendar.select(_date("start_date").alias("a"), _date("end_date").alias("b")).unionByName(calendar_dates.where("exception_type = 1").select(_date("date").alias("a"), _date("date").alias("b")))
    if feed_info is not None:
        spans = spans.unionByName(feed_info.select(_date("feed_start_date").alias("a"), _date("feed_end_date").alias("b")))
    return spans.agg(F.min("a").alias("first_date"), F.max("b").alias("last_date")).withColumn("n_days", F.datediff("last_date", "first_date") + 1)


def feed_dates(extent: DataFrame) -> DataFrame:
    """GTF-1. Every date of the extent with its day of the week, Sunday 0."""
    return extent.where("first_date IS NOT NULL").select(F.explode(F.sequence("first_date", "last_date")).alias("date")).withColumn("dow", F.dayofweek("date") - 1)


def service_dates(calendar: DataFrame, calendar_dates: DataFrame, dates: DataFrame) -> DataFrame:
    """GTF-2. Dates on which a service runs: its weekdays within its range, plus added and minus removed dates.

    Removals count by their date (a deviation: as written in the original they can never match).
    """
    runs = F.element_at(F.array(*[F.col(d) for d in DAYS]), F.col("dow") + 1) == 1
    usual = calendar.join(dates, F.col("date").between(_date("start_date"), _date("end_date"))).where(runs).select("service_id", "date")
    extra = calendar_dates.select("service_id", _date("date").alias("date"), "exception_type")
    added = extra.where("exception_type = 1").select("service_id", "date")
    removed = extra.where("exception_type = 2").select("service_id", "date")
    return usual.union(added).subtract(removed).withColumn("dow", F.dayofweek("date") - 1)


def trip_times(stop_times: DataFrame) -> DataFrame:
    """(trip_id, start_s, end_s): seconds after the service date's midnight, beyond 24 h included."""
    part = F.split("arrival_time", ":")
    seconds = part[0].cast("int") * 3600 + part[1].cast("int") * 60 + part[2].cast("int")
    return stop_times.where("arrival_time IS NOT NULL").select("trip_id", seconds.alias("s")).groupBy("trip_id").agg(F.min("s").alias("start_s"), F.max("s").alias("end_s"))


def _period(epoch: str, dow: str) -> Column:
    day = F.when(F.col(epoch) < MIDDAY, "AMP").when(F.col(epoch) < EVENING, "MIDD").otherwise("PMP")
    return F.when(F.col(epoch).between(MORNING, NIGHT - 1), F.when(F.col(dow).between(1, 5), day).otherwise("WE")).otherwise("OVN")


def trip_services(trips: DataFrame, times: DataFrame, services: DataFrame) -> DataFrame:
    """GTF-3. One row for each trip and weekday of its service: start and end, and the period that holds most of it.

    A trip's minutes in the period of its start run to that period's end, and those in the period of its end
    from that period's start, neither beyond its duration; the tie goes to the end. Hours past 24 roll the
    weekday on, to 7 after a Saturday. The end's weekend test looks at the start's weekday, as in the original.
    """
    base = trips.select("trip_id", "service_id").distinct().join(times, "trip_id").join(services.select("service_id", "dow").distinct(), "service_id")
    at = base.withColumns({
        "start_dow": F.col("dow") + F.floor(F.col("start_s") / 86400).cast("int"),
        "end_dow": F.col("dow") + F.floor(F.col("end_s") / 86400).cast("int"),
        "start_of": (F.col("start_s") % 86400) / 60,
        "end_of": (F.col("end_s") % 86400) / 60,
        "minutes": F.round((F.col("end_s") - F.col("start_s")) / 60 + 1e-9),
    }).withColumns({"start_epoch": F.floor(F.col("start_of") / 5).cast("int"), "end_epoch": F.floor(F.col("end_of") / 5).cast("int")})
    at = at.withColumns({"start_period": _period("start_epoch", "start_dow"), "end_period": _period("end_epoch", "end_dow")})
    weekend = ~F.col("start_dow").between(1, 5)
    s, e = F.col("start_epoch"), F.col("end_epoch")
    until = F.when(s < MORNING, 360.0).when(s >= NIGHT, 1440.0 - 1 / 60 + 360).when(weekend, 1200.0).when(s < MIDDAY, 600.0).when(s < EVENING, 960.0).otherwise(1200.0)
    since = F.when(e < MORNING, -240.0).when(e >= NIGHT, 1200.0).when(weekend | (e < MIDDAY), 360.0).when(e < EVENING, 600.0).otherwise(960.0)
    in_start = F.round(F.least(until - F.col("start_of"), F.col("minutes")) + 1e-9)
    in_end = F.round(F.least(F.col("end_of") - since, F.col("minutes")) + 1e-9)
    out = at.withColumns({"start_minutes": in_start, "end_minutes": in_end})
    first = F.col("start_minutes") > F.col("end_minutes")
    return out.select("trip_id", "service_id", "dow", "start_s", "end_s", "start_dow", "end_dow", "start_epoch", "end_epoch", "start_period", "end_period", "minutes", "start_minutes", "end_minutes", F.when(first, F.col("start_period")).otherwise(F.col("end_period")).alias("time_period"))


def trip_counts(trip_services: DataFrame, services: DataFrame) -> DataFrame:
    """AGG-21. Runs of each trip by time period over the feed's dates."""
    runs = services.groupBy("service_id", "dow").agg(F.count("*").alias("n_dates"))
    return trip_services.join(runs, ["service_id", "dow"]).groupBy("trip_id", "time_period").agg(F.sum("n_dates").alias("n_runs"))


def trip_segments(matches: DataFrame, trips: DataFrame, segments: DataFrame) -> DataFrame:
    """JN-12. (trip_id, route_id, segment_id) through the references that a trip's shape matches."""
    return trips.select("trip_id", "route_id", "shape_id").join(matches, "shape_id").join(segments.select("ref_id", "segment_id"), "ref_id").select("trip_id", "route_id", "segment_id").distinct()


def bus_counts(on_segments: DataFrame, counts: DataFrame, extent: DataFrame) -> DataFrame:
    """AGG-22. Runs a year by segment, route and period, zero where none: runs x 365 / days of the feed."""
    met = on_segments.join(counts, "trip_id").groupBy("segment_id", "route_id").pivot("time_period", list(PERIODS)).agg(F.sum("n_runs"))
    days = extent.select("n_days")
    return met.crossJoin(F.broadcast(days)).select("segment_id", "route_id", *[F.round(F.coalesce(p, F.lit(0)) * 365 / F.col("n_days") + 1e-9, 3).alias(p.lower()) for p in PERIODS])


def shape_runs(trips: DataFrame, counts: DataFrame) -> DataFrame:
    """(shape_id, route_id, time_period, n_runs): runs summed over the trips of a shape before they meet its segments."""
    return trips.select("trip_id", "route_id", "shape_id").distinct().join(counts, "trip_id").groupBy("shape_id", "route_id", "time_period").agg(F.sum("n_runs").alias("n_runs"))


def shape_bus_counts(runs: DataFrame, matches: DataFrame, segments: DataFrame, extent: DataFrame) -> DataFrame:
    """AGG-22 by shape: what :func:`bus_counts` gives for :func:`trip_segments`, without a row for each trip and segment."""
    on = matches.join(segments.select("ref_id", "segment_id"), "ref_id").select("shape_id", "segment_id").distinct()
    met = runs.join(on, "shape_id").groupBy("segment_id", "route_id").pivot("time_period", list(PERIODS)).agg(F.sum("n_runs"))
    days = F.broadcast(extent.select("n_days"))  # one row
    return met.crossJoin(days).select("segment_id", "route_id", *[F.round(F.coalesce(p, F.lit(0)) * 365 / F.col("n_days") + 1e-9, 3).alias(p.lower()) for p in PERIODS])


def bus_aadt(counts: DataFrame) -> DataFrame:
    """AGG-23. Daily averages."""
    return counts.select("segment_id", "route_id", *[F.round(F.col(p.lower()) / 365 + 1e-9, 3).alias(p.lower()) for p in PERIODS])


def bus_aadt_by_segment(aadt: DataFrame) -> DataFrame:
    """AGG-24. Per segment a map from route to its five values, with the sums under ``_total_``."""
    cols = [p.lower() for p in PERIODS]
    total = aadt.groupBy("segment_id").agg(*[F.round(F.sum(c) + 1e-9, 3).alias(c) for c in cols]).withColumn("route", F.lit("_total_"))
    rows = aadt.withColumn("route", F.col("route_id").cast("string")).select("segment_id", "route", *cols).unionByName(total.select("segment_id", "route", *cols))
    return rows.groupBy("segment_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("route", F.array(*cols).alias("v"))))).alias("aadt"))


def consolidate_aadt(feeds: DataFrame) -> DataFrame:
    """AGG-25. Many agencies' (agency, segment_id, aadt map) as one map keyed ``agency:route``, and period totals."""
    name = F.regexp_replace(F.regexp_replace(F.lower("agency"), "[^a-z0-9]+", "_"), "^_|_$", "")
    each = feeds.select(name.alias("agency"), "segment_id", F.explode("aadt").alias("route", "v"))
    routes = each.where("route <> '_total_'").groupBy("segment_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.concat("agency", F.lit(":"), "route").alias("k"), "v")))).alias("routes"))
    sums = each.where("route = '_total_'").groupBy("segment_id").agg(*[F.round(F.sum(F.get("v", F.lit(i))), 3).alias(p.lower()) for i, p in enumerate(PERIODS)])
    return routes.join(sums, "segment_id", "full")


def shapeless_trips(trips: DataFrame) -> DataFrame:
    """AGG-27. Trips, and those without a shape."""
    return trips.agg(F.count("*").alias("n_trips"), F.count_if(F.col("shape_id").isNull()).alias("n_shapeless"))


def gtfs_qa(trips: DataFrame, times: DataFrame, trip_services: DataFrame, services: DataFrame) -> DataFrame:
    """GTF-4. (test, n_failed) of the schedule's invariants."""
    long = trip_services.where("minutes < 0 OR minutes > 1440").agg(F.count("*").alias("n"))
    lost = trips.join(times, "trip_id", "left_semi").join(services.select("service_id").distinct(), "service_id", "left_semi").select("trip_id").distinct().join(trip_services.select("trip_id").distinct(), "trip_id", "left_anti").agg(F.count("*").alias("n"))
    twice = services.groupBy("service_id", "date").count().where("count > 1").agg(F.count("*").alias("n"))
    split = trip_services.where("start_minutes > minutes OR end_minutes > minutes").agg(F.count("*").alias("n"))
    tests = (("duration", long), ("trips_kept", lost), ("service_dates_unique", twice), ("period_minutes", split))
    out = None
    for test, df in tests:
        row = df.select(F.lit(test).alias("test"), F.col("n").alias("n_failed"))
        out = row if out is None else out.unionByName(row)
    return out


def gtfs_to_aadt(trips: DataFrame, stop_times: DataFrame, calendar: DataFrame, calendar_dates: DataFrame, matches: DataFrame, segments: DataFrame) -> DataFrame:
    """GTF-5. From a feed's tables to daily averages by segment and route."""
    extent = feed_extent(calendar, calendar_dates)
    services = service_dates(calendar, calendar_dates, feed_dates(extent))
    counts = trip_counts(trip_services(trips, trip_times(stop_times), services), services)
    return bus_aadt(shape_bus_counts(shape_runs(trips, counts), matches, segments, extent))
