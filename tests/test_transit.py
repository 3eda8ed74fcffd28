"""Schedules and directions at their edges."""

from pyspark.sql import functions as F

from strandweave.operators import directions, transit


def test_hours_beyond_24_roll_the_weekday_on(spark):
    times = transit.trip_times(spark.createDataFrame([("t", "25:10:00"), ("t", "25:40:00")], "trip_id string, arrival_time string"))
    row = transit.trip_services(spark.createDataFrame([("t", 1)], "trip_id string, service_id int"), times, spark.createDataFrame([(1, 6)], "service_id int, dow int")).first()
    assert (row.start_dow, row.time_period, row.minutes) == (7, "OVN", 30)


def test_minutes_are_split_between_periods(spark):
    times = transit.trip_times(spark.createDataFrame([("t", "09:50:00"), ("t", "10:30:00")], "trip_id string, arrival_time string"))
    row = transit.trip_services(spark.createDataFrame([("t", 1)], "trip_id string, service_id int"), times, spark.createDataFrame([(1, 2)], "service_id int, dow int")).first()
    assert (row.start_minutes, row.end_minutes, row.time_period) == (10, 30, "MIDD")


def test_directions(spark):
    cases = [(100.0, 1, [1, 5], 5), (100.0, 0, [1, 5], 1), (-10.0, 1, None, 1), (10.0, 1, [3], 3), (10.0, 1, [3, 7], 3), (10.0, 1, [1, 3], None), (10.0, 1, [2], None), (None, 1, None, None), (90.0, 1, [1, 3, 5], 3)]
    df = spark.createDataFrame(cases, "bearing double, f int, dirs array<int>, want int")
    for r in df.withColumn("got", directions.federal_direction(F.col("bearing"), F.col("f"), F.col("dirs"))).collect():
        assert r.got == r.want, r
