"""Travel directions from traffic-count stations and bearings. Codes: 1 north, 3 east, 5 south, 7 west."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.operators.projections import latest_rows


def station_key(region: Column, station: Column) -> Column:
    """DIR-1. ``RR_NNNN``."""
    return F.concat(F.lpad(region.cast("string"), 2, "0"), F.lit("_"), F.lpad(station.cast("string"), 4, "0"))


def latest_directions(directions: DataFrame, latest_year: int | None = None) -> DataFrame:
    """DIR-2, AGG-20. Per station the directions of its latest year (at most ``latest_year``), ascending."""
    held = directions if latest_year is None else directions.where(F.col("year") <= latest_year)
    return latest_rows(held, "rc_station", "year").groupBy("rc_station").agg(F.max("year").alias("year"), F.array_sort(F.collect_set("federal_direction")).alias("federal_directions"))


def federal_direction(bearing: Column, is_forward: Column, directions: Column) -> Column:
    """DIR-3, UDF-1. One allowed direction is the answer; of a north-south or east-west pair the bearing's side;
    without directions or with more than two the bearing's quadrant; null for other pairs or codes."""
    turned = F.when(is_forward == 1, bearing).otherwise(F.when(bearing <= 0, bearing + 180).otherwise(bearing - 180))
    whole = F.when(turned > 180, turned - 360).when(turned < -180, turned + 360).otherwise(turned)
    quadrant = F.when(whole.between(-45, 45), 1).when((whole > 45) & (whole < 135), 3).when((whole <= -135) | (whole >= 135), 5).otherwise(7)
    known = F.array_sort(directions)
    unknown = F.size(F.array_except(known, F.array(*[F.lit(x) for x in (1, 3, 5, 7)]))) > 0
    pair = lambda a, b: (F.size(known) == 2) & (F.element_at(known, 1) == a) & (F.element_at(known, -1) == b)
    by_bearing = F.when(pair(1, 5), F.when(F.abs(turned) <= 90, 1).otherwise(5)).when(pair(3, 7), F.when(turned >= 0, 3).otherwise(7))
    free = directions.isNull() | (F.size(known) == 0) | (F.size(known) > 2)
    return F.when(directions.isNotNull() & unknown, None).when(directions.isNotNull() & (F.size(known) == 1), F.element_at(known, 1)).when(bearing.isNull(), None).when(free, quadrant).otherwise(by_bearing).cast("int")


def longest_path_rows(rows: DataFrame) -> DataFrame:
    """WIN-4. For each (target_map_id, is_forward) the row of the longest path; ties by path id."""
    order = Window.partitionBy("target_map_id", "is_forward").orderBy(F.desc("path_km"), "path_id")
    return rows.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def assigned_directions(assigned: DataFrame, path_edges: DataFrame, paths: DataFrame, edges: DataFrame) -> DataFrame:
    """DIR-4. (target_map_id, is_forward, federal_direction) by the longest path through each edge.

    ``paths``: path_id, bearing, path_km; ``edges``: edge_id, target_map_id, federal_directions.
    """
    ways = assigned.select("edge_id", "is_forward").distinct().join(path_edges.select("path_id", "edge_id").distinct(), "edge_id").join(paths, "path_id").join(edges, "edge_id")
    chosen = longest_path_rows(ways)
    return chosen.select("target_map_id", "is_forward", federal_direction(F.col("bearing"), F.col("is_forward"), F.col("federal_directions")).alias("federal_direction"))
