"""Row-wise views of raw inputs, lookups and id translations."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strandweave.operators.geometry import haversine
from strandweave.plans.cut import cut


def raw_segments(attrs: DataFrame, shapes: DataFrame) -> DataFrame:
    """PRJ-1. Attributes with shapes; non-primary rows go; the route is the first known code with its county, else the segment."""
    county = F.lower("county")
    codes = [F.when(F.col(c).isNotNull() & county.isNotNull(), F.concat(F.col(c), F.lit(":"), county)) for c in ("lineartmc", "roadnumber", "roadname")]
    return attrs.where("isprimary IS NULL OR isprimary <> 0").join(shapes, "tmc").withColumn("route_id", F.coalesce(*codes, F.col("tmc")))


def raw_inventory(rows: DataFrame, directions: DataFrame) -> DataFrame:
    """PRJ-2. Inventory rows that have a geometry, with id, route and the station's federal directions."""
    keyed = rows.where("coords IS NOT NULL").withColumns({"target_map_id": F.concat("gis_id", F.lit(":"), "beg_mp"), "route_id": F.concat("gis_id", F.lit(":"), "county_name")})
    return keyed.join(directions, "rc_station", "left")


def is_unidirectional(kind: str) -> Column:
    """PRJ-4. Segments always; inventory rows if one-way, or divided with every lane in the primary direction (nulls equal)."""
    if kind == "segments":
        return F.lit(True)
    return F.coalesce(F.col("oneway") == "Y", F.lit(False)) | (F.coalesce(F.col("divided") == "Y", F.lit(False)) & F.col("total_lanes").eqNullSafe(F.col("primary_dir_lanes")))


def edge_properties(raw: DataFrame, kind: str) -> DataFrame:
    """PRJ-3. The properties that every map's edges share."""
    names = {"segments": ("tmc", "roadname", "route_numb", "f_system", "isprimary"), "inventory": ("target_map_id", "road_name", "route_no", "functional_class", None)}[kind]
    key, name, number, level, primary = names
    return raw.select(
        F.col(key).alias("target_map_id"),
        F.col("length_km").alias("edge_length_km"),
        is_unidirectional(kind).cast("int").alias("is_unidirectional"),
        F.col(name).alias("road_name"),
        F.col(number).alias("route_number"),
        (F.col(level) % 10).alias("road_level"),
        (F.coalesce(F.col(primary), F.lit(1)) if primary else F.lit(1)).alias("is_primary"),
    )


def osm_road_class(ways: DataFrame) -> DataFrame:
    """PRJ-5. (way_id, road_class 0-8) from highway and service tags; untagged ways go.

    Fixed values: the class of each tag prefix, in the order they are tested.
    """
    highway, service = F.lower(F.trim("highway")), F.lower(F.trim("service"))
    minor = service.rlike("^(parking|driveway|drive-through)")
    by_prefix = (("motorway", 0), ("trunk", 1), ("primary", 2), ("secondary", 3), ("tertiary", 4), ("unclassified", 6), ("residential", 5))
    found = F.when(highway.startswith("service"), F.when(minor, 8).otherwise(7)).when(highway.startswith("living_street"), 5).otherwise(8)
    for prefix, code in reversed(by_prefix):
        found = F.when(highway.startswith(prefix), code).otherwise(found)
    return ways.where(F.nullif(highway, F.lit("")).isNotNull()).select("way_id", found.alias("road_class"))


def lookup_in_order(ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """PRJ-7. For (list_id, ids array): every position with its row, null where the id is unknown; order by list_id, pos."""
    return ids.select("list_id", F.posexplode("ids").alias("pos", key)).join(rows, key, "left")


def translate_sequence(paths: DataFrame, mapping: DataFrame, key: str, to: str) -> DataFrame:
    """PRJ-8. (path_id, ids array in ``to``), order kept."""
    each = paths.select("path_id", F.posexplode("ids").alias("pos", key)).join(mapping, key, "left")
    return each.groupBy("path_id").agg(F.sort_array(F.collect_list(F.struct("pos", to))).alias("s")).select("path_id", F.transform("s", lambda x: x[to]).alias("ids"))


def features(df: DataFrame, key: str, coords: str, kind: str = "LineString") -> DataFrame:
    """PRJ-9. GeoJSON features of rows: all other columns are properties."""
    others = [c for c in df.columns if c not in (key, coords)]
    return df.select(F.col(key).alias("id"), F.to_json(F.struct(F.lit("Feature").alias("type"), F.col(key).alias("id"), F.struct(*others).alias("properties"), F.struct(F.lit(kind).alias("type"), F.col(coords).alias("coordinates")).alias("geometry"))).alias("feature"))


def geoprox_key(lon: Column, lat: Column, bits: int = 26) -> Column:
    """PRJ-10. A fixed-width Morton key: bits of |lon| and |lat| in units of 1e-5 degrees, interleaved."""
    spread = lambda c: F.abs(F.round(c * 1e5)).cast("long")
    x, y = spread(lon), spread(lat)
    at = F.sequence(F.lit(0), F.lit(bits - 1))
    bit = lambda v, i: F.floor(v / F.pow(F.lit(2.0), i)) % 2
    return F.aggregate(at, F.lit(0).cast("long"), lambda acc, i: acc + (bit(x, i) * F.pow(F.lit(2.0), i * 2 + 1) + bit(y, i) * F.pow(F.lit(2.0), i * 2)).cast("long"))


def ref_metadata(refs: DataFrame) -> DataFrame:
    """PRJ-11. References with the id of the opposite direction of the same geometry, null if there is none."""
    other = refs.select("geometry_id", F.col("ref_id").alias("opposite_ref_id"), (1 - F.col("is_forward")).alias("is_forward"))
    return refs.join(other, ["geometry_id", "is_forward"], "left").select("ref_id", "geometry_id", "is_forward", "opposite_ref_id", "road_class", "form_of_way", "length_km")


def ref_roadway_metadata(refs: DataFrame) -> DataFrame:
    """PRJ-12. The compact reference table."""
    return refs.select("ref_id", "geometry_id", "is_forward", "road_class", "form_of_way", "length_km").distinct()


#: PRJ-13. Codes and their meanings.
ROAD_CLASSES = ("Motorway", "Trunk", "Primary", "Secondary", "Tertiary", "Residential", "Unclassified", "Service", "Other")
FORMS_OF_WAY = ("Undefined", "Motorway", "MultipleCarriageway", "SingleCarriageway", "Roundabout", "TrafficSquare", "SlipRoad", "Other")
TRAVEL_DIRECTIONS = ("North", "Northeast", "East", "Southeast", "South", "Southwest", "West", "Northwest")


def lookups(spark: SparkSession) -> DataFrame:
    """PRJ-13. (kind, code, description)."""
    rows = [("road_class", i, x) for i, x in enumerate(ROAD_CLASSES)] + [("form_of_way", i, x) for i, x in enumerate(FORMS_OF_WAY)] + [("direction", i + 1, x) for i, x in enumerate(TRAVEL_DIRECTIONS)]
    return spark.createDataFrame(rows, "kind string, code int, description string")


def stop_points(stops: DataFrame) -> DataFrame:
    """PRJ-14. Stops that have coordinates, as points."""
    return stops.where("stop_lon IS NOT NULL AND stop_lat IS NOT NULL").withColumn("coords", F.array("stop_lon", "stop_lat"))


def latest_rows(df: DataFrame, key: str, by: str) -> DataFrame:
    """WIN-3. Rows of each key's greatest ``by``, ties kept."""
    return df.withColumn("__rank", F.rank().over(Window.partitionBy(key).orderBy(F.desc(by)))).where("__rank = 1").drop("__rank")


def filter_raw(df: DataFrame, key: str, value) -> DataFrame:
    """PRJ-6. Rows whose property has a value."""
    return df.where(F.col(key) == F.lit(value))


def semi_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """JN-3. ``(a, b, ...) IN``: rows whose keys are in the other table; null keys never are."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def anti_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """JN-3. ``(a, b, ...) NOT IN`` as SQL has it: a row stays only if its keys surely differ from all others, so a null
    on either side leaves it out wherever the columns that are not null agree. An empty table leaves all rows.

    Rows and keys are taken apart by which of their columns are null (2 to the number of columns, at most); each
    part meets each by equality in the columns that neither lacks.
    """

    def lacking(rows: DataFrame, nulls: tuple[str, ...]) -> DataFrame:
        return rows.where(reduce(lambda x, y: x & y, [F.col(c).isNull() if c in nulls else F.col(c).isNotNull() for c in on]))

    patterns = [n for k in range(len(on) + 1) for n in combinations(on, k)]
    out = None
    for left in patterns:
        rows = lacking(df, left)
        for right in patterns:
            rest = [c for c in on if c not in left and c not in right]
            other = lacking(keys.select(*on), right)
            rows = rows.join(other.select(*rest).distinct(), rest, "left_anti") if rest else rows.join(F.broadcast(other.limit(1).select(F.lit(1).alias("__any"))), F.lit(True), "left_anti")
        out = rows if out is None else out.unionByName(rows)
    return out


def ordered(df: DataFrame, keys: list[str], local: bool = False) -> DataFrame:
    """SRT-1. Rows in order; ``local``: near keys together in sorted partitions, without one order of all."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys) if local else df.orderBy(*keys)


def numbered(df: DataFrame, keys: list[str]) -> DataFrame:
    """SRT-1. ``df`` with ``place``, a row's number from 1 in the order of ``keys`` (rows equal in them in no stated order).

    Rows are dealt out by ranges of the keys and numbered within each; one row a range is summed up for the ranges
    before it, so no task holds all rows.
    """
    dealt = cut(df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = counts.select("__range", (F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*keys))
    return dealt.withColumn("place", own.cast("long")).join(before, "__range").withColumn("place", F.col("place") + F.col("__before")).drop("__range", "__before")


def sort_nested(col: Column, key: str) -> Column:
    """SRT-3. An array of structs by one of their fields, in full order on ties."""
    return F.transform(F.array_sort(F.transform(col, lambda x: F.struct(x[key].alias("k"), x.alias("v")))), lambda s: s["v"])


def sorted_ints(col: Column) -> Column:
    """UDF-2. A JSON array of integers in ascending order."""
    return F.to_json(F.array_sort(F.from_json(col, "array<bigint>")))


def raw_properties(raw: DataFrame, lengths: DataFrame, key: str, kind: str) -> DataFrame:
    """REP-3. Raw features with length_km and their direction flag."""
    return raw.join(lengths.select(F.col("line_id").alias(key), "length_km"), key).withColumn("is_unidirectional", is_unidirectional(kind).cast("int"))


def reference_metadata(ids: DataFrame, refs: DataFrame) -> DataFrame:
    """REP-4. For (list_id, ids array): metadata of the known references, class Other (8) left out, in the order asked."""
    return lookup_in_order(ids, ref_roadway_metadata(refs), "ref_id").where("road_class <> 8")


def assemble_references(refs: DataFrame, points: DataFrame, locations: DataFrame, sections: DataFrame, section_nodes: DataFrame) -> DataFrame:
    """AGG-19. Base references from their parts, one row each.

    ``refs``: ref_id, geometry_id, is_forward, form_of_way; ``points``: geometry_id, pt_idx, x, y of the forward line;
    ``locations``: ref_id, seq, node; ``sections``: geometry_id, section_idx, way_id, road_class, highway, which may
    repeat; ``section_nodes``: geometry_id, section_idx, node_idx, node_id. Locations, sections and nodes are put in
    order; classes and highway types are summed up; a reference against its geometry has the line reversed.
    """
    line = points.groupBy("geometry_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pt_idx", "x", "y"))), lambda p: F.struct(p["x"].alias("lon"), p["y"].alias("lat"))).alias("coords"))
    placed = locations.groupBy("ref_id").agg(F.sort_array(F.collect_list(F.struct("seq", "node"))).alias("locations"))
    nodes = section_nodes.groupBy("geometry_id", "section_idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("node_idx", "node_id"))), lambda n: n["node_id"]).alias("node_ids"))
    each = sections.select("geometry_id", "section_idx", "way_id", "road_class", "highway").distinct().join(nodes, ["geometry_id", "section_idx"], "left")
    ways = each.groupBy("geometry_id").agg(
        F.sort_array(F.collect_list(F.struct("section_idx", "way_id", "road_class", "highway", "node_ids"))).alias("way_sections"),
        F.min("road_class").alias("min_road_class"),
        F.max("road_class").alias("max_road_class"),
        F.array_sort(F.collect_set("road_class")).alias("road_classes"),
        F.array_sort(F.collect_set("highway")).alias("highways"),
    )
    lone = refs.groupBy("geometry_id").agg((F.count("*") == 1).alias("is_unidirectional"))
    met = refs.join(line, "geometry_id").join(placed, "ref_id").join(ways, "geometry_id").join(lone, "geometry_id")
    steps = F.transform(F.sequence(F.lit(1), F.size("coords") - 1), lambda i: haversine(F.element_at("coords", i)["lon"], F.element_at("coords", i)["lat"], F.element_at("coords", i + 1)["lon"], F.element_at("coords", i + 1)["lat"]))
    return met.select(
        "ref_id",
        "geometry_id",
        "is_forward",
        "form_of_way",
        F.element_at("locations", 1)["node"].alias("from_node"),
        F.element_at("locations", -1)["node"].alias("to_node"),
        "locations",
        "way_sections",
        "min_road_class",
        "max_road_class",
        "road_classes",
        "highways",
        F.aggregate(steps, F.lit(0.0), lambda a, x: a + x).alias("length_km"),
        "is_unidirectional",
        F.when(F.col("is_forward") == 1, F.col("coords")).otherwise(F.reverse("coords")).alias("coords"),
    )
