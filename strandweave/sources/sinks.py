"""Outputs: NDJSON features with tile hints, terse rows, flat exports, collections and metadata records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


#: Tile layer and least zoom by road class (0-8), by functional class of segments (1-7), of inventory rows (1-9).
BY_CLASS = {0: ("major", None), 1: ("major", 5), 2: ("major", 5), 3: ("major", 5), 4: ("major", 5), 5: ("local", 11), 6: ("local", 11), 7: ("local", 11), 8: ("paths", 14)}
BY_SYSTEM = {1: ("interstate", None), 2: ("highway", 7), 3: ("arterial", 8), 4: ("arterial", 9), 5: ("collector", 10), 6: ("collector", 11), 7: ("local", 12)}


def tile_hint(code: Column, table: dict[int, tuple[str, int | None]]) -> Column:
    """struct(layer, minzoom) of a code, null for unknown codes."""
    out = F.lit(None).cast("struct<layer:string,minzoom:int>")
    for k, (layer, zoom) in table.items():
        out = F.when(code == k, F.struct(F.lit(layer).alias("layer"), F.lit(zoom).cast("int").alias("minzoom"))).otherwise(out)
    return out


def terse_segment(df: DataFrame) -> DataFrame:
    """SNK-5. The short names of a conflation segment's columns."""
    return df.select(F.col("segment_id").alias("id"), F.col("ref_id").alias("ref"), F.col("osm.edge_id").alias("osm"), F.col("osm.is_forward").alias("osm_fwd"), F.col("ris.edge_id").alias("ris"), F.col("tmc.edge_id").alias("tmc"), F.col("road_class").alias("n"), F.col("highway").alias("h"), F.col("federal_direction").alias("dir"))


def with_layer(df: DataFrame, key: str, code: Column, table: dict, properties: list[str]) -> DataFrame:
    """(id, line): one JSON feature a row."""
    hint = tile_hint(code, table)
    return df.select(F.col(key).alias("id"), F.to_json(F.struct(F.lit("Feature").alias("type"), F.col(key).alias("id"), F.struct(*properties).alias("properties"), hint.alias("tippecanoe"))).alias("line"))


def segments_to_ndjson(df: DataFrame) -> DataFrame:
    """SNK-1. Conflation segments as lines."""
    return with_layer(df, "segment_id", F.col("road_class"), BY_CLASS, [c for c in df.columns])


def segments_to_qa_ndjson(df: DataFrame) -> DataFrame:
    """SNK-2. Only ids."""
    return df.select("segment_id", F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("segment_id").alias("id"))).alias("line"))


def edges_to_ndjson(df: DataFrame, county: str | None = None) -> DataFrame:
    """SNK-3."""
    held = df if county is None else df.where(F.upper("county") == county.upper())
    return with_layer(held, "tmc", F.col("f_system"), BY_SYSTEM, df.columns)


def inventory_class(df: DataFrame) -> Column:
    """SNK-4. ``functional_class % 10``, 8 if absent."""
    return F.coalesce(F.col("functional_class"), F.lit(8)) % 10


def inventory_to_ndjson(df: DataFrame) -> DataFrame:
    """SNK-4."""
    return with_layer(df, "fid", inventory_class(df), BY_CLASS, df.columns)


def inventory_layers(df: DataFrame, county: str | None = None, qa: bool = False) -> DataFrame:
    """SNK-11."""
    held = df if county is None else df.where(F.upper("county_name") == county.upper())
    table = BY_SYSTEM | {8: ("local", 12), 9: ("local", 12)}
    return with_layer(held, "fid", inventory_class(held), table, ["fid"] if qa else held.columns)


def export_flat(df: DataFrame) -> DataFrame:
    """SNK-6. coords (array of struct lon, lat) as well-known text."""
    text = F.transform("coords", lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string")))
    return df.withColumn("wkt", F.concat(F.lit("LINESTRING ("), F.array_join(text, ", "), F.lit(")"))).drop("coords")


def refs_by_class(df: DataFrame, path: str) -> None:
    """SNK-7. One folder for each least road class."""
    df.write.partitionBy("min_road_class").mode("overwrite").parquet(path)


def write_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """NDJSON files of a ``line`` column."""
    df.select("line").write.mode("overwrite").text(path, compression=compression)


def to_feature_collection(df: DataFrame, group: str) -> DataFrame:
    """SNK-8. Features of a group as one collection; NDJSON is the form for whole tables."""
    return df.groupBy(group).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.sort_array(F.collect_list("feature")).alias("features"))).alias("collection"))


def from_feature_collection(df: DataFrame) -> DataFrame:
    """SNK-8, back."""
    return df.select(F.explode(F.from_json("collection", "type string, features array<string>")["features"]).alias("feature"))


def merge_years(years: dict[int, DataFrame]) -> DataFrame:
    """SNK-9. Yearly layers under ``year_layer``."""
    out = None
    for year, df in years.items():
        part = df.withColumn("layer", F.concat_ws("_", F.lit(str(year)), "layer"))
        out = part if out is None else out.unionByName(part)
    return out


def conflation_metadata(**parts: DataFrame) -> DataFrame:
    """SNK-10, JN-17. One row with the JSON of every input's one-row metadata."""
    out = None
    for name, df in parts.items():
        row = df.limit(1).select(F.to_json(F.struct(*df.columns)).alias(name))
        out = row if out is None else out.crossJoin(F.broadcast(row))
    return out


def edge_endpoints(df: DataFrame) -> DataFrame:
    """SNK-12. Both ends of every edge (edge_id, class, coords) as points."""
    ends = F.array(F.struct(F.lit("start").alias("end"), F.element_at("coords", 1).alias("p")), F.struct(F.lit("end").alias("end"), F.element_at("coords", -1).alias("p")))
    return df.select("edge_id", "road_class", F.explode(ends).alias("e")).select("edge_id", "road_class", "e.end", "e.p.lon", "e.p.lat")


def intersection_layer(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """SNK-13. Nodes with the least class of the references that touch them (6 if none) and its tile hint."""
    touch = refs.select(F.explode(F.array("from_node", "to_node")).alias("node"), "road_class").groupBy("node").agg(F.min("road_class").alias("c"))
    met = nodes.join(touch, "node", "left").withColumn("road_class", F.coalesce("c", F.lit(6))).drop("c")
    return met.withColumn("hint", tile_hint(F.col("road_class"), BY_CLASS)).select("node", "road_class", "hint.layer", "hint.minzoom")


def compact_layers(refs: DataFrame, edges: DataFrame) -> DataFrame:
    """SNK-14. (layer, id, code): references with their class (6 if absent), edges with their code."""
    a = refs.select(F.lit("base").alias("layer"), F.xxhash64("ref_id").alias("id"), F.coalesce("road_class", F.lit(6)).cast("string").alias("code"))
    return a.unionByName(edges.select(F.lit("segments").alias("layer"), F.xxhash64("edge_id").alias("id"), F.col("target_map_id").alias("code")))


def path_lines(vertices: DataFrame) -> DataFrame:
    """SNK-15. A path's merged vertices as well-known text."""
    c = vertices.groupBy("line_id").agg(F.sort_array(F.collect_list(F.struct("pt_idx", F.col("x").alias("lon"), F.col("y").alias("lat")))).alias("coords"))
    return export_flat(c)


def conflation_rows(segments: DataFrame, refs: DataFrame, directions: DataFrame, tags: DataFrame) -> DataFrame:
    """JN-13. Segments with their reference, travel directions and way tags."""
    out = segments.join(refs.select("ref_id", "road_class"), "ref_id")
    return out.join(directions, "target_map_id", "left").join(tags, "way_id", "left")


def conflation_mappings(segments: DataFrame, map_name: str, keys: list[str] | None = None) -> DataFrame:
    """JN-14. (segment_id, edge_id) of one map; ``keys`` are other columns that name a segment."""
    return segments.where(F.col(f"{map_name}.edge_id").isNotNull()).select(*(keys or ["segment_id"]), F.col(f"{map_name}.edge_id").alias("edge_id"))


