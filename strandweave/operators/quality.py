"""Checks of inputs, references, matches and assignments; each returns the rows that fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strandweave.operators.sections import overlapping
from strandweave.operators.snapshots import union_rules

SECTION = ["ref_id", "edge_id", "is_forward", "section_start", "section_end"]


def rule_violations(assigned: DataFrame) -> DataFrame:
    """DQ-1. Assignments that overlap another edge's on their reference, have no length, or repeat a key."""
    over = overlapping(assigned, assigned, differs="edge_id")
    flat = assigned.where("section_start >= section_end")
    twice = assigned.join(assigned.groupBy("ref_id", "edge_id").count().where("count > 1").drop("count"), ["ref_id", "edge_id"], "left_semi")
    return union_rules({"overlap": over, "no_length": flat, "repeated_key": twice}, SECTION)


def split_rejects(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """DQ-2. (the first row of each key, the others)."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank"), ranked.where("__rank > 1").drop("__rank")


def missing_geometry(df: DataFrame, coords: str = "coords") -> DataFrame:
    """DQ-3. Rows without geometry."""
    return df.where(F.col(coords).isNull() | (F.size(coords) == 0))


def always_null_columns(df: DataFrame) -> DataFrame:
    """DQ-4. (column) without any value, from one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in df.columns])
    return counts.select(F.explode(pairs).alias("p")).where("p.n = 0").select("p.column")


def schema_diff(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """DQ-5. Columns that are missing or unexpected."""
    have, want = set(df.columns), set(schema.fieldNames())
    return {"missing": sorted(want - have), "unexpected": sorted(have - want)}


def checked(df: DataFrame, checks: dict[str, Column], key: str) -> DataFrame:
    """(key, failed): one row for each check that a row fails; null inputs pass, as in SQL."""
    failed = F.filter(F.array(*[F.when(F.coalesce(~ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(failed).alias("failed"))


def check_segments(df: DataFrame) -> DataFrame:
    """DQ-6. Domains of segment attributes; years before 2018 may lack them."""
    c = F.col
    percent = {p: c(p).between(0, 100) for p in ("aadt_singl", "aadt_combi", "nhs_pct") if p in df.columns}
    return checked(df, {"f_system": c("f_system").between(1, 7) | (c("year") < 2018), "faciltype": c("faciltype").between(1, 6), "route_sign": c("route_sign").between(1, 10) | (c("year") < 2018), **percent}, "tmc")


def check_inventory(df: DataFrame) -> DataFrame:
    """DQ-7. Mileposts in order, direction 0-2, class 1-19; rows whose route and milepost repeat."""
    c = F.col
    n = F.count("*").over(Window.partitionBy("gis_id", "beg_mp"))
    return checked(df.withColumn("__n", n), {"mileposts": c("beg_mp") < c("end_mp"), "direction": c("direction").between(0, 2), "class": c("functional_class").between(1, 19), "repeated": c("__n") == 1}, "fid")


def check_geometry(df: DataFrame, key: str, points: str, multi: bool = False) -> DataFrame:
    """DQ-8. Lines of fewer than two vertices, multi-part lines of fewer than two parts."""
    ok = (F.size(points) >= 2) & (F.forall(points, lambda p: F.size(p) >= 2) if multi else F.lit(True))
    return checked(df, {"vertices": ok}, key)


def check_references(df: DataFrame) -> DataFrame:
    """DQ-9. References: locations numbered without gaps, ends equal to the first and last, known codes, nothing empty."""
    c = F.col
    locations = c("locations")
    numbered = F.size(F.filter(locations, lambda x, i: x["seq"] != i + 1)) == 0
    return checked(df, {
        "locations": F.size(locations) >= 2,
        "sequence": numbered,
        "from": F.element_at(locations, 1)["node"] == c("from_node"),
        "to": F.element_at(locations, -1)["node"] == c("to_node"),
        "road_class": c("road_class").between(0, 8),
        "form_of_way": c("form_of_way").between(0, 7),
        "length": c("length_km") > 0,
    }, "ref_id")


def broken_locations(refs: DataFrame, ends: DataFrame) -> DataFrame:
    """DQ-10. References whose line does not end at its location points. ``ends``: ref_id, x1, y1, x2, y2."""
    first, last = F.element_at("locations", 1), F.element_at("locations", -1)
    return refs.join(ends, "ref_id").where((first["x"] != F.col("x1")) | (first["y"] != F.col("y1")) | (last["x"] != F.col("x2")) | (last["y"] != F.col("y2"))).select("ref_id")


def check_conflation(df: DataFrame, maps: list[str]) -> DataFrame:
    """DQ-11. Pieces within their reference, with assignments that overlap them."""
    c = F.col
    ok = {"order": c("part_start") < c("part_end"), "within": (c("part_start") >= 0) & (c("part_end") <= c("length_km"))}
    for m in maps:
        ok[m] = (c(f"{m}.section_start") < c("part_end")) & (c("part_start") < c(f"{m}.section_end"))
    return checked(df, ok, "segment_id")


def check_chosen(df: DataFrame) -> DataFrame:
    """DQ-12. Chosen matches: 0 <= start < end, deviance not negative."""
    c = F.col
    return checked(df.withColumn("key", F.struct("path_id", "path_edge_idx", "is_forward", "ref_id")), {"start": c("section_start") >= 0, "order": c("section_start") < c("section_end"), "deviance": c("avg_deviance_km") >= 0}, "key").select("key.*", "failed")


def duplicate_metadata(df: DataFrame, key: str = "geometry_id") -> DataFrame:
    """DQ-13. Geometries with several metadata rows, and whether they disagree."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*rest)).alias("n_kinds")).where("n > 1").select(key, "n", (F.col("n_kinds") > 1).alias("disagree"))


def anomalies(rows: DataFrame, key: str) -> DataFrame:
    """DQ-15. Base-map records that lack what they need: (key, failed)."""
    c = F.col
    ok = {}
    if "locations" in rows.columns:
        ok["empty_locations"] = F.size("locations") > 0
    if "way_sections" in rows.columns:
        ok["no_metadata"] = F.size("way_sections") > 0
    if "coords" in rows.columns:
        ok["bad_coordinates"] = F.forall("coords", lambda p: p["lon"].between(-180, 180) & p["lat"].between(-90, 90))
    return checked(rows.where(c(key).isNotNull()), ok, key)


def require_complete(tables: dict[str, DataFrame]) -> None:
    """DQ-17. Fails if a table that the map needs is empty."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"these tables are empty: {', '.join(empty)}")
