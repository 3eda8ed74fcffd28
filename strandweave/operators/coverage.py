"""How much of each edge, path and map the chosen, assigned and final sections cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _km() -> Column:
    return F.col("section_end") - F.col("section_start")


def _near(c: Column, digits: int) -> Column:
    """Rounded after a nudge, so that engines agree on decimal ties."""
    return F.round(c + 1e-9, digits)


def path_edge_stats(edges: DataFrame, path_edges: DataFrame, chosen: DataFrame, last: DataFrame) -> DataFrame:
    """AGG-2. Per path edge and direction: chosen km, total deviance weighted by length, whether it begins or ends the path that way."""
    sums = chosen.groupBy("path_id", "path_edge_idx", "edge_id", "is_forward").agg(_near(F.sum(_km()), 4).alias("chosen_km"), _near(F.sum(F.col("avg_deviance_km") * _km()), 8).alias("total_deviance"))
    first, final = F.col("path_edge_idx") == 0, F.col("path_edge_idx") == F.col("last_idx")
    forward = F.col("is_forward") == 1
    return (
        sums.join(last.select("path_id", "last_idx"), "path_id")
        .join(edges.select("edge_id", "edge_length_km", "is_unidirectional"), "edge_id")
        .select("path_id", "path_edge_idx", "edge_id", "is_forward", "is_unidirectional", "edge_length_km", "chosen_km", "total_deviance", ((forward & first) | (~forward & final)).alias("is_first"), ((forward & final) | (~forward & first)).alias("is_last"))
    )


def path_edge_ratios(stats: DataFrame) -> DataFrame:
    """AGG-3. Length difference and ratio, average deviance; null for a division by zero."""
    return stats.withColumns({
        "length_diff": _near(F.col("edge_length_km") - F.col("chosen_km"), 4),
        "length_ratio": _near(F.try_divide("chosen_km", "edge_length_km"), 4),
        "avg_deviance": _near(F.try_divide("total_deviance", "chosen_km"), 6),
    })


def direction_pivot(ratios: DataFrame) -> DataFrame:
    """JN-5. Forward and backward measures of one path edge on one row; edges that have both."""
    side = lambda f, p: ratios.where(F.col("is_forward") == f).select("path_id", "edge_id", F.col("path_edge_idx").alias(f"{p}_idx"), F.col("avg_deviance").alias(f"{p}_deviance"), F.col("chosen_km").alias(f"{p}_km"), *(["is_unidirectional", "edge_length_km"] if f else []))
    return side(1, "forward").join(side(0, "backward"), ["path_id", "edge_id"])


def preferred_direction(ratios: DataFrame) -> DataFrame:
    """AGG-4. The direction in which a one-way edge fits better, and whether that is sure: deviances over 10 %
    apart, and the better side covers 90-115 % of the edge or as much as the other within 10 % of it."""
    d = direction_pivot(ratios).where("is_unidirectional = 1")
    forward = F.col("forward_deviance") < F.col("backward_deviance")
    chosen = F.when(forward, F.col("forward_km")).otherwise(F.col("backward_km"))
    ratio = F.try_divide(F.greatest("forward_deviance", "backward_deviance"), F.least("forward_deviance", "backward_deviance"))
    covers = _near(F.try_divide(chosen, F.col("edge_length_km")), 6).between(0.9, 1.15)
    alike = _near(F.try_divide(F.abs(F.col("forward_km") - F.col("backward_km")), F.col("edge_length_km")), 6) < 0.1
    return d.select("path_id", "edge_id", "forward_idx", "backward_idx", forward.alias("forward_preferred"), _near(ratio, 6).alias("deviance_ratio"), (_near(ratio, 6) > 1.1).alias("deviance_sufficient"), (covers | alike).alias("distance_sufficient"))


def assignment_metrics(edges: DataFrame, assigned: DataFrame) -> DataFrame:
    """AGG-5. Kilometres assigned forward and backward to every edge, null for none."""
    side = lambda f: F.sum(F.when(F.col("is_forward") == f, _km()))
    sums = assigned.groupBy("edge_id").agg(_near(side(1), 4).alias("forward_km"), _near(side(0), 4).alias("backward_km"))
    return edges.join(sums, "edge_id", "left").select("edge_id", "edge_length_km", "is_unidirectional", F.nullif("forward_km", F.lit(0.0)).alias("forward_km"), F.nullif("backward_km", F.lit(0.0)).alias("backward_km"))


def matching_stats(metrics: DataFrame) -> DataFrame:
    """AGG-6. Differences to the edge's length and the class of the larger one: under 5, 10, 100 m, or more."""
    diff = lambda c: _near(F.col("edge_length_km") - F.col(c), 4)
    most = F.greatest(F.abs("forward_diff"), F.abs("backward_diff"))
    return metrics.withColumns({"forward_diff": diff("forward_km"), "backward_diff": diff("backward_km")}).withColumn("worst_diff", most).withColumns({
        "under_5m": F.coalesce(F.col("worst_diff") < 0.005, F.lit(False)),
        "from_5_to_10m": F.coalesce((F.col("worst_diff") >= 0.005) & (F.col("worst_diff") < 0.01), F.lit(False)),
        "from_10_to_100m": F.coalesce((F.col("worst_diff") >= 0.01) & (F.col("worst_diff") < 0.1), F.lit(False)),
        "over_100m": F.coalesce(F.col("worst_diff") >= 0.1, F.lit(False)),
    })


def assignment_summary(stats: DataFrame) -> DataFrame:
    """AGG-7. Edges, matched edges and the share of each class among the matched."""
    share = lambda c: F.round(F.try_divide(F.count_if(c).cast("double"), F.count("worst_diff").cast("double")) + 1e-9, 5).alias(f"share_{c}")
    return stats.agg(F.count("*").alias("n_edges"), F.count("worst_diff").alias("n_matched"), *[share(c) for c in ("under_5m", "from_5_to_10m", "from_10_to_100m", "over_100m")])


def path_coverage(path_edges: DataFrame, assigned: DataFrame) -> DataFrame:
    """AGG-8. Distinct edges of a path, and those with assignments."""
    has = assigned.select("edge_id", F.lit(True).alias("has")).distinct()
    return path_edges.join(has, "edge_id", "left").groupBy("path_id").agg(F.count_distinct("edge_id").alias("n_edges"), F.count_distinct(F.when(F.col("has"), F.col("edge_id"))).alias("n_assigned"))


def qa_lengths(edges: DataFrame, assigned: DataFrame, primary_only: bool = True) -> DataFrame:
    """AGG-15, REP-2. Segment length by map id and direction against the edge's."""
    kept = edges.where("is_primary = 1") if primary_only else edges
    side = lambda f: F.sum(F.when(F.col("is_forward") == f, _km()))
    sums = assigned.groupBy("edge_id").agg(_near(side(1), 6).alias("forward_km"), _near(side(0), 6).alias("backward_km"), F.count("*").alias("n_segments"))
    return kept.join(sums, "edge_id", "left").select("target_map_id", F.round("edge_length_km", 6).alias("edge_km"), "forward_km", "backward_km", F.coalesce("n_segments", F.lit(0)).alias("n_segments"))


def grouped(df: DataFrame, keys: list[str], members: list[str], name: str = "members") -> DataFrame:
    """AGG-16, AGG-17, AGG-18, REP-1. Rows of a key as an ordered array of structs."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*members))).alias(name))


def match_metadata(matches: DataFrame, edges: DataFrame, refs: DataFrame, members: list[str]) -> DataFrame:
    """REP-1. Candidate or chosen matches by map id, with their reference's metadata."""
    met = matches.join(edges.select("edge_id", "target_map_id"), "edge_id").join(refs.select("ref_id", "geometry_id", "road_class", "form_of_way"), "ref_id", "left")
    return grouped(met, ["target_map_id"], [*members, "geometry_id", "road_class", "form_of_way"], "matches")


def match_acceptance(edges: DataFrame, chosen: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """DQ-16. Per direction: edges with matches, and the share whose matched length is within ``tolerance`` of their own."""
    sums = chosen.groupBy("path_id", "edge_id", "is_forward").agg(_near(F.sum(_km()), 4).alias("km"))
    off = F.abs(F.col("km") - F.col("edge_length_km"))
    return sums.join(edges.select("edge_id", "edge_length_km"), "edge_id").groupBy("is_forward").agg(F.count("*").alias("n"), F.count_if(_near(off, 4) <= _near(F.col("edge_length_km") * tolerance, 4)).alias("n_accepted"))
