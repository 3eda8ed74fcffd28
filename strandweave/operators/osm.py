"""Ways and nodes: canonical nodes, equivalent ways, and ways placed on base references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def drop_repeats(ids: Column) -> Column:
    """UDF-4. An array without immediate repeats."""
    return F.filter(ids, lambda x, i: (i == 0) | (x != F.get(ids, i - 1)))


def way_nodes(ways: DataFrame) -> DataFrame:
    """GRF-13. (way_id, node_idx, node_id) from node id arrays."""
    return ways.select("way_id", F.posexplode("node_ids").alias("node_idx", "node_id"))


def canonical_node_ids(nodes: DataFrame, way_nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """GRF-12, WIN-5. (node_id, canonical_id): of the nodes at one coordinate (6 decimals) the first by
    intersection (on several ways), best road class, id."""
    use = way_nodes.join(classes, "way_id", "left").groupBy("node_id").agg((F.count_distinct("way_id") > 1).cast("int").alias("crossing"), F.min(F.coalesce("road_class", F.lit(9))).alias("best_class"))
    ranked = nodes.select("node_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")).join(use, "node_id", "left")
    order = F.struct(-F.coalesce("crossing", F.lit(0)), F.coalesce("best_class", F.lit(9)), F.col("node_id"))
    best = ranked.groupBy("lon", "lat").agg(F.min_by("node_id", order).alias("canonical_id"))
    return ranked.join(best, ["lon", "lat"]).select("node_id", "canonical_id")


def canonical_ways(way_nodes: DataFrame, canonical: DataFrame) -> DataFrame:
    """GRF-12. (way_id, canonical_nodes, array_id): node arrays by canonical node without immediate repeats."""
    seq = way_nodes.join(canonical, "node_id").groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("node_idx", "canonical_id"))).alias("s"))
    ids = seq.select("way_id", F.transform("s", lambda x: x["canonical_id"]).alias("ids"))
    return ids.select("way_id", drop_repeats(F.col("ids")).alias("canonical_nodes")).withColumn("array_id", F.xxhash64("canonical_nodes"))


def equivalent_ways(canonical: DataFrame) -> DataFrame:
    """JN-16. (way_id, first_way_id): ways that share their canonical nodes with others, by the smallest id of their
    class; a class of n ways is n rows and not their pairs."""
    classes = canonical.groupBy("array_id", "canonical_nodes").agg(F.min("way_id").alias("first_way_id"), F.count("*").alias("n")).where("n > 1")
    return canonical.join(classes, ["array_id", "canonical_nodes"]).select("way_id", "first_way_id")


def canonical_violations(canonical: DataFrame) -> DataFrame:
    """DQ-14. Nodes with more than one canonical node."""
    return canonical.groupBy("node_id").agg(F.count_distinct("canonical_id").alias("n")).where("n > 1")


def way_sections(way_nodes: DataFrame, ref_nodes: DataFrame) -> DataFrame:
    """SEC-6. (way_id, ref_id, is_forward, n_nodes, from_idx, to_idx): the longest run of nodes, in equal or opposite
    order, that a way shares with a reference; runs of one node have no length and go.

    A run is an island of equal index difference (same order) or equal sum (opposite order) without gaps.
    """
    met = way_nodes.join(ref_nodes.select("ref_id", "node_id", F.col("node_idx").alias("ref_idx")), "node_id")
    runs = None
    for forward, island in ((1, F.col("ref_idx") - F.col("node_idx")), (0, F.col("ref_idx") + F.col("node_idx"))):
        lane = met.select("way_id", "ref_id", "node_idx", "ref_idx", island.alias("lane"))
        order = Window.partitionBy("way_id", "ref_id", "lane").orderBy("node_idx")
        part = lane.withColumn("run", F.col("node_idx") - F.row_number().over(order))
        part = part.groupBy("way_id", "ref_id", "lane", "run").agg(F.count("*").alias("n_nodes"), F.min("ref_idx").alias("from_idx"), F.max("ref_idx").alias("to_idx")).withColumn("is_forward", F.lit(forward))
        runs = part if runs is None else runs.unionByName(part)
    order = F.struct("n_nodes", "is_forward", -F.col("from_idx"))
    best = runs.where("n_nodes > 1").groupBy("way_id", "ref_id").agg(F.max_by(F.struct("is_forward", "n_nodes", "from_idx", "to_idx"), order).alias("b"))
    return best.select("way_id", "ref_id", "b.*")


def refs_for_node_sequence(seqs: DataFrame, section_nodes: DataFrame) -> DataFrame:
    """JN-10. Steps of a sequence that are also a step of a geometry: (seq_id, geometry_id, node_idx, step 1 or -1)."""
    pair = lambda df, key: df.withColumn("__next", F.lead("node_id").over(Window.partitionBy(key).orderBy("node_idx"))).where("__next IS NOT NULL")
    s = pair(seqs, "seq_id").select("seq_id", "node_idx", F.col("node_id").alias("a"), F.col("__next").alias("b"))
    g = pair(section_nodes, "geometry_id").select("geometry_id", F.col("node_id").alias("a"), F.col("__next").alias("b"))
    both = g.withColumn("step", F.lit(1)).unionByName(g.select("geometry_id", F.col("b").alias("a"), F.col("a").alias("b"), F.lit(-1).alias("step")))
    return s.join(both, ["a", "b"]).select("seq_id", "geometry_id", "node_idx", "step").distinct()


def infer_directions(steps: DataFrame, refs: DataFrame) -> DataFrame:
    """JN-11. (seq_id, ref_id): forward references where all steps go with the geometry, backward where all go
    against it, both where they are mixed."""
    ways = steps.groupBy("seq_id", "geometry_id").agg(F.max("step").alias("hi"), F.min("step").alias("lo"))
    return ways.join(refs.select("geometry_id", "ref_id", "is_forward"), "geometry_id").where("(hi = 1 AND is_forward = 1) OR (lo = -1 AND is_forward = 0)").select("seq_id", "ref_id").distinct()


def ways_with_refs(sections: DataFrame, refs: DataFrame) -> DataFrame:
    """JN-15. References of class under 8 by way, as an ordered array."""
    return sections.join(refs.where("road_class < 8").select("ref_id"), "ref_id").groupBy("way_id").agg(F.array_sort(F.collect_set("ref_id")).alias("ref_ids"))


def match_by_node_sequence(strategies: dict[str, DataFrame], section_nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """GEO-19. References of supplied node sequences, tagged with the strategy that supplied them."""
    out = None
    for name, seqs in strategies.items():
        part = infer_directions(refs_for_node_sequence(seqs, section_nodes), refs).withColumn("strategy", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
