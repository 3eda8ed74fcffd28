"""Graphs of directed edges: nodes, sources and sinks, shortest paths, and paths along routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.operators.components import connected_components
from strandweave.operators.geometry import bearing, haversine
from strandweave.plans.cut import Log, cut, release


def build_graph(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """GRF-1. (nodes, edges with from_node and to_node) from end coordinates x1, y1, x2, y2; a node is named by its coordinate's hash."""
    node = lambda x, y: F.xxhash64(x, y)
    out = edges.withColumns({"from_node": node("x1", "y1"), "to_node": node("x2", "y2")})
    ends = F.array(F.struct(F.col("from_node").alias("node_id"), F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("to_node").alias("node_id"), F.col("x2").alias("x"), F.col("y2").alias("y")))
    return out.select(F.explode(ends).alias("n")).select("n.*").distinct(), out


def degrees(refs: DataFrame) -> DataFrame:
    """(node, n_in, n_out, geometries): what touches each node."""
    ends = F.array(F.struct(F.col("from_node").alias("node"), F.lit(1).alias("o")), F.struct(F.col("to_node").alias("node"), F.lit(0).alias("o")))
    each = refs.select("geometry_id", F.explode(ends).alias("e")).select("geometry_id", "e.*")
    return each.groupBy("node").agg(F.count_if(F.col("o") == 0).alias("n_in"), F.count_if(F.col("o") == 1).alias("n_out"), F.count_distinct("geometry_id").alias("n_geometries"))


def sources_sinks(refs: DataFrame) -> DataFrame:
    """GRF-2. Nodes that only begin or only end edges, and two-way dead ends whose edges share one geometry."""
    d = degrees(refs)
    dead_end = (F.col("n_in") > 0) & (F.col("n_out") > 0) & (F.col("n_geometries") == 1)
    return d.select("node", ((F.col("n_in") == 0) | dead_end).alias("is_source"), ((F.col("n_out") == 0) | dead_end).alias("is_sink")).where("is_source OR is_sink")


def forks(refs: DataFrame) -> DataFrame:
    """GRF-5. Nodes that touch more than two geometries, or two with unlike numbers of edges in and out."""
    return degrees(refs).where("n_geometries > 2 OR (n_geometries = 2 AND n_in <> n_out)").select("node", "n_geometries", "n_in", "n_out")


def multi_edges(refs: DataFrame) -> DataFrame:
    """GRF-5. Node pairs with several edges in one direction."""
    return refs.groupBy("from_node", "to_node").agg(F.count("*").alias("n_edges")).where("n_edges > 1")


def components(refs: DataFrame) -> DataFrame:
    """GRF-3. (node, component)."""
    return connected_components(refs, "from_node", "to_node")


def source_sink_pairs(refs: DataFrame) -> DataFrame:
    """GRF-3. Sources with the sinks that they reach: the search from a source meets no other part of its component."""
    ends = cut(sources_sinks(refs), "ends")
    edges = refs.select(F.lit(0).alias("grp"), F.col("ref_id").alias("edge_id"), "from_node", "to_node", F.lit(1.0).alias("weight"), F.lit(0).alias("road_class"))
    reached = shortest_paths(edges, ends.where("is_source").select(F.lit(0).alias("grp"), F.col("node").alias("source")))
    return reached.join(ends.where("is_sink").select("node"), "node", "left_semi").where("source <> node").select("source", F.col("node").alias("sink"))


def best_parallel(edges: DataFrame) -> DataFrame:
    """Of edges between the same nodes of a group the first by weight, class, id."""
    keep = F.min_by(F.struct("edge_id", "weight"), F.struct("weight", "road_class", "edge_id"))
    return edges.groupBy("grp", "from_node", "to_node").agg(keep.alias("k")).select("grp", "from_node", "to_node", "k.*")


def shortest_paths(edges: DataFrame, sources: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """GRF-4, CHO-5. (grp, source, node, dist, pred, hops, first) for all sources of all groups at once; ``first`` is the
    path's node after the source. With ``targets`` (grp, source, sink) a search ends with its last target, and nodes
    farther than all its open targets are dropped.

    Label setting: a step settles every open node that no later arrival can reach as early, which is so if it is
    nearer than each open node with the lightest edge that leaves that one, or if, less the lightest edge that enters it,
    it is nearer than all of them. A settled node goes to a log that is only added to, and its edges are followed
    once; a step rewrites the open nodes alone. Of equal distances the path with fewer edges, then the smaller
    predecessor wins, so that a part of a path is the path between its ends. Weights are not negative, and rounded to
    1e-9 so that equal sums are equal. ``edges``: grp, edge_id, from_node, to_node, weight, road_class; ``sources``: grp,
    source.
    """
    search, at = ["grp", "source"], ["grp", "source", "node"]
    best = cut(best_parallel(edges).drop("edge_id"), "edges")
    leaving = best.groupBy("grp", F.col("from_node").alias("to_node")).agg(F.min("weight").alias("away"))
    entering = best.groupBy("grp", "to_node").agg(F.min("weight").alias("near"))
    e = cut(best.join(entering, ["grp", "to_node"]).join(leaving, ["grp", "to_node"], "left").withColumn("away", F.coalesce("away", F.lit(float("inf")))), "edges")
    asked = cut(targets.select(*search, "sink").distinct(), "targets") if targets is not None else None
    fresh = cut(sources.select("grp", "source", F.col("source").alias("node"), F.lit(0.0).alias("dist"), F.lit(None).cast("long").alias("pred"), F.lit(0).alias("hops"), F.lit(None).cast("long").alias("first")).distinct(), "settled")
    own = lambda t: (t.where("done") if "done" in t.columns else t).select(*at, "dist", "pred", "hops", "first")
    settled, open_ = Log(fresh, view=own), None
    while True:
        on = fresh.join(e, (fresh["grp"] == e["grp"]) & (fresh["node"] == e["from_node"]))
        arrivals = on.select(fresh["grp"], "source", F.col("to_node").alias("node"), F.round(F.col("dist") + F.col("weight"), 9).alias("dist"), F.col("from_node").cast("long").alias("pred"), (F.col("hops") + 1).alias("hops"), F.coalesce("first", "to_node").cast("long").alias("first"), "near", "away")
        each = arrivals if open_ is None else arrivals.unionByName(open_)
        least = each.groupBy(*at).agg(F.min(F.struct("dist", "hops", "pred", "first")).alias("a"), F.any_value("near").alias("near"), F.any_value("away").alias("away"))
        had = settled.rows().select(*at)
        reached = least.select(*at, "a.*", "near", "away").join(had, at, "left_anti")
        limits = [F.min("dist").alias("lo"), F.min(F.round(F.col("dist") + F.col("away"), 9)).alias("ahead")]
        if asked is None:
            bounded = reached.join(reached.groupBy(*search).agg(*limits), search)
        else:
            # where every target still open has been reached, none lies beyond the farthest of those arrivals
            left = asked.join(had.withColumnRenamed("node", "sink"), [*search, "sink"], "left_anti")
            wanted = left.groupBy(*search).agg(F.count("*").alias("n_left"))
            reached = reached.join(left.withColumnRenamed("sink", "node").withColumn("goal", F.lit(True)), at, "left")
            limits += [F.count("goal").alias("n_met"), F.max(F.when(F.col("goal"), F.col("dist"))).alias("bound")]
            bounded = reached.join(reached.groupBy(*search).agg(*limits).join(wanted, search), search).where("n_met < n_left OR dist <= bound").drop("goal", "n_met", "n_left", "bound")
        done = (F.col("dist") == F.col("lo")) | (F.col("dist") < F.col("ahead")) | (F.round(F.col("dist") - F.col("near"), 9) < F.col("lo"))
        judged = cut(bounded.withColumn("done", done).drop("lo", "ahead"), "judged")
        if judged.isEmpty():
            release(best, e, judged, *([asked] if asked is not None else []))
            return settled.rows()
        settled.add(judged)
        fresh, open_ = own(judged), judged.where("NOT done").drop("done")


def path_nodes(paths: DataFrame, targets: DataFrame) -> DataFrame:
    """GRF-4. (grp, source, sink, idx, node): the nodes of the shortest paths to (grp, source, sink), by walking predecessors."""
    at = cut(targets.join(paths.withColumnRenamed("node", "sink"), ["grp", "source", "sink"]).select("grp", "source", "sink", F.col("sink").alias("node"), "pred", F.col("hops").alias("idx")), "walk")
    walked = at
    while True:
        on = at.where("pred IS NOT NULL").select("grp", "source", "sink", F.col("pred").alias("node"))
        if on.isEmpty():
            return walked.select("grp", "source", "sink", "idx", "node")
        at = cut(on.join(paths, ["grp", "source", "node"]).select("grp", "source", "sink", "node", "pred", F.col("hops").alias("idx")), "walk")
        walked = walked.unionByName(at)


def route_paths_milepost(edges: DataFrame, gap_km: float = 0.003) -> DataFrame:
    """GRF-7. (route_id, path_no, path_edge_idx, edge_id): a route's edges by milepost, broken where the next edge
    begins more than ``gap_km`` from the last one's end. ``edges``: route_id, edge_id, beg_mp, x1, y1, x2, y2."""
    order = Window.partitionBy("route_id").orderBy("beg_mp", "edge_id")
    gap = haversine(F.lag("x2").over(order), F.lag("y2").over(order), F.col("x1"), F.col("y1"))
    broken = edges.withColumn("gap", gap).withColumn("path_no", F.sum(F.coalesce(F.col("gap") > gap_km, F.lit(False)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return broken.select("route_id", "path_no", (F.row_number().over(Window.partitionBy("route_id", "path_no").orderBy("beg_mp", "edge_id")) - 1).alias("path_edge_idx"), "edge_id")


def route_paths_topological(edges: DataFrame) -> DataFrame:
    """GRF-6. (route_id, source, sink, splice, path_edge_idx, edge_id): a route's shortest paths (by number of edges)
    that are part of no longer one, from all of its nodes, so that two-way streets and rings have theirs.

    A path to a node that precedes another on the way from its source is part of a longer one, and so is a path that the
    path from a node before its source to the same end runs through: since parts of the chosen paths are
    chosen paths, both are looked up by end nodes, without a comparison of sequences. Of parallel edges the
    first is on the path; for each of the others there is a splice, named by its edge: the path's edge
    before, the parallel one and the path's edge after. A ring of n edges has n paths, each without one of
    them. ``edges``: route_id, edge_id, from_node, to_node, weight, road_class.
    """
    e = edges.where("from_node <> to_node").select(F.col("route_id").alias("grp"), "edge_id", "from_node", "to_node", "weight", "road_class")
    trees = cut(shortest_paths(e.withColumn("weight", F.lit(1.0)), e.select("grp", F.col("from_node").alias("source")).distinct()), "trees")
    leaves = trees.where("pred IS NOT NULL").join(trees.select("grp", "source", F.col("pred").alias("node")), ["grp", "source", "node"], "left_anti")
    longest = leaves.join(trees.where("first <> node").select("grp", F.col("first").alias("source"), "node"), ["grp", "source", "node"], "left_anti")
    whole = cut(path_nodes(trees, longest.select("grp", "source", F.col("node").alias("sink"))), "nodes")
    path = ["grp", "source", "sink"]
    steps = whole.withColumn("to_node", F.lead("node").over(Window.partitionBy(*path).orderBy("idx"))).where("to_node IS NOT NULL").withColumnRenamed("node", "from_node")
    place = F.row_number().over(Window.partitionBy("grp", "from_node", "to_node").orderBy("weight", "road_class", "edge_id"))
    met = cut(steps.join(e.withColumn("place", place).select("grp", "from_node", "to_node", "edge_id", "place"), ["grp", "from_node", "to_node"]).select(*path, "idx", "edge_id", "place"), "steps")
    main = met.where("place = 1").select(*path, "idx", "edge_id")
    others = met.where("place > 1").select(*path, F.col("edge_id").alias("splice"), F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("idx") + k).alias("idx")) for k in (-1, 0, 1)])).alias("at")).select(*path, "splice", "at.*")
    spliced = others.join(main, [*path, "idx"]).select(*path, "splice", F.when(F.col("k") == 0, F.col("splice")).otherwise(F.col("edge_id")).alias("edge_id"), "idx")
    own = Window.partitionBy(*path, "splice").orderBy("idx")
    both = main.select(*path, F.lit(None).cast(e.schema["edge_id"].dataType).alias("splice"), "idx", "edge_id").unionByName(spliced.withColumn("idx", F.row_number().over(own) - 1))
    return both.select(F.col("grp").alias("route_id"), "source", "sink", "splice", F.col("idx").alias("path_edge_idx"), "edge_id")


def clean_route(route: Column) -> Column:
    """GRF-8. Lower case, runs of other characters than letters, digits and colons as ``_``."""
    return F.regexp_replace(F.lower(route), "[^a-z0-9:]+", "_")


def load_paths(path_edges: DataFrame, ends: DataFrame) -> DataFrame:
    """GRF-8. (route_id, path_no) sequences as path records: name, bearing from the first edge's start to the last's end, edges."""
    e = path_edges.join(ends, "edge_id").groupBy("route_id", "path_no").agg(F.sort_array(F.collect_list(F.struct("path_edge_idx", "edge_id"))).alias("s"), F.min_by(F.struct("x1", "y1"), "path_edge_idx").alias("a"), F.max_by(F.struct("x2", "y2"), "path_edge_idx").alias("b"))
    return e.select(F.concat(clean_route(F.col("route_id").cast("string")), F.lit(":"), F.col("path_no").cast("string")).alias("path_name"), bearing(F.col("a.x1"), F.col("a.y1"), F.col("b.x2"), F.col("b.y2")).alias("bearing"), F.transform("s", lambda x: x["edge_id"]).alias("edges"))


def paths_through(path_edges: DataFrame, edge_ids: DataFrame) -> DataFrame:
    """GRF-9. Paths that use any of the edges."""
    return path_edges.join(edge_ids.select("edge_id"), "edge_id", "left_semi").select("path_id").distinct()


def drop_label(paths: DataFrame, label: str) -> DataFrame:
    """GRF-9. Paths without a label."""
    return paths.where(~F.coalesce(F.array_contains("labels", label), F.lit(False)))


def merge_path(path_edges: DataFrame, points: DataFrame) -> DataFrame:
    """GRF-10. (line_id, pt_idx, x, y): the vertices of a path's edges in order, without equal neighbours."""
    v = path_edges.join(points, "edge_id")
    order = Window.partitionBy("path_id").orderBy("path_edge_idx", "pt_idx")
    moved = F.coalesce((F.col("x") != F.lag("x").over(order)) | (F.col("y") != F.lag("y").over(order)), F.lit(True))
    kept = v.withColumn("__moved", moved).where("__moved")
    return kept.select(F.col("path_id").alias("line_id"), (F.row_number().over(order) - 1).alias("pt_idx"), "x", "y")


def reverse_path(path_edges: DataFrame) -> DataFrame:
    """GRF-11. Every path backwards."""
    last = Window.partitionBy("path_id")
    return path_edges.withColumn("path_edge_idx", F.max("path_edge_idx").over(last) - F.col("path_edge_idx"))


def line_merge(parts: DataFrame) -> DataFrame:
    """GRF-14. (feature_id, chain, seq, part_idx): a feature's parts stitched where one's end is another's only continuation.

    ``parts``: feature_id, part_idx, x1, y1, x2, y2. A part follows another if it starts, to 6 decimals, where
    the other ends and neither the end nor the start is shared with a third part; chains are components of
    that relation, and a part's place in its chain is found by doubling.
    """
    p = parts.select("feature_id", "part_idx", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")])
    ends = p.groupBy("feature_id", "x2", "y2").agg(F.count("*").alias("n"), F.min("part_idx").alias("prev"))
    starts = p.groupBy("feature_id", "x1", "y1").agg(F.count("*").alias("n"), F.min("part_idx").alias("next"))
    a, b = ends.where("n = 1").alias("a"), starts.where("n = 1").alias("b")
    joint = a.join(b, (F.col("a.feature_id") == F.col("b.feature_id")) & (F.col("a.x2") == F.col("b.x1")) & (F.col("a.y2") == F.col("b.y1"))).where("a.prev <> b.next").select("a.feature_id", "prev", "next")
    # head: the first part of the chain; a ring's is its smallest part
    key = lambda f, i: F.xxhash64(F.col(f), F.col(i))
    comp = connected_components(joint.select(key("feature_id", "prev").alias("src"), key("feature_id", "next").alias("dst")))
    nodes = p.select("feature_id", "part_idx").withColumn("node", key("feature_id", "part_idx")).join(comp, "node", "left").withColumn("chain", F.coalesce("component", "node")).drop("component", "node")
    headless = nodes.join(joint.select("feature_id", F.col("next").alias("part_idx")), ["feature_id", "part_idx"], "left_anti").select("feature_id", "chain").distinct()
    ring_cut = nodes.join(headless, ["feature_id", "chain"], "left_anti").groupBy("feature_id", "chain").agg(F.min("part_idx").alias("next")).select("feature_id", "next")
    links = joint.join(ring_cut, ["feature_id", "next"], "left_anti")
    state = cut(nodes.join(links.withColumnRenamed("next", "part_idx"), ["feature_id", "part_idx"], "left").select("feature_id", "chain", "part_idx", F.col("prev").alias("jump"), F.when(F.col("prev").isNotNull(), 1).otherwise(0).alias("seq")), "chains")
    while not state.where("jump IS NOT NULL").isEmpty():
        ahead = state.select("feature_id", F.col("part_idx").alias("jump"), F.col("jump").alias("far"), F.col("seq").alias("more"))
        following = cut(state.join(ahead, ["feature_id", "jump"], "left").select("feature_id", "chain", "part_idx", F.col("far").alias("jump"), (F.col("seq") + F.coalesce("more", F.lit(0))).alias("seq")), "chains")
        release(state)
        state = following
    return state.select("feature_id", "chain", "seq", "part_idx")


def is_continuous(parts: DataFrame) -> DataFrame:
    """GRF-14. Features whose parts form one chain."""
    return line_merge(parts).groupBy("feature_id").agg((F.count_distinct("chain") == 1).alias("continuous"))
