"""Spatial joins on a tree of cells, candidate matching and choice of reference chains.

Segments are covered by cells whose level follows their length; a point has one cell a level, so what comes within ``km``
of each other meets in an equi-join on cells, refined by exact distances. Lines across the 180th meridian are two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.operators.geometry import EARTH_KM, RAD, curve_similarity, haversine, line_ends, line_lengths, line_segments, line_slice, nearest_on_line, nearest_snaps, points_along, reverse_lines, snapped
from strandweave.operators.graph import best_parallel, merge_path, path_nodes, reverse_path, shortest_paths
from strandweave.plans.cut import cut, release

KM_PER_DEGREE = EARTH_KM * RAD


#: Cells of level n are 180 / 2^n degrees wide; the finest are about four metres.
FINEST_LEVEL = 22


def segment_covers(v: DataFrame, km: float, most: int = 4) -> DataFrame:
    """GEO-7. Segments of lines with ``n``, ``level``, ``east`` and ``north``: how many pieces a segment is covered in, the level
    of its cells and the margin of ``km`` in degrees.

    A segment is cut into ``most`` equal pieces, or fewer where they would be shorter than twice ``km``. The level is the
    finest whose cells are as wide as a piece with its margins, so long segments take coarse cells. Latitudes may run on
    over a pole, where degrees of longitude widen again: the margin follows the distance from the nearer of the poles.
    """
    s = line_segments(v)
    n = F.greatest(F.lit(1), F.least(F.lit(most), F.ceil((F.col("to_km") - F.col("from_km")) / (2 * km)))).cast("int")
    north = km / KM_PER_DEGREE * 1.001
    # from the pole before the segment, with its margin: where it begins and ends
    begins, ends = F.least("y1", "y2") - north + 90, F.greatest("y1", "y2") + north + 90
    pole = F.floor(begins / 180) * 180
    off = F.greatest(F.lit(0.0), F.least(begins - pole, pole + 180 - ends))
    east = F.least(F.lit(360.0), F.lit(north) / F.greatest(F.sin(off * RAD), F.lit(1e-6)))
    s = s.withColumns({"n": n, "east": east, "north": F.lit(north)})
    width = F.greatest(F.abs(F.col("x2") - F.col("x1")) / F.col("n") + 2 * F.col("east"), F.abs(F.col("y2") - F.col("y1")) / F.col("n") + 2 * F.col("north"))
    return s.withColumn("level", F.greatest(F.lit(0), F.least(F.lit(FINEST_LEVEL), F.floor(F.log2(180 / width)))).cast("int"))


def cover_cells(covers: DataFrame) -> DataFrame:
    """GEO-7. :func:`segment_covers` with cx, cy: the cells of each, four a piece at most, each once."""
    f = lambda i: i / F.col("n")
    first = lambda a, z, i, margin, zero: F.floor((F.least(a + f(i) * (z - a), a + f(i + 1) * (z - a)) - margin + zero) / F.col("size"))
    last = lambda a, z, i, margin, zero: F.floor((F.greatest(a + f(i) * (z - a), a + f(i + 1) * (z - a)) + margin + zero) / F.col("size"))
    x, y = (F.col("x1"), F.col("x2")), (F.col("y1"), F.col("y2"))
    of = lambda i: F.struct(*[edge(*c, i, F.col(m), zero).alias(name) for name, edge, c, m, zero in (("x0", first, x, "east", 180), ("xn", last, x, "east", 180), ("y0", first, y, "north", 90), ("yn", last, y, "north", 90))])
    grid = lambda b: F.flatten(F.transform(F.sequence(b["x0"], b["xn"]), lambda cx: F.transform(F.sequence(b["y0"], b["yn"]), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))
    boxes = covers.withColumn("size", F.lit(180.0) / F.pow(F.lit(2.0), F.col("level"))).withColumn("boxes", F.transform(F.sequence(F.lit(0), F.col("n") - 1), of))
    cells = F.array_distinct(F.flatten(F.transform(F.array_distinct("boxes"), grid)))
    return boxes.withColumn("c", F.explode(cells)).select(*covers.columns, "c.cx", "c.cy")


def near_places(points: DataFrame, v: DataFrame, km: float) -> DataFrame:
    """JN-7. (point_id, line_id, dist_km, along_km, seg_idx): the nearest place within ``km`` of each point (point_id, px, py)
    on every line that has one; earlier along the line on ties.

    A point meets only segments with a cell of its own and in whose widened box it lies; the distance is tested after the
    nearest is found, since as a condition of the join it would be computed many times over. A point has one cell at each
    level that segments of its degree of latitude are covered at, which are 23 at most: so the coarse cells of segments at
    a pole hold only the points near it.
    """
    covers = cut(segment_covers(v, km), "covers")
    size = F.lit(180.0) / F.pow(F.lit(2.0), F.col("level"))
    bands = F.sequence(F.floor(F.least("y1", "y2") - F.col("north")), F.floor(F.greatest("y1", "y2") + F.col("north")))
    levels = covers.select(F.explode(bands).alias("band"), "level").distinct().groupBy("band").agg(F.collect_set("level").alias("levels"))
    placed = points.withColumn("band", F.floor("py")).join(F.broadcast(levels), "band").select("point_id", "px", "py", F.explode("levels").alias("level"))
    placed = placed.withColumns({"cx": F.floor((F.col("px") + 180) / size), "cy": F.floor((F.col("py") + 90) / size)})
    inside = [F.col(p).between(F.least(a, z) - F.col(m), F.greatest(a, z) + F.col(m)) for p, a, z, m in (("px", "x1", "x2", "east"), ("py", "y1", "y2", "north"))]
    met = placed.join(cover_cells(covers), ["level", "cx", "cy"]).where(inside[0] & inside[1])
    return nearest_snaps(snapped(met)).where(F.col("dist_km") <= km)


def vertices(v: DataFrame) -> DataFrame:
    """Points of a vertex table for :func:`near_places`, named by line and index."""
    return v.select(F.struct("line_id", "pt_idx").alias("point_id"), F.col("x").alias("px"), F.col("y").alias("py"))


def spatial_overlap(a: DataFrame, b: DataFrame, km: float) -> DataFrame:
    """JN-7. (a_id, b_id, dist_km): lines within ``km``, by the least distance between vertices of either and the other line."""
    one = near_places(vertices(a), b, km).select(F.col("point_id.line_id").alias("a_id"), F.col("line_id").alias("b_id"), "dist_km")
    two = near_places(vertices(b), a, km).select(F.col("line_id").alias("a_id"), F.col("point_id.line_id").alias("b_id"), "dist_km")
    return one.unionByName(two).groupBy("a_id", "b_id").agg(F.min("dist_km").alias("dist_km"))


#: Levels of the tree that one step of the descent goes down.
LEVELS_A_STEP = 2


def _tree_cell(x: Column, y: Column, level: int) -> list[Column]:
    size = 180 / 2**level
    return [F.floor((x + 180) / size).alias("cx"), F.floor((y + 90) / size).alias("cy")]


def knn_points(points: DataFrame, targets: DataFrame, k: int = 10) -> DataFrame:
    """JN-8. (point_id, target_id, dist_km, rank): the ``k`` nearest targets of each point, by descent in a tree of cells.

    Targets are counted by cell at every level. A step puts the cells below in the place of each point's open cells, takes as
    the point's reach the least distance within which cells that hold ``k`` targets lie whole, and drops the cells that begin
    beyond it. Cells of at most ``k`` targets are not opened any more, so where targets are dense cells are small:
    a point keeps about as many rows whatever the densest cell holds. What is left is compared exactly. Of targets
    in one place the ``k`` smallest ids stand for all.
    """
    at = ["cx", "cy"]
    place = F.row_number().over(Window.partitionBy("x", "y").orderBy("target_id"))
    own = cut(targets.select("target_id", "x", "y").withColumn("place", place).where(F.col("place") <= k).drop("place"), "targets")
    steps = list(range(0, FINEST_LEVEL + 1, LEVELS_A_STEP))
    cells = [cut(own.groupBy(*_tree_cell(F.col("x"), F.col("y"), n)).agg(F.count("*").alias("n")), "cells") for n in steps]
    open_ = points.select("point_id", F.col("x").alias("px"), F.col("y").alias("py")).crossJoin(F.broadcast(cells[0]))  # two at most
    held, km = None, KM_PER_DEGREE

    def pruned(rows: DataFrame, level: Column) -> DataFrame:
        """``rows`` (point_id, px, py, level, cx, cy, n) that begin within their point's reach."""
        size = F.lit(180.0) / F.pow(F.lit(2.0), level)
        x0, y0 = F.col("cx") * size - 180, F.col("cy") * size - 90
        gap = lambda p, low: F.greatest(low - p, p - low - size, F.lit(0.0))
        wide = lambda p, low: F.greatest(F.abs(p - low), F.abs(p - low - size))
        # no way is shorter than along the meridian or square onto it, and none need be longer than both in turn
        east = F.asin(F.cos(F.col("py") * RAD) * F.sin(F.least(gap(F.col("px"), x0), F.lit(90.0)) * RAD)) * EARTH_KM
        bounds = rows.withColumns({"least": F.greatest(gap(F.col("py"), y0) * km, east), "most": (wide(F.col("px"), x0) + wide(F.col("py"), y0)) * km})
        order = Window.partitionBy("point_id").orderBy("most", "level", *at).rowsBetween(Window.unboundedPreceding, 0)
        met = bounds.withColumn("met", F.sum("n").over(order))
        reach = F.min(F.when(F.col("met") >= k, F.col("most"))).over(Window.partitionBy("point_id"))
        return met.withColumn("reach", F.coalesce(reach, F.lit(float("inf")))).where(F.col("least") <= F.col("reach") + 1e-6).select("point_id", "px", "py", "level", *at, "n")

    state = cut(open_.withColumn("level", F.lit(0)), "open")
    for number, level in enumerate(steps[1:], 1):
        full = state.where((F.col("n") > k) & (F.col("level") == steps[number - 1]))
        below = cells[number].select((F.col("cx") / 2**LEVELS_A_STEP).cast("long").alias("ux"), (F.col("cy") / 2**LEVELS_A_STEP).cast("long").alias("uy"), F.col("cx").alias("dx"), F.col("cy").alias("dy"), F.col("n").alias("m"))
        opened = full.join(below, (F.col("cx") == F.col("ux")) & (F.col("cy") == F.col("uy"))).select("point_id", "px", "py", F.lit(level).alias("level"), F.col("dx").alias("cx"), F.col("dy").alias("cy"), F.col("m").alias("n"))
        rest = state.where(~((F.col("n") > k) & (F.col("level") == steps[number - 1])))
        following = cut(pruned(opened.unionByName(rest), F.col("level")), "open")
        release(state)
        state = following
    for number, level in enumerate(steps):
        inside = own.select("target_id", "x", "y", *_tree_cell(F.col("x"), F.col("y"), level))
        part = state.where(F.col("level") == level).join(inside, at).select("point_id", "target_id", haversine(F.col("px"), F.col("py"), F.col("x"), F.col("y")).alias("dist_km"))
        held = part if held is None else held.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("point_id").orderBy(F.round("dist_km", 9), "target_id"))
    return held.withColumn("rank", rank).where(F.col("rank") <= k)


def od_pairs(sources: DataFrame, sinks: DataFrame) -> DataFrame:
    """JN-9. Distinct (path_id, source, sink) of a path's candidate origins and destinations."""
    return sources.select("path_id", F.col("node").alias("source")).join(sinks.select("path_id", F.col("node").alias("sink")), "path_id").where("source <> sink").distinct()


def match_edges(edges: DataFrame, refs: DataFrame, km: float = 0.03, samples: int = 11, share: float = 0.5, centerline: bool = False) -> DataFrame:
    """MAT-1. (edge_id, ref_id, is_forward, section_start, section_end, score_km): reference sections along which an edge runs.

    The edge is sampled at equal distances; each sample meets the segments whose cells it lies in, and a reference matches
    if ``share`` of the samples lie within ``km`` of it. The section reaches from the least to the greatest distance along
    the reference; the score is the samples' mean distance. The edge must run the reference's way, from its first
    close sample to the last; centerlines match the opposite way too, with ``is_forward`` 0.
    """
    lens = line_lengths(edges).select("line_id", "length_km")
    at = lens.select("line_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.col("length_km") * i / (samples - 1))).alias("d_km")).distinct()
    asked = points_along(edges, at).select(F.struct("line_id", "d_km").alias("point_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    hit = near_places(asked, refs, km).select(F.col("point_id.line_id").alias("a_id"), F.col("line_id").alias("b_id"), "point_id.d_km", "dist_km", "along_km")
    found = hit.groupBy("a_id", "b_id").agg(
        F.count("*").alias("n_close"),
        F.min("along_km").alias("section_start"),
        F.max("along_km").alias("section_end"),
        F.avg("dist_km").alias("score_km"),
        F.min_by("along_km", "d_km").alias("first"),
        F.max_by("along_km", "d_km").alias("last"),
    )
    kept = found.where((F.col("n_close") >= samples * share) & (F.col("section_end") > F.col("section_start"))).withColumn("is_forward", (F.col("first") <= F.col("last")).cast("int"))
    if not centerline:
        kept = kept.where("is_forward = 1")
    return kept.select(F.col("a_id").alias("edge_id"), F.col("b_id").alias("ref_id"), "is_forward", "section_start", "section_end", "score_km")


def split_long(lengths: DataFrame, most_km: float = 2.0) -> DataFrame:
    """MAT-2. (line_id, section_id, from_km, to_km): equal parts of at most ``most_km``."""
    n = F.greatest(F.ceil(F.col("length_km") / most_km).cast("int"), F.lit(1))
    e = lengths.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return e.select("line_id", F.concat_ws(":", "line_id", "i").alias("section_id"), (F.col("length_km") * F.col("i") / F.col("n")).alias("from_km"), (F.col("length_km") * (F.col("i") + 1) / F.col("n")).alias("to_km"))


def densify(v: DataFrame) -> DataFrame:
    """MAT-2. Vertices with the middle of each pair between them."""
    order = Window.partitionBy("line_id").orderBy("pt_idx")
    mid = v.select("line_id", (F.col("pt_idx") * 2 + 1).alias("pt_idx"), ((F.col("x") + F.lead("x").over(order)) / 2).alias("x"), ((F.col("y") + F.lead("y").over(order)) / 2).alias("y")).where("x IS NOT NULL")
    return v.select("line_id", (F.col("pt_idx") * 2).alias("pt_idx"), "x", "y").unionByName(mid)


def drop_redundant(matches: DataFrame) -> DataFrame:
    """MAT-3. Per edge and reference, matches (with a vertices array) that no larger one contains."""
    m = matches.withColumn("__rank", F.row_number().over(Window.partitionBy("edge_id", "ref_id").orderBy(F.desc(F.size("vertices")), "match_id")))
    a, b = m.alias("a"), m.alias("b")
    inside = (F.col("a.edge_id") == F.col("b.edge_id")) & (F.col("a.ref_id") == F.col("b.ref_id")) & (F.col("b.__rank") < F.col("a.__rank")) & (F.size(F.array_except("a.vertices", "b.vertices")) == 0)
    return a.join(b, inside, "left_anti").drop("__rank")


def merge_matches(rounds: list[DataFrame]) -> DataFrame:
    """MAT-4. Matches of several rounds, equal ones from the earliest."""
    both = None
    for i, df in enumerate(rounds):
        part = df.withColumn("round", F.lit(i))
        both = part if both is None else both.unionByName(part)
    keys = ["edge_id", "ref_id", "section_start", "section_end"]
    return both.groupBy(*keys).agg(F.min("round").alias("round"))


def unmatched(edges: DataFrame, matches: DataFrame, share: float = 0.1) -> DataFrame:
    """MAT-5. Edges of which ``share`` or more is not matched."""
    km = matches.groupBy("edge_id").agg(F.sum(F.col("section_end") - F.col("section_start")).alias("km"))
    left = F.try_divide(F.col("edge_length_km") - F.coalesce("km", F.lit(0.0)), "edge_length_km")
    return edges.join(km, "edge_id", "left").withColumn("unmatched_share", F.round(left + 1e-9, 4)).where(F.col("unmatched_share") >= share).select("edge_id", "unmatched_share")


def index_matches(matches: DataFrame) -> DataFrame:
    """MAT-6. Matches numbered from 0 within their edge."""
    return matches.withColumn("match_idx", F.row_number().over(Window.partitionBy("edge_id").orderBy("section_start", "ref_id", "section_end")) - 1)


def oneway_refs(refs: DataFrame) -> DataFrame:
    """(ref_id): references on one of several carriageways (form of way 2) or alone on their geometry."""
    alone = F.count("*").over(Window.partitionBy("geometry_id")) == 1
    return refs.withColumn("__alone", alone).where((F.col("form_of_way") == 2) | F.col("__alone")).select("ref_id")


def oneway_pairs(oneways: DataFrame, km: float = 0.25) -> DataFrame:
    """CHO-1. (ref_id, pair_id): one-way references and those that run the other way on their left, half of the first within
    ``km`` of the second. ``oneways``: vertices of one-way references. Left is where the middle between the pair's
    ends lies, as seen from end to end; where traffic keeps left, swap the columns."""
    other = match_edges(oneways, oneways, km, centerline=True).where("is_forward = 0 AND edge_id <> ref_id").select("edge_id", "ref_id")
    ends = line_ends(oneways)
    met = other.join(ends.withColumnRenamed("line_id", "edge_id"), "edge_id").join(ends.select(F.col("line_id").alias("ref_id"), ((F.col("x1") + F.col("x2")) / 2).alias("mx"), ((F.col("y1") + F.col("y2")) / 2).alias("my")), "ref_id")
    left = (F.col("x2") - F.col("x1")) * (F.col("my") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("mx") - F.col("x1")) > 0
    return met.where(left).select(F.col("edge_id").alias("ref_id"), F.col("ref_id").alias("pair_id"))


def path_vicinity(paths: DataFrame, ref_points: DataFrame, refs: DataFrame, matches: DataFrame, km: float = 0.05, pairs: DataFrame | None = None, two_way: DataFrame | None = None) -> DataFrame:
    """CHO-1, REP-5. (path_id, ref_id, is_vehicle): references within ``km`` of a path's merged line, those its edges
    match (path_id, ref_id), and those on the same geometries. ``refs``: ref_id, geometry_id, road_class. With ``pairs``
    (:func:`oneway_pairs`) the paths of ``two_way`` (path_id) get the pairs of these references too."""
    near = spatial_overlap(paths, ref_points, km).select(F.col("a_id").alias("path_id"), F.col("b_id").alias("ref_id"))
    own = near.unionByName(matches.select("path_id", "ref_id")).join(refs.select("ref_id", "geometry_id"), "ref_id").select("path_id", "geometry_id").distinct()
    all_ = own.join(refs.select("geometry_id", "ref_id", "road_class"), "geometry_id").select("path_id", "ref_id", "road_class")
    if pairs is not None:
        if two_way is None:
            raise ValueError("pairs are those of two_way paths")
        far = all_.join(two_way.select("path_id").distinct(), "path_id", "left_semi").join(pairs, "ref_id").select("path_id", F.col("pair_id").alias("ref_id"))
        all_ = all_.unionByName(far.join(refs.select("ref_id", "road_class"), "ref_id"))
    return all_.select("path_id", "ref_id", (F.col("road_class") < 8).alias("is_vehicle")).distinct()


def nearby_edges(paths: DataFrame, path_edges: DataFrame, edge_points: DataFrame, ref_points: DataFrame, matches: DataFrame, km: float = 0.05) -> DataFrame:
    """CHO-1. (path_id, edge_id, ref_id, section_start, section_end): edges of other paths within ``km`` of a path's line or of
    a reference that its edges match, one row a match of theirs, or one with nulls where they have none.

    ``path_edges``: path_id, edge_id; ``matches``: edge_id, ref_id, section_start, section_end. A reference's surroundings
    are found once, however many paths match it.
    """
    own = path_edges.select("path_id", "edge_id").distinct()
    by_line = spatial_overlap(paths, edge_points, km).select(F.col("a_id").alias("path_id"), F.col("b_id").alias("edge_id"))
    matched = own.join(matches.select("edge_id", "ref_id"), "edge_id").select("path_id", "ref_id").distinct()
    used = ref_points.join(matched.select(F.col("ref_id").alias("line_id")).distinct(), "line_id", "left_semi")
    by_ref = matched.join(spatial_overlap(used, edge_points, km).select(F.col("a_id").alias("ref_id"), F.col("b_id").alias("edge_id")), "ref_id").select("path_id", "edge_id")
    found = by_line.unionByName(by_ref).distinct().join(own, ["path_id", "edge_id"], "left_anti")
    return found.join(matches.select("edge_id", "ref_id", "section_start", "section_end"), "edge_id", "left").select("path_id", "edge_id", "ref_id", "section_start", "section_end")


def mean_distances(vicinity: DataFrame, paths: DataFrame, ref_points: DataFrame, samples: int = 11) -> DataFrame:
    """CHO-3. ``vicinity`` with avg_dist_km, the mean distance of points along the reference from the path's line."""
    asked = vicinity.select("path_id", "ref_id").join(line_lengths(ref_points).select(F.col("line_id").alias("ref_id"), "length_km"), "ref_id")
    far = avg_deviance(asked.select(F.col("path_id").alias("edge_id"), "ref_id", F.lit(0.0).alias("section_start"), F.col("length_km").alias("section_end")), paths, ref_points, samples)
    return vicinity.join(far.withColumnsRenamed({"edge_id": "path_id", "avg_deviance_km": "avg_dist_km"}), ["path_id", "ref_id"])


def preferred_refs(vicinity: DataFrame, matches: DataFrame, refs: DataFrame) -> DataFrame:
    """CHO-2. (path_id, ref_id) matched by the path, or on the geometry of one that is."""
    own = matches.select("path_id", "ref_id").join(refs.select("ref_id", "geometry_id"), "ref_id").select("path_id", "geometry_id").distinct()
    return vicinity.select("path_id", "ref_id").join(refs.select("ref_id", "geometry_id"), "ref_id").join(own, ["path_id", "geometry_id"], "left_semi").select("path_id", "ref_id").distinct()


def edge_weights(vicinity: DataFrame, preferred: DataFrame, refs: DataFrame) -> DataFrame:
    """CHO-3. Weight of a reference for a path (columns avg_dist_km, length_km): a tenth of its length if preferred,
    twice it beyond 200 m, else its length times 1 + mean distance / 0.4 km."""
    mark = preferred.withColumn("preferred", F.lit(True))
    v = vicinity.join(mark, ["path_id", "ref_id"], "left").join(refs.select("ref_id", "length_km", "from_node", "to_node", "road_class"), "ref_id")
    w = F.when(F.col("preferred"), F.col("length_km") * 0.1).when(F.col("avg_dist_km") > 0.2, F.col("length_km") * 2).otherwise(F.col("length_km") * (1 + F.col("avg_dist_km") / 0.4))
    return v.select("path_id", "ref_id", "from_node", "to_node", "road_class", F.round(w, 9).alias("weight"))


def od_candidates(paths: DataFrame, weights: DataFrame, nodes: DataFrame, k: int = 10) -> DataFrame:
    """CHO-4. (path_id, source, sink): of the nodes of a path's vicinity the ``k`` nearest its start, with those nearest
    its end. ``paths``: vertices; ``weights``: :func:`edge_weights`; ``nodes``: node_id, x, y."""
    ends = line_ends(paths).withColumnRenamed("line_id", "path_id")
    own = weights.select("path_id", F.explode(F.array("from_node", "to_node")).alias("node")).distinct().join(nodes.withColumnRenamed("node_id", "node"), "node").join(ends, "path_id")

    def nearest(x: str, y: str) -> DataFrame:
        order = Window.partitionBy("path_id").orderBy(F.round("km", 9), "node")
        return own.withColumn("km", haversine(F.col("x"), F.col("y"), F.col(x), F.col(y))).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("path_id", "node")

    return od_pairs(nearest("x1", "y1"), nearest("x2", "y2"))


def shortest_chains(weights: DataFrame, od: DataFrame) -> DataFrame:
    """CHO-5. (path_id, source, sink, idx, node): the cheapest chain of each pair, all paths at once."""
    edges = weights.select(F.col("path_id").alias("grp"), F.col("ref_id").alias("edge_id"), "from_node", "to_node", "weight", "road_class")
    asked = od.select(F.col("path_id").alias("grp"), "source", "sink")
    found = cut(shortest_paths(edges, asked.select("grp", "source").distinct(), asked), "chains")
    return path_nodes(found, asked).withColumnRenamed("grp", "path_id")


def chain_refs(chains: DataFrame, weights: DataFrame) -> DataFrame:
    """(path_id, chain_id, chain_idx, ref_id): the references between the nodes of each chain, one at each step."""
    order = Window.partitionBy("path_id", "source", "sink").orderBy("idx")
    steps = chains.withColumn("to_node", F.lead("node").over(order)).where("to_node IS NOT NULL")
    best = best_parallel(weights.select(F.col("path_id").alias("grp"), F.col("ref_id").alias("edge_id"), "from_node", "to_node", "weight", "road_class"))
    met = steps.join(best.select(F.col("grp").alias("path_id"), F.col("from_node").alias("node"), "to_node", F.col("edge_id").alias("ref_id")), ["path_id", "node", "to_node"])
    return met.select("path_id", F.concat_ws("-", "path_id", "source", "sink").alias("chain_id"), F.col("idx").alias("chain_idx"), "ref_id")


def chain_lines(chain: DataFrame, ref_points: DataFrame) -> DataFrame:
    """(line_id, pt_idx, x, y): the vertices of each chain's references in order."""
    return merge_path(chain.select(F.col("chain_id").alias("path_id"), F.col("chain_idx").alias("path_edge_idx"), F.col("ref_id").alias("edge_id")), ref_points.withColumnRenamed("line_id", "edge_id"))


def measure_chains(chain: DataFrame, lines: DataFrame, paths: DataFrame, reach_km: float = 0.5) -> DataFrame:
    """CHO-6. What :func:`score_chains` needs: how alike the first and last ``reach_km`` of chain and path are, how far
    the path's ends lie from the chain and where along it, and both lengths. ``lines`` are :func:`chain_lines`."""
    pairs = chain.select("path_id", "chain_id").distinct()
    chain_km = line_lengths(lines).select(F.col("line_id").alias("chain_id"), F.col("length_km").alias("chain_km"))
    path_km = line_lengths(paths).select(F.col("line_id").alias("path_id"), F.col("length_km").alias("path_km"))
    ends = pairs.join(line_ends(paths).withColumnRenamed("line_id", "path_id"), "path_id")
    snap = lambda x, y, p: nearest_on_line(ends.select(F.col("path_id").alias("point_id"), F.col("chain_id").alias("line_id"), F.col(x).alias("px"), F.col(y).alias("py")), lines).select(F.col("point_id").alias("path_id"), F.col("line_id").alias("chain_id"), F.col("dist_km").alias(f"{p}_dist_km"), F.col("along_km").alias(f"{p}_along_km"))

    def pieces(v: DataFrame, prefix: str) -> DataFrame:
        km = line_lengths(v).select("line_id", "length_km", F.concat(F.lit(prefix), F.col("line_id").cast("string")).alias("name"))
        reach = F.least(F.lit(reach_km), F.col("length_km"))
        first = F.struct(F.concat("name", F.lit(":start")).alias("section_id"), F.lit(0.0).alias("from_km"), reach.alias("to_km"))
        last = F.struct(F.concat("name", F.lit(":end")).alias("section_id"), (F.col("length_km") - reach).alias("from_km"), F.col("length_km").alias("to_km"))
        return line_slice(v, km.select("line_id", F.explode(F.array(first, last)).alias("s")).select("line_id", "s.*")).withColumnRenamed("section_id", "line_id")

    # written, as a union of tables partitioned alike may lose its partitioning at run time, and joins that rely on it fail
    cut_lines = cut(pieces(lines, "c"), "pieces").unionByName(cut(pieces(paths, "p"), "pieces"))
    asked = pairs.select(F.explode(F.array(*[F.struct(F.concat(F.lit("c"), F.col("chain_id"), F.lit(e)).alias("a_id"), F.concat(F.lit("p"), F.col("path_id").cast("string"), F.lit(e)).alias("b_id")) for e in (":start", ":end")])).alias("q")).select("q.*")
    alike = curve_similarity(asked, cut_lines).select(F.regexp_extract("a_id", "^c(.*):(start|end)$", 1).alias("chain_id"), F.regexp_extract("a_id", ":(start|end)$", 1).alias("end"), "similarity")
    both = alike.groupBy("chain_id").agg(F.max(F.when(F.col("end") == "start", F.col("similarity"))).alias("start_similarity"), F.max(F.when(F.col("end") == "end", F.col("similarity"))).alias("end_similarity"))
    return pairs.join(chain_km, "chain_id").join(path_km, "path_id").join(snap("x1", "y1", "start"), ["path_id", "chain_id"]).join(snap("x2", "y2", "end"), ["path_id", "chain_id"]).join(both, "chain_id")


def score_chains(chains: DataFrame) -> DataFrame:
    """CHO-6. Lower is better: (2 - start and end similarity) x mean end distance x (1 + relative length difference);
    infinite where the chain's ends come in the wrong order along the path. Columns: :func:`measure_chains`."""
    apart = (F.col("start_dist_km") + F.col("end_dist_km")) / 2 + 1e-6
    off = F.try_divide(F.abs(F.col("chain_km") - F.col("path_km")), F.col("path_km"))
    score = (2 - F.col("start_similarity") - F.col("end_similarity") + 1e-6) * apart * (1 + F.coalesce(off, F.lit(0.0)))
    return chains.withColumn("score", F.when(F.col("start_along_km") > F.col("end_along_km"), F.lit(float("inf"))).otherwise(score))


def best_chain(scored: DataFrame) -> DataFrame:
    """SRT-2. The chain with the lowest finite score of each path."""
    return scored.where(F.col("score") < float("inf")).groupBy("path_id").agg(F.min_by("chain_id", F.struct("score", "chain_id")).alias("chain_id"), F.min("score").alias("score"))


def chain_overlaps(edge_snaps: DataFrame, chain: DataFrame) -> DataFrame:
    """SEC-7. (path_id, path_edge_idx, ref_id, chain_from, chain_to, section_start, section_end).

    ``edge_snaps``: path_id, path_edge_idx, from_km, to_km along the chain; ``chain``: path_id, chain_idx, ref_id,
    length_km. The overlap of each edge with each reference of the chain is a range join in chain distances.
    """
    order = Window.partitionBy("path_id").orderBy("chain_idx").rowsBetween(Window.unboundedPreceding, 0)
    placed = chain.withColumn("ref_to", F.round(F.sum("length_km").over(order), 9)).withColumn("ref_from", F.round(F.col("ref_to") - F.col("length_km"), 9))
    met = edge_snaps.join(placed, "path_id").where("from_km < ref_to AND ref_from < to_km")
    a, b = F.greatest("from_km", "ref_from"), F.least("to_km", "ref_to")
    return met.select("path_id", "path_edge_idx", "ref_id", "chain_idx", a.alias("chain_from"), b.alias("chain_to"), F.round(a - F.col("ref_from"), 9).alias("section_start"), F.round(b - F.col("ref_from"), 9).alias("section_end"))


def overlaps_to_matches(overlaps: DataFrame) -> DataFrame:
    """SEC-8. Chosen matches: repeats of a reference on an edge merged by min and max, numbered along the edge, with
    the distances along the edge that they cover."""
    merged = overlaps.groupBy("path_id", "path_edge_idx", "ref_id").agg(F.min("section_start").alias("section_start"), F.max("section_end").alias("section_end"), F.min("chain_from").alias("chain_from"))
    order = Window.partitionBy("path_id", "path_edge_idx").orderBy("chain_from", "ref_id")
    km = F.round(F.col("section_end") - F.col("section_start"), 9)
    numbered = merged.withColumn("match_idx", F.row_number().over(order) - 1).withColumn("along_end", F.round(F.sum(km).over(order.rowsBetween(Window.unboundedPreceding, 0)), 9))
    return numbered.withColumn("along_start", F.round(F.col("along_end") - km, 9)).drop("chain_from")


def edge_snaps(path_edges: DataFrame, edge_points: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(chain_id, path_edge_idx, from_km, to_km): where the ends of each path edge snap to each chain of its path, edges
    that snap backwards left out. ``pairs``: path_id, chain_id."""
    ends = path_edges.join(line_ends(edge_points).withColumnRenamed("line_id", "edge_id"), "edge_id").join(pairs, "path_id")
    at = lambda x, y, name: nearest_on_line(ends.select(F.struct("chain_id", "path_edge_idx").alias("point_id"), F.col("chain_id").alias("line_id"), F.col(x).alias("px"), F.col(y).alias("py")), lines).select("point_id.*", F.col("along_km").alias(name))
    return at("x1", "y1", "from_km").join(at("x2", "y2", "to_km"), ["chain_id", "path_edge_idx"]).where("from_km < to_km")


def divvy(forward: tuple[DataFrame, DataFrame], backward: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """SEC-9, CHO-7. Matches of a path's forward chain and, for centerline maps, of its backward chain."""
    out = overlaps_to_matches(chain_overlaps(*forward)).withColumn("is_forward", F.lit(1))
    if backward is None:
        return out
    return out.unionByName(overlaps_to_matches(chain_overlaps(*backward)).withColumn("is_forward", F.lit(0)))


def first_chain_matches(scored: DataFrame, snapped: DataFrame, chain: DataFrame, ref_km: DataFrame) -> DataFrame:
    """SEC-9. Matches of each path by its best-scored chain that has any. ``scored``: path_id, chain_id, score;
    ``ref_km``: ref_id, length_km."""
    ranked = scored.where(F.col("score") < float("inf")).select("path_id", "chain_id", F.row_number().over(Window.partitionBy("path_id").orderBy(F.round("score", 12), "chain_id")).alias("place"))
    keyed = chain.join(ref_km, "ref_id").select(F.col("chain_id").alias("path_id"), "chain_idx", "ref_id", "length_km")
    met = overlaps_to_matches(chain_overlaps(snapped.withColumnRenamed("chain_id", "path_id"), keyed)).withColumnRenamed("path_id", "chain_id").join(ranked, "chain_id")
    first = met.groupBy("path_id").agg(F.min("place").alias("place"))
    return met.join(first, ["path_id", "place"]).drop("place")


def choose_matches(path_edges: DataFrame, edge_points: DataFrame, matches: DataFrame, refs: DataFrame, ref_points: DataFrame, nodes: DataFrame, k: int = 10, centerline: bool = False, vehicles: bool = True) -> DataFrame:
    """CHO-7. (path_id, path_edge_idx, ref_id, is_forward, match_idx, section and along-edge distances): vicinity, weights,
    chains, scores and division of the best chain among the path's edges; backward too for centerline maps.

    ``matches``: edge_id, ref_id of :func:`match_edges`; ``refs``: ref_id, geometry_id, from_node, to_node, road_class;
    ``nodes``: node_id, x, y. ``vehicles`` leaves out references of class 8. Each stage is written, since several
    later ones read it.
    """
    km = cut(line_lengths(ref_points).select(F.col("line_id").alias("ref_id"), "length_km"), "ref-km")
    own = cut(path_edges.join(matches.select("edge_id", "ref_id"), "edge_id").select("path_id", "ref_id").distinct(), "own")
    out = None
    for way in (1, 0) if centerline else (1,):
        edges = path_edges if way else reverse_path(path_edges)
        points = edge_points if way else reverse_lines(edge_points)
        paths = cut(merge_path(edges, points.withColumnRenamed("line_id", "edge_id")), "paths")
        vicinity = path_vicinity(paths, ref_points, refs, own)
        vicinity = cut(vicinity.where("is_vehicle") if vehicles else vicinity, "vicinity")
        weights = cut(edge_weights(mean_distances(vicinity, paths, ref_points), preferred_refs(vicinity, own, refs), refs.drop("length_km").join(km, "ref_id")), "weights")
        od = cut(od_candidates(paths, weights, nodes, k), "od")
        chain = cut(chain_refs(shortest_chains(weights, od), weights), "chain")
        lines = cut(chain_lines(chain, ref_points), "lines")
        scored = cut(score_chains(measure_chains(chain, lines, paths)).select("path_id", "chain_id", "score"), "scored")
        snapped = cut(edge_snaps(edges, points, lines, scored.select("path_id", "chain_id")), "snapped")
        part = cut(first_chain_matches(scored, snapped, chain, km).withColumn("is_forward", F.lit(way)), "chosen")
        if not way:
            last = path_edges.groupBy("path_id").agg(F.max("path_edge_idx").alias("__last"))
            part = part.join(last, "path_id").withColumn("path_edge_idx", F.col("__last") - F.col("path_edge_idx")).drop("__last")
        out = part if out is None else out.unionByName(part)
        release(paths, vicinity, weights, od, chain, lines, scored, snapped)
    return out


def avg_deviance(matches: DataFrame, edges: DataFrame, refs: DataFrame, samples: int = 11) -> DataFrame:
    """SEC-10. Mean distance of points along a match's reference section from its edge, in km."""
    at = matches.select("edge_id", "ref_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: F.col("section_start") + (F.col("section_end") - F.col("section_start")) * i / (samples - 1))).alias("d_km"))
    p = points_along(refs, at.select(F.col("ref_id").alias("line_id"), "d_km").distinct()).withColumnRenamed("line_id", "ref_id")
    asked = at.distinct().join(p, ["ref_id", "d_km"]).select(F.struct("edge_id", "ref_id", "d_km").alias("point_id"), F.col("edge_id").alias("line_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    return nearest_on_line(asked, edges).groupBy("point_id.edge_id", "point_id.ref_id").agg(F.avg("dist_km").alias("avg_deviance_km"))


def shape_matches(shapes: DataFrame, refs: DataFrame, km: float = 0.05) -> DataFrame:
    """GEO-18. (shape_id, ref_id): references all of whose vertices lie within ``km`` of the shape and which run along it
    the same way."""
    hit = near_places(vertices(refs), shapes, km).select(F.col("line_id").alias("shape_id"), F.col("point_id.line_id").alias("ref_id"), "point_id.pt_idx", "along_km")
    ends = hit.groupBy("shape_id", "ref_id").agg(F.count("*").alias("n"), F.min_by("along_km", "pt_idx").alias("first"), F.max_by("along_km", "pt_idx").alias("last"))
    every = refs.groupBy(F.col("line_id").alias("ref_id")).agg(F.count("*").alias("n"))
    return ends.join(every, ["ref_id", "n"]).where(F.col("first") <= F.col("last")).select("shape_id", "ref_id")
