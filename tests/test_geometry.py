"""Lines on a small grid near the equator, where 0.01 degrees are 1.11195 km both ways."""

import pytest
from pyspark.sql import functions as F

from strandweave.operators import geometry, graph, projections, spatial

KM = 1.11195


@pytest.fixture(scope="module")
def lines(spark):
    rows = []
    for line, points in {1: [(0, 0), (0.01, 0), (0.02, 0)], 2: [(0, 0.0002), (0.02, 0.0002)], 3: [(0.02, 0), (0.03, 0)], 4: [(0.5, 0.5), (0.51, 0.5)], 5: [(0, 0), (0.01, 0), (0.01, 0.01)]}.items():
        rows += [(line, i, float(x), float(y)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "line_id int, pt_idx int, x double, y double").cache()


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "a_id int, b_id int")


def test_slice_and_points(spark, lines):
    cut = geometry.line_slice(lines, spark.createDataFrame([(1, 7, KM / 2, 1.5 * KM)], "line_id int, section_id int, from_km double, to_km double"))
    assert [(round(r.x, 4), r.y) for r in cut.orderBy("pt_idx").collect()] == [(0.005, 0.0), (0.01, 0.0), (0.015, 0.0)]


def test_overlap_and_cospatiality(spark, lines):
    rows = geometry.cospatiality(pairs(spark, (1, 2)), lines.where("line_id = 1"), lines.where("line_id = 2"), 0.05).collect()
    assert {r.kind for r in rows} == {"shared"} and {r.side for r in rows} == {"a", "b"}
    assert all(r.from_km == 0 and r.to_km == pytest.approx(2 * KM, abs=1e-3) for r in rows)
    assert geometry.overlap_within(pairs(spark, (4, 1)), lines, lines, 0.05).isEmpty()


def test_shared_stretches_with_gaps_equal_samples(spark):
    """Lines that part and meet again, cross, touch in a point or stand still, against points every metre."""
    import math
    import random

    draw = random.Random(3)
    step = 1 / 111_195  # a metre
    lines = {k: [(x * step, y * step) for x, y in points] for k, points in {
        0: [(0, 0), (1000, 0)], 1: [(0, 5), (300, 5), (400, 80), (600, 80), (700, 5), (1000, 5)], 2: [(500, -300), (500, 300)], 3: [(0, 0), (0, 0), (1000, 0)],
        4: [(100, 9), (100, 9)], **{k: [(draw.uniform(0, 400), draw.uniform(0, 400)) for _ in range(5)] for k in range(5, 9)},
    }.items()}
    asked = [(0, 1), (1, 0), (0, 2), (3, 1), (0, 4), *[(a, b) for a in range(5, 9) for b in range(5, 9)]]
    v = spark.createDataFrame([(k, i, x, y) for k, points in lines.items() for i, (x, y) in enumerate(points)], "line_id int, pt_idx int, x double, y double")
    km = 0.01
    found = {}
    for r in geometry.overlap_within(pairs(spark, *asked), v, v, km, 0.0).collect():
        found.setdefault((r.a_id, r.b_id), []).append((r.from_km, r.to_km))

    def gap(p, s, e):
        (x, y), (a, b), (c, d) = p, s, e
        n = (c - a) ** 2 + (d - b) ** 2
        t = max(0, min(1, ((x - a) * (c - a) + (y - b) * (d - b)) / n)) if n else 0
        return math.dist(p, (a + t * (c - a), b + t * (d - b))) / step / 1000

    for a, b in asked:
        at = 0.0
        for s, e in zip(lines[a], lines[a][1:]):
            length = math.dist(s, e) / step / 1000
            for i in range(int(length * 1000)):
                f = (i + 0.5) / 1000 / length
                p = s[0] + f * (e[0] - s[0]), s[1] + f * (e[1] - s[1])
                far = min(gap(p, *other) for other in zip(lines[b], lines[b][1:]))
                if abs(far - km) > 1e-4:
                    assert any(x <= at + f * length <= y for x, y in found.get((a, b), [])) == (far < km), (a, b, at + f * length)
            at += length
    assert len(found[0, 1]) == 2
    both = geometry.cospatiality(pairs(spark, (0, 1)), v, v, km).where("side = 'a'").orderBy("from_km").collect()
    assert [r.kind for r in both] == ["shared", "rest", "shared"] and both[0].from_km == 0


def test_adjacent_lines(spark, lines):
    got = {(r.a_id, r.b_id): (r.order, r.has_gap) for r in geometry.merge_if_adjacent(pairs(spark, (1, 3), (3, 1), (1, 4)), lines).collect()}
    assert got == {(1, 3): ("ab", False), (3, 1): ("ba", False), (1, 4): (None, True)}


def test_similarity(spark, lines):
    same = geometry.curve_similarity(pairs(spark, (1, 1), (1, 5)), lines).orderBy("b_id").collect()
    assert same[0].frechet == pytest.approx(0, abs=1e-9) and same[0].similarity == pytest.approx(1)
    assert same[1].similarity < same[0].similarity and abs(same[1].turn) <= 0.1 * 3.1416
    stats = geometry.similarity_stats(pairs(spark, (1, 2)), lines).first()
    assert stats.snap_mean == pytest.approx(0.0002 * 111.195, rel=1e-3) and len(stats.along_quantiles) == 9
    assert geometry.line_dissimilarity(pairs(spark, (3, 1)), lines).first().dissimilarity == pytest.approx(0, abs=1e-6)


def test_small_turns_do_not_count(spark):
    """A wave turned by less than a tenth of pi is alike, turned by more it is not; points follow the length."""
    import math

    wave = [(0.002 * i, 0.0005 * math.sin(i)) for i in range(12)]
    turned = lambda a: [(x * math.cos(a) - y * math.sin(a), x * math.sin(a) + y * math.cos(a)) for x, y in wave]
    rows = [(k, i, x, y) for k, line in enumerate([wave, turned(0.2), turned(0.31), turned(0.9), [(0.0, 0.0), (0.0001, 0.0)]]) for i, (x, y) in enumerate(line)]
    v = spark.createDataFrame(rows, "line_id int, pt_idx int, x double, y double")
    got = {r.b_id: r for r in geometry.curve_similarity(pairs(spark, (0, 0), (0, 1), (0, 2), (0, 3), (4, 4)), v).where("a_id = 0 OR b_id = 4").collect()}
    assert got[0].similarity == pytest.approx(1) and got[1].similarity > 0.99 and got[1].turn == pytest.approx(0.2, abs=0.01)
    assert got[2].similarity > 0.98 > 0.9 > got[3].similarity and got[3].turn == pytest.approx(0.1 * math.pi)
    assert got[0].n_points == 12 and got[4].n_points == 2


def test_snapping_never_goes_back(spark, lines):
    points = spark.createDataFrame([(1, 0, 5, 0.002, 0.001), (1, 1, 5, 0.0095, 0.0062), (1, 2, 5, 0.006, 0.0005), (1, 3, 5, 0.0101, 0.009)], "seq_id int, pt_no int, line_id int, px double, py double")
    along = [r.along_km for r in geometry.snap_sequence(points, lines).orderBy("pt_no").collect()]
    assert len(along) == 4 and along == sorted(along)
    ordered = points.where("pt_no <> 2")
    assert [r.seg_idx for r in geometry.snap_sequence(ordered, lines).orderBy("pt_no").collect()] == [0, 1, 1]


def test_monotone_snaps_are_the_least_of_all_orders():
    """Random points and segments against every assignment that never goes back; then long ones against a full table."""
    from itertools import product

    import numpy as np
    import pandas as pd

    r = np.random.default_rng(0)

    def case(n, m, way=np.array):
        xs, ys = np.cumsum(r.uniform(-0.01, 0.02, m + 1)), r.uniform(0, 0.02, m + 1)
        km = np.hypot(np.diff(xs), np.diff(ys)) * 111.2
        segs = pd.DataFrame({"seg_idx": range(m), "x1": xs[:-1], "y1": ys[:-1], "x2": xs[1:], "y2": ys[1:], "from_km": km.cumsum() - km, "to_km": km.cumsum()})
        pts = pd.DataFrame({"seq_id": 1, "pt_no": range(n), "line_id": 1, "px": way(r.uniform(-0.01, 0.05, n)), "py": r.uniform(0, 0.02, n)})
        each = [[geometry._monotone(pts.iloc[[i]], segs.iloc[[j]]).iloc[0] for j in range(m)] for i in range(n)]
        return pts, segs, np.array([[e.dist_km for e in row] for row in each]), np.array([[e.along_km for e in row] for row in each])

    fits = lambda a, i, j, k: j < k or (j == k and a[i, j] <= a[i + 1, k] + 1e-12)
    for _ in range(60):
        pts, segs, d, a = case(int(r.integers(1, 5)), int(r.integers(1, 4)))
        n, m = d.shape
        sums = [sum(d[i, c] ** 2 for i, c in enumerate(cs)) for cs in product(range(m), repeat=n) if all(fits(a, i, *cs[i : i + 2]) for i in range(n - 1))]
        if sums:
            out = geometry._monotone(pts, segs)
            assert (out.dist_km**2).sum() == pytest.approx(min(sums)) and (out.along_km.diff().dropna() >= -1e-9).all()
    pts, segs, d, a = case(23, 40, np.sort)
    cost = d[0] ** 2
    for i in range(1, 23):
        cost = np.array([min((cost[j] for j in range(k + 1) if fits(a, i - 1, j, k)), default=np.inf) for k in range(40)]) + d[i] ** 2
    assert cost.min() < np.inf and (geometry._monotone(pts, segs).dist_km ** 2).sum() == pytest.approx(cost.min())


def test_units_and_shapes(spark, lines):
    feet = geometry.measured(lines.where("line_id = 1")).withColumn("dist", F.col("at_km") / 0.0003048)
    assert geometry.infer_distance_unit(feet.drop("at_km")).first().unit == "ft"
    shapes = spark.createDataFrame([("s", 3, 0.1, 0.0), ("s", 1, 0.0, 0.0), ("s", 2, 0.0, 0.00000001)], "shape_id string, seq int, lon double, lat double")
    assert [(r.pt_idx, r.x) for r in geometry.shape_lines(shapes).orderBy("pt_idx").collect()] == [(0, 0.0), (1, 0.1)]


def test_sequences(spark):
    df = spark.createDataFrame([(1, 1, [1, 3], [1, 2, 3]), (2, 1, [2, 3], [1, 2, 3]), (3, 1, [3, 1], [1, 2, 3]), (4, 1, [4], [1])], "a_id int, b_id int, a array<int>, b array<int>")
    got = [(r.is_subset, r.is_subsequence, r.is_substring) for r in geometry.sequence_relations(df).orderBy("a_id").collect()]
    assert got == [(True, True, False), (True, True, True), (True, False, False), (False, False, False)]


def test_spatial_joins(spark, lines):
    got = {(r.a_id, r.b_id) for r in spatial.spatial_overlap(lines, lines, 0.05).where("a_id < b_id").collect()}
    assert got == {(1, 2), (1, 3), (1, 5), (2, 3), (2, 5)}
    match = spatial.match_edges(lines.where("line_id = 2"), lines.where("line_id IN (1, 4)"), 0.05).first()
    assert (match.edge_id, match.ref_id) == (2, 1) and match.section_end == pytest.approx(2 * KM, rel=1e-3)
    m = spark.createDataFrame([(2, 1, 0.0, KM)], "edge_id int, ref_id int, section_start double, section_end double")
    assert spatial.avg_deviance(m, lines, lines).first().avg_deviance_km == pytest.approx(0.02224, rel=1e-2)
    assert {(r.shape_id, r.ref_id) for r in spatial.shape_matches(lines.where("line_id = 2"), lines, 0.05).collect()} == {(2, 1), (2, 2)}
    assert [r.x for r in spatial.densify(lines.where("line_id = 3")).orderBy("pt_idx").collect()] == [0.02, 0.025, 0.03]
    assert spatial.split_long(spark.createDataFrame([(1, 5.0)], "line_id int, length_km double")).count() == 3


def test_nearest_points(spark):
    t = spark.createDataFrame([(i, i * 0.013, 0.0) for i in range(30)], "target_id int, x double, y double")
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 0.0)], "point_id int, x double, y double")
    got = {}
    for r in spatial.knn_points(p, t, 3).collect():
        got.setdefault(r.point_id, []).append((r.rank, r.target_id))
    assert sorted(got[1]) == [(1, 0), (2, 1), (3, 2)] and sorted(got[2]) == [(1, 29), (2, 28), (3, 27)]


def test_chains(spark):
    chain = spark.createDataFrame([(1, 0, 10, 0.5), (1, 1, 11, 0.5)], "path_id int, chain_idx int, ref_id int, length_km double")
    snaps = spark.createDataFrame([(1, 0, 0.0, 0.7), (1, 1, 0.7, 1.0)], "path_id int, path_edge_idx int, from_km double, to_km double")
    rows = [(r.path_edge_idx, r.ref_id, r.match_idx, r.section_start, r.section_end, r.along_start, r.along_end) for r in spatial.divvy((snaps, chain)).orderBy("path_edge_idx", "match_idx").collect()]
    assert rows == [(0, 10, 0, 0.0, 0.5, 0.0, 0.5), (0, 11, 1, 0.0, 0.2, 0.5, 0.7), (1, 11, 0, 0.2, 0.5, 0.0, 0.3)]
    weights = spark.createDataFrame([(1, 10, 1, 2, 0, 1.0), (1, 11, 2, 3, 0, 1.0), (1, 12, 1, 3, 0, 5.0)], "path_id int, ref_id int, from_node long, to_node long, road_class int, weight double")
    nodes = spatial.shortest_chains(weights, spark.createDataFrame([(1, 1, 3)], "path_id int, source long, sink long"))
    assert [r.node for r in nodes.orderBy("idx").collect()] == [1, 2, 3]


def test_nearest_targets_where_a_third_lie_in_one_cell(spark):
    """Against brute force: dense, sparse and repeated targets, points far off, fewer targets than asked for; few rows a point."""
    import math
    import random

    draw = random.Random(12)
    targets = [(i, -73.7 + draw.uniform(0, 0.001), 42.6 + draw.uniform(0, 0.001)) for i in range(300)] + [(i, draw.uniform(-80, -70), draw.uniform(35, 45)) for i in range(300, 600)] + [(i, -75.0, 41.0) for i in range(600, 640)]
    points = [(0, -73.6995, 42.6005), (1, -73.71, 42.61), (2, -75.0, 41.0), (3, -60.0, 10.0), (4, 170.0, -80.0), *[(i, draw.uniform(-80, -70), draw.uniform(35, 45)) for i in range(5, 20)]]
    df = lambda rows, name: spark.createDataFrame(rows, f"{name} long, x double, y double")

    def km(x1, y1, x2, y2):
        x1, y1, x2, y2 = map(math.radians, (x1, y1, x2, y2))
        return 2 * 6371.0088 * math.asin(min(1, math.sqrt(math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2)))

    got = {(r.point_id, r["rank"]): r.target_id for r in spatial.knn_points(df(points, "point_id"), df(targets, "target_id"), 5).collect()}
    for p, x, y in points:
        want = sorted((round(km(x, y, tx, ty), 9), t) for t, tx, ty in targets)[:5]
        assert [got[p, i + 1] for i in range(5)] == [t for _, t in want], p
    few = spatial.knn_points(df(points[:2], "point_id"), df(targets[:3], "target_id"), 5)
    assert few.count() == 6


def test_places_near_long_and_short_segments(spark):
    """Every point against every line: segments from a metre to 300 km, near the equator and far north, points beside them and
    far off, a segment without length; few cells a line whatever its length."""
    import random

    draw = random.Random(5)
    lines, points = [], []
    for i in range(60):
        x, y, step = draw.uniform(-10, -9), draw.choice([0.0, 42.0, 69.5, -55.0]) + draw.uniform(-0.5, 0.5), 10 ** draw.uniform(-5, 0.4)
        for j in range(draw.randint(2, 4)):
            lines.append((i, j, x, y))
            x, y = x + draw.uniform(-1, 1) * step, y + draw.uniform(-1, 1) * step
    lines += [(60, 0, -9.5, 42.0), (60, 1, -9.5, 42.0)]
    for i, j, x, y in lines:
        points.append((x + draw.gauss(0, 3e-4), y + draw.gauss(0, 3e-4)))
    for (i, _, x1, y1), (k, _, x2, y2) in zip(lines, lines[1:]):
        f = draw.random()
        points.append((x1 + f * (x2 - x1) + 2e-4, y1 + f * (y2 - y1)))
    v = spark.createDataFrame(lines, "line_id int, pt_idx int, x double, y double")
    p = spark.createDataFrame([(i, *xy) for i, xy in enumerate(points)], "point_id int, px double, py double").coalesce(1)
    every = geometry.nearest_on_line(p.crossJoin(v.select("line_id").distinct()), v).where("dist_km <= 0.05")
    row = lambda r: (r.point_id, r.line_id, r.seg_idx, round(r.dist_km, 9), round(r.along_km, 9))
    want, got = sorted(map(row, every.collect())), sorted(map(row, spatial.near_places(p, v, 0.05).collect()))
    assert got == want and len(want) > 150
    cells = spatial.cover_cells(spatial.segment_covers(v, 0.05)).groupBy("line_id", "seg_idx").count()
    assert cells.where("count > 16").count() == 0
    assert spatial.near_places(p, v.limit(0), 0.05).count() == 0 and spatial.near_places(p.limit(0), v, 0.05).count() == 0


def test_places_beyond_a_pole(spark):
    """Latitudes that run on over a pole: as far beyond it as before it cells are as fine, at it every meridian is near."""
    import random

    draw, lines, points = random.Random(7), [], []
    for i, y in enumerate([60.0, 120.0, 100.0, 240.0, 300.0, -130.0, *[draw.uniform(89.98, 90.02) for _ in range(40)]]):
        x = -74 + draw.uniform(-0.3, 0.3)
        lines += [(i, 0, x, y), (i, 1, x + 0.004, y + 0.004)]
        points += [(x + 0.001, y + 0.0012), (x + 0.002, y + 0.0018), (x + draw.uniform(-0.1, 0.1), y)]
    v = spark.createDataFrame(lines, "line_id int, pt_idx int, x double, y double")
    p = spark.createDataFrame([(i, *xy) for i, xy in enumerate(points)], "point_id int, px double, py double").coalesce(1)
    every = geometry.nearest_on_line(p.crossJoin(v.select("line_id").distinct()), v).where("dist_km <= 0.05")
    # a line is met where latitudes are named alike: 240 is not 120
    apart = p.join(every, "point_id").join(v.where("pt_idx = 0").select("line_id", "y"), "line_id").where("abs(py - y) < 1")
    row = lambda r: (r.point_id, r.line_id, r.seg_idx, round(r.dist_km, 9))
    got = sorted(map(row, spatial.near_places(p, v, 0.05).collect()))
    assert got == sorted(map(row, apart.collect())) and len(got) > 100
    levels = {r.line_id: r.level for r in spatial.segment_covers(v, 0.05).where("line_id < 6").collect()}
    assert levels[0] == levels[1] == levels[3] == levels[4] and min(levels.values()) > 10


def test_paths(spark, lines):
    e = spark.createDataFrame([(1, 1, 1, 2, 1.0, 0), (1, 2, 2, 3, 1.0, 0), (1, 3, 3, 4, 1.0, 0)], "route_id int, edge_id long, from_node long, to_node long, weight double, road_class int")
    assert [r.edge_id for r in graph.route_paths_topological(e).orderBy("path_edge_idx").collect()] == [1, 2, 3]
    path = spark.createDataFrame([(9, 0, 1), (9, 1, 3)], "path_id int, path_edge_idx int, edge_id int")
    merged = graph.merge_path(path, lines.withColumnRenamed("line_id", "edge_id"))
    assert [r.x for r in merged.orderBy("pt_idx").collect()] == [0.0, 0.01, 0.02, 0.03]
    ends = spark.createDataFrame([(1, 0.0, 0.0, 0.02, 0.0), (3, 0.02, 0.0, 0.03, 0.0)], "edge_id int, x1 double, y1 double, x2 double, y2 double")
    record = graph.load_paths(spark.createDataFrame([("I 90:Albany", 0, 0, 1), ("I 90:Albany", 0, 1, 3)], "route_id string, path_no int, path_edge_idx int, edge_id int"), ends).first()
    assert (record.path_name, round(record.bearing), record.edges) == ("i_90:albany:0", 90, [1, 3])
    nodes, edges = graph.build_graph(ends)
    assert nodes.count() == 3 and edges.where("edge_id = 1").first().to_node == edges.where("edge_id = 3").first().from_node


def test_projections(spark):
    key = lambda lon, lat: spark.range(1).select(projections.geoprox_key(F.lit(lon), F.lit(lat)).alias("k")).first().k
    assert key(0.00001, 0.0) == 2 and key(0.0, 0.00001) == 1 and key(0.00003, 0.00003) == 15
    assert abs(key(-74.0, 42.0) - key(-74.0, 42.00001)) < abs(key(-74.0, 42.0) - key(-70.0, 40.0))
    paths = spark.createDataFrame([(1, [2, 1, 2])], "path_id int, ids array<int>")
    assert projections.translate_sequence(paths, spark.createDataFrame([(1, "a"), (2, "b")], "id int, code string"), "id", "code").first().ids == ["b", "a", "b"]
    raw = spark.createDataFrame([("Y", "N", 2, 1), ("N", "Y", None, None), ("N", "N", 1, 1), (None, None, 1, 1)], "oneway string, divided string, total_lanes int, primary_dir_lanes int")
    assert [r[0] for r in raw.select(projections.is_unidirectional("inventory")).collect()] == [True, True, False, False]
