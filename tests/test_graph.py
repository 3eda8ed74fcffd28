"""Graph operators against plain searches."""

import heapq
import random

from strandweave.operators import components, graph
from strandweave.plans import cut


def test_components_equal_union_find(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)] + [(5, 5)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert found == want


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([(None, 1)], "src long, dst long")).isEmpty()


def test_shortest_paths_equal_dijkstra(spark):
    draw = random.Random(4)
    rows = [(g, i, draw.randrange(25), draw.randrange(25), draw.randint(1, 9) / 10, draw.randrange(3)) for g in range(2) for i in range(70)]
    rows = [r for r in rows if r[2] != r[3]]
    edges = spark.createDataFrame(rows, "grp int, edge_id long, from_node long, to_node long, weight double, road_class int")
    got = {(r.grp, r.node): r.dist for r in graph.shortest_paths(edges, spark.createDataFrame([(0, 0), (1, 0)], "grp int, source long")).collect()}
    for g in range(2):
        dist, heap = {}, [(0.0, 0)]
        while heap:
            d, n = heapq.heappop(heap)
            if n in dist:
                continue
            dist[n] = d
            for r in rows:
                if r[0] == g and r[2] == n and r[3] not in dist:
                    heapq.heappush(heap, (d + r[4], r[3]))
        assert {n: round(d, 6) for (k, n), d in got.items() if k == g} == {n: round(d, 6) for n, d in dist.items()}


def dijkstra(rows, source):
    """(dist, hops, pred) by node, the least of each."""
    best, heap = {}, [(0.0, 0, -1, source)]
    while heap:
        d, hops, pred, n = heapq.heappop(heap)
        if n not in best:
            best[n] = (d, hops, pred)
            for a, b, w in rows:
                if a == n and b not in best:
                    heapq.heappush(heap, (round(d + w, 9), hops + 1, n, b))
    return best


def test_search_stops_at_its_targets(spark, monkeypatch):
    """The same arrivals as a search without targets; far nodes are not settled; settled rows are written a few times at most."""
    draw = random.Random(9)
    side = 8
    grid = [(x * side + y, u * side + v, draw.randint(1, 4) / 4) for x in range(side) for y in range(side) for u, v in ((x + 1, y), (x, y + 1), (x - 1, y), (x, y - 1)) if 0 <= u < side and 0 <= v < side]
    edges = spark.createDataFrame([(g, i, a, b, w, 0) for g in (0, 1) for i, (a, b, w) in enumerate(grid)], "grp int, edge_id long, from_node long, to_node long, weight double, road_class int")
    pairs = [(0, 0, 3), (0, 0, 17), (0, 0, 0), (0, 27, 28), (1, 63, 45), (1, 63, 5000)]
    od = spark.createDataFrame(pairs, "grp int, source long, sink long")
    written = []
    counted = lambda df, name="cut", put=cut.cut: written.append((name, out := put(df, name), out.count())) or out
    monkeypatch.setattr(graph, "cut", counted)
    monkeypatch.setattr(cut, "cut", counted)
    got = {(r.grp, r.source, r.node): (r.dist, r.hops, r.pred) for r in graph.shortest_paths(edges, od.select("grp", "source").distinct(), od.where("sink <> 5000")).collect()}
    rows = {name: sum(n for w, _, n in written if w == name) for name in ("judged", "log")}
    assert rows["log"] <= 2 * len(got) and rows["judged"] <= 4 * len(got)
    trees = {(g, s): dijkstra(grid, s) for g, s in ((0, 0), (0, 27), (1, 63))}
    for g, s, t in pairs[:-1]:
        assert (g, s, t) in got
    for (g, s, n), (d, hops, pred) in got.items():
        assert (d, hops, -1 if pred is None else pred) == trees[g, s][n]
    assert len([k for k in got if k[:2] == (0, 27)]) < 20
    whole = {(r.node): r.dist for r in graph.shortest_paths(edges, spark.createDataFrame([(0, 0)], "grp int, source long")).where("grp = 0").collect()}
    assert whole == {n: d for n, (d, _, _) in trees[0, 0].items()}
    open_ended = graph.shortest_paths(edges.where("grp = 1"), spark.createDataFrame([(1, 63)], "grp int, source long"), od.where("sink = 5000"))
    assert open_ended.count() == side * side


def longest_paths(edges):
    """Shortest paths from every node that do not go on and are in no longer one, compared as runs; with their splices."""
    nodes = sorted({n for e in edges for n in e[1:3]})
    paths = []
    for s in nodes:
        tree = dijkstra([(a, b, 1.0) for _, a, b, _ in edges], s)
        on_the_way = {pred for _, _, pred in tree.values()}
        for t in tree:
            if t != s and t not in on_the_way:
                path = [t]
                while path[0] != s:
                    path.insert(0, tree[path[0]][2])
                paths.append(path)
    inside = lambda a, b: len(a) < len(b) and any(b[i : i + len(a)] == a for i in range(len(b)))
    out = []
    for p in paths:
        if any(inside(p, q) for q in paths):
            continue
        found = [[e for _, e in sorted((w, e) for e, a, b, w in edges if (a, b) == step)] for step in zip(p, p[1:])]
        main = [f[0] for f in found]
        out.append((p[0], p[-1], None, main))
        for i, f in enumerate(found):
            out += [(p[0], p[-1], e, main[max(i - 1, 0) : i] + [e] + main[i + 1 : i + 2]) for e in f[1:]]
    return sorted(out, key=str)


def test_longest_paths_of_routes_of_every_shape(spark):
    """Lines, two-way streets, rings, branches, parallel edges, and graphs drawn at random."""
    draw = random.Random(5)
    two_way = [(1, 2), (2, 1), (2, 3), (3, 2)]
    routes = {
        1: [(1, 2), (2, 3), (3, 4)], 2: two_way, 3: [(1, 2), (2, 3), (3, 4), (4, 1)], 4: [(1, 2), (2, 3), (2, 4), (4, 5)], 5: [(1, 2), (2, 3), (2, 3), (3, 4), (1, 2)],
        6: [(1, 2)], 7: [(1, 2), (3, 2)], 8: [(2, 1), (2, 3), (7, 7)], 9: [*two_way, (3, 4), (4, 5), (5, 3)], 10: [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5)],
    }
    for r in range(11, 19):
        routes[r] = [(draw.randrange(7), draw.randrange(7)) for _ in range(draw.randint(4, 12))]
    rows = [(r, 100 * r + i, a, b, draw.randint(1, 9) / 10, 0) for r, steps in routes.items() for i, (a, b) in enumerate(steps)]
    found = graph.route_paths_topological(spark.createDataFrame(rows, "route_id int, edge_id long, from_node long, to_node long, weight double, road_class int")).collect()
    for r in routes:
        mine = {}
        for x in sorted((x for x in found if x.route_id == r), key=lambda x: x.path_edge_idx):
            mine.setdefault((x.source, x.sink, x.splice), []).append(x.edge_id)
        want = longest_paths([(e, a, b, w) for k, e, a, b, w, _ in rows if k == r and a != b])
        assert sorted(((*k, v) for k, v in mine.items()), key=str) == want, r
    assert len([x for x in found if x.route_id == 2]) == 4 and len({x.source for x in found if x.route_id == 3}) == 4


def test_walked_path_reaches_the_source(spark):
    edges = spark.createDataFrame([(0, 1, 1, 2, 1.0, 0), (0, 2, 2, 3, 1.0, 0), (0, 3, 1, 3, 5.0, 0)], "grp int, edge_id long, from_node long, to_node long, weight double, road_class int")
    paths = graph.shortest_paths(edges, spark.createDataFrame([(0, 1)], "grp int, source long"))
    nodes = graph.path_nodes(paths, spark.createDataFrame([(0, 1, 3)], "grp int, source long, sink long"))
    assert [r.node for r in nodes.orderBy("idx").collect()] == [1, 2, 3]


def test_line_merge_follows_ends_and_cuts_rings(spark):
    parts = [(1, 0, 2.0, 0.0, 3.0, 0.0), (1, 1, 0.0, 0.0, 1.0, 0.0), (1, 2, 1.0, 0.0, 2.0, 0.0), (2, 0, 0.0, 0.0, 1.0, 0.0), (2, 1, 5.0, 0.0, 6.0, 0.0), (3, 0, 0.0, 0.0, 1.0, 1.0), (3, 1, 1.0, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(parts, "feature_id int, part_idx int, x1 double, y1 double, x2 double, y2 double")
    rows = graph.line_merge(df).collect()
    chain = lambda f: [r.part_idx for r in sorted((r for r in rows if r.feature_id == f), key=lambda r: (r.chain, r.seq))]
    assert chain(1) == [1, 2, 0] and chain(3) == [0, 1]
    assert {r.feature_id: r.continuous for r in graph.is_continuous(df).collect()} == {1: True, 2: False, 3: True}
