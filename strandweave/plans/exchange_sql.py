"""DuckDB SQL of :mod:`strandweave.plans.exchange`: (tables and definitions it reads, statement) by name."""

from __future__ import annotations

from strandweave.plans.oracles import ALONG, DIRECTION, NEAREST, deg, km, relaxed

LAYER = "CASE WHEN c <= 4 THEN 'major' WHEN c <= 7 THEN 'local' WHEN c = 8 THEN 'paths' END AS layer, CASE WHEN c BETWEEN 1 AND 4 THEN 5 WHEN c BETWEEN 5 AND 7 THEN 11 WHEN c = 8 THEN 14 END AS minzoom"
SYSTEM = "CASE c WHEN 1 THEN 'interstate' WHEN 2 THEN 'highway' WHEN 3 THEN 'arterial' WHEN 4 THEN 'arterial' WHEN 5 THEN 'collector' WHEN 6 THEN 'collector' WHEN 7 THEN 'local' WHEN 8 THEN 'local' WHEN 9 THEN 'local' END AS layer, CASE c WHEN 2 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 9 WHEN 5 THEN 10 WHEN 6 THEN 11 WHEN 7 THEN 12 WHEN 8 THEN 12 WHEN 9 THEN 12 END AS minzoom"
JOINED = "p.ref_id, p.part_idx, p.part_start, p.part_end, tmc.edge_id AS tmc_edge, tmc.is_forward AS tmc_fwd, ris.edge_id AS ris_edge, road_class FROM map_parts p JOIN ref_segments USING (ref_id) LEFT JOIN (SELECT * FROM attached WHERE rn = 1 AND map = 'tmc') tmc ON p.ref_id = tmc.ref_id AND p.part_idx = tmc.part_idx LEFT JOIN (SELECT * FROM attached WHERE rn = 1 AND map = 'ris') ris ON p.ref_id = ris.ref_id AND p.part_idx = ris.part_idx"
SEGMENTS = ("attached", "ref_segments")
INVENTORY = "(SELECT o_orderkey AS fid, CASE WHEN o_orderkey % 20 > 0 THEN o_orderkey % 20 END AS fc, CASE WHEN o_custkey % 2 = 0 THEN 'Albany' ELSE 'Erie' END AS county_name FROM orders)"
RAW = """(SELECT 'T' || o_orderkey AS tmc, COALESCE(CASE WHEN o_orderkey % 3 = 0 THEN 'L' || o_custkey || ':' || county END, CASE WHEN o_orderkey % 2 = 0 THEN 'R' || c_nationkey || ':' || county END, CASE WHEN o_orderkey % 5 = 0 THEN c_name || ':' || county END, 'T' || o_orderkey) AS route_id, edge_length_km AS length_km, CASE WHEN o_orderkey % 5 = 0 THEN c_name END AS road_name, o_orderkey % 13 AS f_system, COALESCE(isprimary, 1) AS isprimary FROM
  (SELECT *, CASE WHEN o_custkey % 4 > 0 THEN lower(c_mktsegment) END AS county, CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderkey % 7 > 0 THEN 1 ELSE 0 END END AS isprimary FROM orders JOIN customer ON o_custkey = c_custkey) JOIN edges ON edge_id = o_orderkey WHERE (isprimary IS NULL OR isprimary <> 0) AND (is_unidirectional = 1 OR edge_id % 9 > 0))"""
ROWS = "(SELECT o_orderkey AS fid, o_custkey || ':' || ROUND(o_totalprice, 1) AS target_map_id, o_custkey || ':' || CASE WHEN o_custkey % 2 = 0 THEN 'albany' ELSE 'erie' END AS route_id, lpad((o_orderkey % 25)::VARCHAR, 2, '0') || '_' || lpad((o_orderkey % 100)::VARCHAR, 4, '0') AS rc_station, CASE WHEN o_orderstatus = 'F' OR (o_orderpriority = '5-LOW' AND (CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END) IS NOT DISTINCT FROM (CASE WHEN o_orderkey % 8 > 3 THEN o_orderkey % 4 END)) THEN 1 ELSE 0 END AS is_unidirectional, o_orderkey % 20 % 10 AS road_level FROM orders WHERE o_orderkey % 17 > 0)"
ENDS = "SELECT line_id, arg_min(x, pt_idx) AS x1, arg_min(y, pt_idx) AS y1, arg_max(x, pt_idx) AS x2, arg_max(y, pt_idx) AS y2 FROM {} GROUP BY line_id"
SECTION = "ref_id, edge_id, is_forward, section_start, section_end"
CLAIM = "path_id, path_edge_idx, edge_id, is_forward, match_idx, ref_id, section_start, section_end"
#: The line of a section: its vertices inside, and both its ends placed on the line.
CUT = """, total AS (SELECT line_id, SUM(km) AS km FROM ref_steps GROUP BY line_id), spots AS (SELECT line_id, pt_idx, x, y, SUM(km) OVER (PARTITION BY line_id ORDER BY pt_idx) AS at_km FROM ref_steps),
  tips AS (SELECT ref_id, d_km, x1 + f * (x2 - x1) AS x, y1 + f * (y2 - y1) AS y FROM (SELECT ref_id, d_km, x1, y1, x2, y2, COALESCE((greatest(0, least(d_km, t.km)) - from_km) / NULLIF(s.km, 0), 0) AS f FROM (SELECT DISTINCT ref_id, unnest([section_start, section_end]) AS d_km FROM cuts) c JOIN total t ON t.line_id = ref_id JOIN ref_segments_lines s ON s.line_id = ref_id WHERE greatest(0, least(d_km, t.km)) >= from_km - 1e-12 AND greatest(0, least(d_km, t.km)) <= from_km + s.km + 1e-12 QUALIFY row_number() OVER (PARTITION BY ref_id, d_km ORDER BY pt_idx DESC) = 1)),
  sliced AS (SELECT c.*, 2 + (SELECT COUNT(*) FROM spots WHERE line_id = c.ref_id AND at_km > section_start AND at_km < section_end) AS n_points, a.x AS lon_first, b.x AS lon_last, a.y AS lat_first, b.y AS lat_last FROM cuts c JOIN tips a ON a.ref_id = c.ref_id AND a.d_km = section_start JOIN tips b ON b.ref_id = c.ref_id AND b.d_km = section_end)"""
POINTS = "n_points, " + ", ".join(f"ROUND({c}_{e} + 1e-9, 5) AS {c}_{e}" for c in ("lon", "lat") for e in ("first", "last"))



def cospatial(asked: str, a: str, b: str, k: float) -> str:
    """Stretches of segments within ``k`` km of segments: the discs at b's ends and the strip between them, met by a's line."""
    scale = "radians(1) * 6371.0088"

    def side(name: str, one: str, two: str, own: str, other: str) -> str:
        return f"""
m_{name} AS (SELECT {one} AS own_id, {two} AS other_id, a.from_km AS at_km, a.km, (a.x2 - a.x1) * kx AS dx, (a.y2 - a.y1) * {scale} AS dy, (b.x1 - a.x1) * kx AS px, (b.y1 - a.y1) * {scale} AS py, (b.x2 - a.x1) * kx AS qx, (b.y2 - a.y1) * {scale} AS qy
  FROM ({asked}) JOIN (SELECT *, cos(radians(y1)) * {scale} AS kx FROM {own}) a ON a.line_id = {one} JOIN {other} b ON b.line_id = {two}),
n_{name} AS (SELECT *, dx * dx + dy * dy AS l, sqrt(pow(qx - px, 2) + pow(qy - py, 2)) AS e, dx * px + dy * py AS p, dx * qx + dy * qy AS q FROM m_{name}),
o_{name} AS (SELECT *, p * p - l * (px * px + py * py - {k * k!r}) AS rp, q * q - l * (qx * qx + qy * qy - {k * k!r}) AS rq,
  -(px * (qx - px) + py * (qy - py)) / (e * e) AS u, (dx * (qx - px) + dy * (qy - py)) / (e * e) AS du, -(px * (qy - py) - py * (qx - px)) / e AS w, (dx * (qy - py) - dy * (qx - px)) / e AS dw FROM n_{name} WHERE l > 0),
s_{name} AS (SELECT *, CASE WHEN abs(du) < 1e-12 THEN CASE WHEN u BETWEEN 0 AND 1 THEN -1e18 END ELSE least(-u / du, (1 - u) / du) END AS ulo, CASE WHEN abs(du) < 1e-12 THEN CASE WHEN u BETWEEN 0 AND 1 THEN 1e18 END ELSE greatest(-u / du, (1 - u) / du) END AS uhi,
  CASE WHEN abs(dw) < 1e-12 THEN CASE WHEN abs(w) <= {k!r} THEN -1e18 END ELSE least((-{k!r} - w) / dw, ({k!r} - w) / dw) END AS wlo, CASE WHEN abs(dw) < 1e-12 THEN CASE WHEN abs(w) <= {k!r} THEN 1e18 END ELSE greatest((-{k!r} - w) / dw, ({k!r} - w) / dw) END AS whi FROM o_{name}),
t_{name} AS (SELECT *, ulo IS NOT NULL AND wlo IS NOT NULL AND greatest(ulo, wlo) <= least(uhi, whi) AS strip FROM s_{name}),
v_{name} AS (SELECT own_id, other_id, at_km, km, greatest(0, least(CASE WHEN rp >= 0 THEN (p - sqrt(rp)) / l END, CASE WHEN rq >= 0 THEN (q - sqrt(rq)) / l END, CASE WHEN strip THEN greatest(ulo, wlo) END)) AS lo, least(1, greatest(CASE WHEN rp >= 0 THEN (p + sqrt(rp)) / l END, CASE WHEN rq >= 0 THEN (q + sqrt(rq)) / l END, CASE WHEN strip THEN least(uhi, whi) END)) AS hi FROM t_{name} WHERE rp >= 0 OR rq >= 0 OR strip),
z_{name} AS (SELECT own_id, other_id, at_km + km * lo AS lo, at_km + km * hi AS hi FROM v_{name} WHERE lo <= hi),
r_{name} AS (SELECT *, SUM(CASE WHEN lo - reach <= 1e-7 THEN 0 ELSE 1 END) OVER (PARTITION BY own_id, other_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, MAX(hi) OVER (PARTITION BY own_id, other_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM z_{name})),
f_{name} AS MATERIALIZED (SELECT own_id, other_id, length_km, CASE WHEN lo < {k!r} THEN 0 ELSE lo END AS lo, CASE WHEN length_km - hi < {k!r} THEN length_km ELSE hi END AS hi FROM (SELECT own_id, other_id, MIN(lo) AS lo, MAX(hi) AS hi FROM r_{name} GROUP BY own_id, other_id, run HAVING MAX(hi) - MIN(lo) >= 0.002) JOIN (SELECT line_id AS own_id, SUM(km) AS length_km FROM {own} GROUP BY line_id) USING (own_id)),
g_{name} AS (SELECT own_id, other_id, 'shared' AS kind, lo, hi FROM f_{name} UNION ALL SELECT own_id, other_id, 'rest', COALESCE(lag(hi) OVER (PARTITION BY own_id, other_id ORDER BY lo), 0), lo FROM f_{name} UNION ALL SELECT own_id, other_id, 'rest', MAX(hi), any_value(length_km) FROM f_{name} GROUP BY own_id, other_id)"""

    rounded = "ROUND(lo + 1e-9, 5) AS from_km, ROUND(hi + 1e-9, 5) AS to_km"
    return "," + side("a", "a_id", "b_id", a, b) + "," + side("b", "b_id", "a_id", b, a) + f" SELECT own_id AS a_id, other_id AS b_id, 'a' AS side, kind, {rounded} FROM g_a WHERE hi - lo >= 0.002 UNION ALL SELECT other_id, own_id, 'b', kind, {rounded} FROM g_b WHERE hi - lo >= 0.002"


#: All shortest paths spelt out, those that go on or stand inside a longer one left out by comparing texts.
ROUTES = (
    ", " + relaxed("SELECT route_id AS grp, from_node, to_node, 1 AS w FROM route_edges", "SELECT DISTINCT route_id AS grp, from_node AS source FROM route_edges", 10)
    + ", tree AS MATERIALIZED (SELECT r.grp, r.source, r.node, MIN(p.node) AS pred FROM r10 r JOIN g ON g.grp = r.grp AND g.to_node = r.node JOIN r10 p ON p.grp = r.grp AND p.source = r.source AND p.node = g.from_node AND p.dist + 1 = r.dist GROUP BY ALL)"
    + ", q0 AS (SELECT DISTINCT grp, source, source AS node, [source] AS nodes FROM tree)"
    + "".join(f", q{k + 1} AS (SELECT q.grp, q.source, t.node, list_append(nodes, t.node) AS nodes FROM q{k} q JOIN tree t ON t.grp = q.grp AND t.source = q.source AND t.pred = q.node)" for k in range(10))
    + ", leaf AS MATERIALIZED (SELECT *, ',' || array_to_string(nodes, ',') || ',' AS spelt FROM (" + " UNION ALL ".join(f"FROM q{k}" for k in range(1, 11)) + ") x WHERE NOT EXISTS (SELECT 1 FROM tree t WHERE t.grp = x.grp AND t.source = x.source AND t.pred = x.node))"
    + ", top AS MATERIALIZED (SELECT * FROM leaf a WHERE NOT EXISTS (SELECT 1 FROM leaf b WHERE b.grp = a.grp AND len(b.nodes) > len(a.nodes) AND contains(b.spelt, a.spelt)))"
    + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY route_id, from_node, to_node ORDER BY weight, road_class, edge_id) AS place FROM route_edges)"
    + ", met AS MATERIALIZED (SELECT s.*, edge_id, place FROM (SELECT grp, source, node AS sink, nodes, unnest(range(len(nodes) - 1)) AS i FROM top) s JOIN ranked r ON r.route_id = grp AND r.from_node = nodes[i + 1] AND r.to_node = nodes[i + 2])"
    + " SELECT grp AS route_id, source, sink, NULL AS splice, i AS path_edge_idx, edge_id FROM met WHERE place = 1"
    + " UNION ALL SELECT x.grp, x.source, x.sink, x.edge_id, row_number() OVER (PARTITION BY x.grp, x.source, x.sink, x.edge_id ORDER BY m.i) - 1, CASE WHEN m.i = x.i THEN x.edge_id ELSE m.edge_id END FROM met x JOIN met m ON m.grp = x.grp AND m.source = x.source AND m.sink = x.sink AND m.place = 1 AND abs(m.i - x.i) <= 1 WHERE x.place > 1"
)

SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "read_csv_typed": ((), "SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN s_name || chr(10) || '\"two\" lines' END AS s_name, CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal END AS s_acctbal, NULL::VARCHAR AS absent FROM supplier"),
    "gtfs_feed": (("trips", "calendar", "calendar_dates", "stop_times"), "SELECT 'trips' AS \"table\", COUNT(*) AS n FROM trips WHERE shape_id % 2 = 0 UNION ALL SELECT 'calendar', COUNT(*) FROM calendar UNION ALL SELECT 'calendar_dates', COUNT(*) FROM calendar_dates UNION ALL SELECT 'stop_times', COUNT(*) FROM stop_times"),
    "gtfs_feeds": (("trips",), "SELECT CASE WHEN shape_id % 2 = 0 THEN 'north' ELSE 'south' END AS agency, trip_id, service_id::VARCHAR AS service_id, route_id::VARCHAR AS route_id, shape_id::VARCHAR AS shape_id, NULL::VARCHAR AS trip_headsign FROM trips"),
    "gtfs_to_aadt": (("aadt",), "SELECT segment_id, route_id::VARCHAR AS route_id, amp, midd, pmp, we, ovn FROM aadt"),
    "consolidated_aadt": (("aadt",), "SELECT segment_id, 2 * COUNT(*) AS n_routes, " + ", ".join(f"ROUND(ROUND(2 * ROUND(SUM({p}) + 1e-9, 3), 3) + 1e-9, 2) AS {p}" for p in ("amp", "midd", "pmp", "we", "ovn")) + " FROM aadt GROUP BY segment_id"),
    "read_features": (("ref_points",), "SELECT line_id AS id, line_id % 7 AS f_system, 1 AS n_parts, arg_max(x, pt_idx) AS last_x FROM ref_points GROUP BY line_id"),
    "normalize_inventory": (("agency_points",), "SELECT line_id AS fid, CASE WHEN line_id % 5 = 0 THEN 0 WHEN line_id % 3 = 0 THEN 2 ELSE 1 END AS n_parts, CASE WHEN line_id % 5 = 0 OR line_id % 3 = 0 THEN 0 ELSE COUNT(*) END AS n_points FROM agency_points GROUP BY line_id"),
    "load_osm": (("way_nodes", "nodes"), "SELECT way_id, node_idx, node_id, lon, lat FROM way_nodes JOIN nodes USING (node_id)"),
    "load_base_map": (("ref_segments",), "SELECT geometry_id AS id, MIN(ref_id) AS tile, arg_min(road_class, ref_id) AS road_class FROM ref_segments GROUP BY geometry_id"),
    "read_station_directions": (("station_directions",), "SELECT rc_station, year, federal_direction FROM station_directions WHERE year % 3 > 0"),
    "extract_station_directions": (("station_directions",), "SELECT DISTINCT rc_station, year, federal_direction FROM station_directions"),
    "clean_count_csv": ((), "SELECT v AS value, MIN(o_orderkey) AS line_no FROM (SELECT o_orderkey, o_custkey || ',' || o_orderstatus || '/x' AS v FROM orders WHERE o_orderkey % 11 > 0 AND o_orderkey % 13 > 0) GROUP BY v"),
    "segments_to_ndjson": (SEGMENTS, f"SELECT ref_id || '-' || part_idx AS id, part_start, part_end, tmc_edge AS edge_id, {LAYER} FROM (SELECT *, road_class AS c FROM (SELECT {JOINED}))"),
    "segments_to_qa_ndjson": (SEGMENTS, "SELECT 'Feature' AS type, ref_id || '-' || part_idx AS id, TRUE AS bare FROM map_parts"),
    "edges_to_ndjson": ((), f"SELECT 'T' || o_orderkey AS id, c AS f_system, {SYSTEM} FROM (SELECT *, o_orderkey % 8 AS c FROM orders WHERE o_custkey % 2 = 0)"),
    "inventory_to_ndjson": ((), f"SELECT fid, county_name, {LAYER.replace('c <= 4', 'c BETWEEN 0 AND 4')} FROM (SELECT *, COALESCE(fc, 8) % 10 AS c FROM {INVENTORY})"),
    "inventory_layers": ((), f"SELECT fid, NULL::VARCHAR AS county_name, {SYSTEM} FROM (SELECT *, COALESCE(fc, 8) % 10 AS c FROM {INVENTORY} WHERE county_name = 'Erie')"),
    "terse_segments": (SEGMENTS, f"SELECT ref_id || '-' || part_idx AS id, ref_id AS ref, tmc_edge AS osm, tmc_fwd AS osm_fwd, ris_edge AS ris, tmc_edge AS tmc, road_class AS n, 'primary' AS h, part_idx % 8 AS dir FROM (SELECT {JOINED})"),
    "export_flat": (("ref_points",), "SELECT line_id, arg_min(x, pt_idx) AS first_x, arg_max(y, pt_idx) AS last_y, COUNT(*) AS n FROM ref_points GROUP BY line_id"),
    "path_lines": (("merged",), "SELECT line_id, arg_min(x, pt_idx) AS first_x, COUNT(*) AS n FROM merged GROUP BY line_id"),
    "refs_by_class": (("ref_segments",), "SELECT ref_id, road_class AS min_road_class, length_km FROM ref_segments"),
    "feature_collections": (("ref_segments",), "SELECT ref_id, road_class, 'LineString' AS kind FROM ref_segments"),
    "merged_years": (("ref_segments", "edges"), "SELECT '2019_base' AS layer, road_class::VARCHAR AS code FROM ref_segments UNION ALL SELECT '2019_segments', target_map_id FROM edges UNION ALL SELECT '2020_base', road_class::VARCHAR FROM ref_segments"),
    "conflation_metadata": (("ref_segments", "way_nodes"), """SELECT '{"n":' || (SELECT COUNT(*) FROM ref_segments) || ',"last":' || (SELECT MAX(ref_id) FROM ref_segments) || '}' AS base, '{"n":' || (SELECT COUNT(DISTINCT way_id) FROM way_nodes) || '}' AS osm"""),
    "edge_endpoints": (("ref_points", "ref_segments"), "SELECT line_id AS edge_id, road_class, CASE WHEN pt_idx = 0 THEN 'start' ELSE 'end' END AS \"end\", x AS lon, y AS lat FROM ref_points JOIN ref_segments ON ref_id = line_id WHERE pt_idx <> 1"),
    "conflation_rows": ((*SEGMENTS, "edges", "way_tags"), f"SELECT ref_id || '-' || part_idx AS segment_id, road_class, tmc_edge % 8 AS federal_direction, highway FROM (SELECT {JOINED}) LEFT JOIN way_tags ON way_id = ris_edge"),
    "raw_segments": (("edges",), f"SELECT tmc, route_id, length_km FROM {RAW}"),
    "segment_properties": (("edges",), f"SELECT tmc AS target_map_id, length_km AS edge_length_km, 1 AS is_unidirectional, road_name, NULL::VARCHAR AS route_number, f_system % 10 AS road_level, isprimary AS is_primary FROM {RAW}"),
    "raw_inventory": (("station",), f"SELECT target_map_id, route_id, fid, array_to_string(d, ',') AS directions FROM {ROWS} LEFT JOIN station USING (rc_station)"),
    "inventory_properties": ((), f"SELECT target_map_id, is_unidirectional, road_level, 1 AS is_primary FROM {ROWS}"),
    "raw_properties": (("agency_steps",), f"SELECT fid AS edge_id, ROUND(total + 1e-9, 4) AS length_km, is_unidirectional FROM {ROWS} JOIN (SELECT line_id AS fid, SUM(km) AS total FROM agency_steps GROUP BY line_id) USING (fid)"),
    "filter_raw": (("way_tags",), "SELECT * FROM way_tags WHERE highway = 'primary'"),
    "lookup_in_order": (("way_nodes", "nodes"), "SELECT list_id, pos, a.node_id, lon, lat FROM (SELECT way_id AS list_id, node_idx AS pos, node_id + CASE WHEN node_idx = 2 THEN 1000000 ELSE 0 END AS node_id FROM way_nodes) a LEFT JOIN nodes b ON a.node_id = b.node_id"),
    "reference_metadata": (("way_nodes", "ref_segments"), "SELECT way_id AS list_id, node_idx AS pos, ref_id, geometry_id, road_class FROM way_nodes JOIN ref_segments ON ref_id = node_id + CASE WHEN node_idx = 2 THEN 1000000 ELSE 0 END WHERE road_class <> 8"),
    "translate_sequence": (("path_edges", "edges"), "SELECT path_id, string_agg(target_map_id, ',' ORDER BY path_edge_idx, edge_id) AS ids FROM path_edges JOIN edges USING (edge_id) GROUP BY path_id"),
    "edge_features": (("edges",), "SELECT edge_id AS id, target_map_id, 1.5::DOUBLE AS y FROM edges"),
    "numbered_refs": (("ref_segments",), "SELECT ref_id, row_number() OVER (ORDER BY road_class, geometry_id, ref_id) AS place FROM ref_segments"),
    "refs_in_box": (("ref_points",), ", k AS (SELECT line_id, pt_idx, x, y, list_sum(list_transform(range(26), lambda i: ((a >> i) & 1) * (1::BIGINT << (2 * i + 1)) + ((b >> i) & 1) * (1::BIGINT << (2 * i))))::BIGINT AS key FROM (SELECT *, ABS(ROUND(x * 1e5))::BIGINT AS a, ABS(ROUND(y * 1e5))::BIGINT AS b FROM ref_points)) SELECT line_id, least(arg_min(key, pt_idx), arg_max(key, pt_idx)) AS place_key, MIN(x) AS min_x, MIN(y) AS min_y, MAX(x) AS max_x, MAX(y) AS max_y FROM k GROUP BY line_id HAVING MIN(x) <= -73.015 AND MAX(x) >= -73.805 AND MIN(y) <= 89 AND MAX(y) >= 39"),
    "geoprox_keys": (("crossings",), "SELECT node_id, list_sum(list_transform(range(26), lambda i: ((a >> i) & 1) * (1::BIGINT << (2 * i + 1)) + ((b >> i) & 1) * (1::BIGINT << (2 * i))))::BIGINT AS key FROM (SELECT node_id, ABS(ROUND(x * 1e5))::BIGINT AS a, ABS(ROUND(y * 1e5))::BIGINT AS b FROM crossings)"),
    "ordered_refs": (("ref_segments",), "SELECT road_class, geometry_id, ref_id FROM ref_segments"),
    "ref_roadway_metadata": (("ref_segments",), "SELECT ref_id, geometry_id, is_forward, road_class, form_of_way, length_km FROM ref_segments"),
    "code_lookups": (("ref_segments",), "SELECT road_class, ['Motorway', 'Trunk', 'Primary', 'Secondary', 'Tertiary', 'Residential', 'Unclassified', 'Service', 'Other'][road_class + 1] AS description, COUNT(*) AS n FROM ref_segments GROUP BY road_class"),
    "stop_points": (("stations",), "SELECT point_id AS stop_id, x AS lon, y AS lat FROM stations WHERE point_id % 9 > 0"),
    "semi_keys": (("chosen_matches", "edge_candidates"), "SELECT path_id, path_edge_idx, edge_id, is_forward, ref_id FROM chosen_matches WHERE (edge_id, ref_id) IN (SELECT (edge_id, ref_id) FROM edge_candidates)"),
    "anti_keys": (("first_round", "edge_candidates"), ", l AS (SELECT CASE WHEN edge_id % 211 > 0 THEN edge_id END AS edge_id, CASE WHEN ref_id % 212 > 0 THEN ref_id END AS ref_id FROM first_round), r AS (SELECT DISTINCT CASE WHEN edge_id % 997 > 0 THEN edge_id END AS e, CASE WHEN ref_id % 998 > 0 THEN ref_id END AS f FROM edge_candidates WHERE section_end > 0.88) SELECT edge_id, ref_id FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE (l.edge_id IS NULL OR r.e IS NULL OR l.edge_id = r.e) AND (l.ref_id IS NULL OR r.f IS NULL OR l.ref_id = r.f))"),
    "sort_nested": (("edge_candidates",), "SELECT edge_id, string_agg(ref_id, ',' ORDER BY section_end, ref_id, section_start) AS refs FROM edge_candidates GROUP BY edge_id"),
    "sorted_ints": (("way_nodes",), "SELECT way_id, '[' || string_agg(node_id, ',' ORDER BY node_id) || ']' AS ids FROM way_nodes GROUP BY way_id"),
    "assembled_references": (("section_ways", "street_points", "ref_segments", "ref_steps"), """, r AS (SELECT * FROM ref_segments WHERE road_class > 0 OR is_forward = 1), lone AS (SELECT geometry_id, COUNT(*) = 1 AS is_unidirectional FROM r GROUP BY geometry_id),
      w AS (SELECT geometry_id, MIN(road_class) AS min_road_class, MAX(road_class) AS max_road_class, string_agg(DISTINCT highway, '|' ORDER BY highway) AS highways, array_to_string(list_sort(list(DISTINCT road_class)), ',') AS road_classes, string_agg(section_idx || ':' || way_id, ',' ORDER BY section_idx) AS sections, string_agg(way_id || ',' || node_id, ',' ORDER BY section_idx) AS node_ids FROM section_ways GROUP BY geometry_id),
      c AS (SELECT ref_id, string_agg(ROUND(x + 1e-9, 5)::DECIMAL(12, 5) || ' ' || ROUND(y + 1e-9, 5)::DECIMAL(12, 5), ',' ORDER BY pt_idx) AS coords FROM street_points GROUP BY ref_id)
      SELECT ref_id, from_node, to_node, min_road_class, max_road_class, highways, road_classes, sections, node_ids, ROUND(total + 1e-9, 5) AS length_km, is_unidirectional, coords FROM r JOIN lone USING (geometry_id) JOIN w USING (geometry_id) JOIN c USING (ref_id) JOIN (SELECT line_id AS ref_id, SUM(km) AS total FROM ref_steps GROUP BY line_id) USING (ref_id)"""),
    "grouped_features": (("way_tags",), "SELECT highway, service, string_agg(way_id, ',' ORDER BY way_id) AS ways FROM way_tags GROUP BY highway, service"),
    "match_metadata": (("edge_candidates", "edges", "ref_segments"), "SELECT target_map_id, string_agg(c.ref_id || ':' || COALESCE(geometry_id::VARCHAR, '-') || ':' || COALESCE(road_class::VARCHAR, '-') || ':' || COALESCE(form_of_way::VARCHAR, '-'), ',' ORDER BY section_start, section_end, c.ref_id) AS matches FROM edge_candidates c JOIN edges USING (edge_id) LEFT JOIN ref_segments r ON r.ref_id = c.ref_id GROUP BY target_map_id"),
    "chosen_metadata": (("chosen_matches", "edges", "ref_segments"), "SELECT target_map_id, string_agg(path_id || ':' || path_edge_idx || ':' || c.is_forward || ':' || match_idx || ':' || c.ref_id || ':' || COALESCE(road_class::VARCHAR, '-'), ',' ORDER BY path_id, path_edge_idx, c.is_forward, match_idx, c.ref_id) AS matches FROM chosen_matches c JOIN edges USING (edge_id) LEFT JOIN ref_segments r ON r.ref_id = c.ref_id GROUP BY target_map_id"),
    "list_assigned": (("consolidated", "edges", "ref_steps", "ref_segments_lines"), f", cuts AS (SELECT c.*, target_map_id FROM consolidated c JOIN edges USING (edge_id)) {CUT} SELECT ref_id, target_map_id, is_forward, section_start, section_end, {POINTS} FROM sliced"),
    "list_disputed": (("disputed", "edges", "ref_steps", "ref_segments_lines"), f", cuts AS (SELECT c.*, target_map_id FROM disputed c JOIN edges USING (edge_id)) {CUT} SELECT {CLAIM}, target_map_id, {POINTS} FROM sliced"),
    "list_undisputed": (("undisputed", "edges", "ref_steps", "ref_segments_lines"), f", cuts AS (SELECT c.*, target_map_id FROM undisputed c JOIN edges USING (edge_id)) {CUT} SELECT {CLAIM}, target_map_id, {POINTS} FROM sliced"),
    "union_distinct": (("first_round", "later_round"), f"SELECT {SECTION} FROM first_round UNION SELECT {SECTION} FROM later_round"),
    "subtract_rows": (("first_round", "later_round"), f"SELECT {SECTION} FROM first_round EXCEPT SELECT {SECTION} FROM later_round"),
    "intersect_rows": (("first_round", "later_round"), f"SELECT {SECTION} FROM first_round INTERSECT SELECT {SECTION} FROM later_round"),
    "new_violations": (("first_round", "later_round"), f", a AS (SELECT ref_id, edge_id, is_forward, ROUND(section_start, 4) AS section_start, ROUND(section_end, 4) AS section_end FROM first_round), b AS (SELECT ref_id, edge_id, is_forward, ROUND(section_start, 4) AS section_start, ROUND(section_end, 4) AS section_end FROM later_round) SELECT * FROM b WHERE section_start < section_end EXCEPT SELECT * FROM a WHERE section_start < section_end"),
    "snapshots": (("later_round",), "SELECT path_id, path_edge_idx, is_forward, match_idx, 'ris' AS map, 2021 AS ts FROM later_round"),
    "diff_features": (("first_round", "later_round", "ref_segments", "ref_steps", "ref_segments_lines"), f", a AS (SELECT DISTINCT {SECTION} FROM first_round), b AS (SELECT DISTINCT {SECTION} FROM later_round), d AS (SELECT {SECTION}, 'a-b' AS diff FROM (FROM a EXCEPT FROM b) UNION ALL SELECT {SECTION}, 'b-a' FROM (FROM b EXCEPT FROM a) UNION ALL SELECT {SECTION}, 'both' FROM (FROM a INTERSECT FROM b)), cuts AS (SELECT d.*, ROUND(section_start / length_km + 1e-9, 6) AS from_share, ROUND(section_end / length_km + 1e-9, 6) AS to_share FROM d JOIN (SELECT ref_id, length_km FROM ref_segments) USING (ref_id)) {CUT} SELECT {SECTION}, diff, from_share, to_share, {POINTS} FROM sliced"),
    "input_layers": (("nodes", "way_nodes", "road_class", "ref_segments", "edges"), "SELECT 'nodes' AS layer, node_id AS id, NULL::BIGINT AS n_nodes FROM nodes WHERE node_id IN (SELECT node_id FROM way_nodes WHERE way_id IN (SELECT way_id FROM road_class)) UNION ALL SELECT 'ways', way_id, COUNT(*) FROM way_nodes WHERE way_id IN (SELECT way_id FROM road_class) GROUP BY way_id UNION ALL SELECT 'references', ref_id, NULL FROM ref_segments UNION ALL SELECT 'edges', edge_id, NULL FROM edges"),
    "missing_geometry": ((), "SELECT o_orderkey FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0"),
    "always_null_columns": ((), "SELECT 'route_numb' AS \"column\" WHERE EXISTS (SELECT 1 FROM orders)"),
    "schema_diff": ((), "SELECT kind, c AS \"column\", (SELECT COUNT(*) FROM orders) AS n_rows FROM (VALUES ('missing', 'o_clerk'), ('missing', 'o_comment'), ('unexpected', 'o_custkey'), ('unexpected', 'o_orderdate'), ('unexpected', 'o_orderpriority'), ('unexpected', 'o_orderstatus'), ('unexpected', 'o_totalprice')) AS t(kind, c)"),
    "check_segments": ((), "SELECT tmc, failed FROM (SELECT o_orderkey AS tmc, unnest([CASE WHEN o_orderkey % 31 > 0 AND o_orderkey % 9 NOT BETWEEN 1 AND 7 AND y = 2019 THEN 'f_system' END, CASE WHEN o_custkey % 8 NOT BETWEEN 1 AND 6 THEN 'faciltype' END, CASE WHEN o_orderkey % 12 NOT BETWEEN 1 AND 10 AND y = 2019 THEN 'route_sign' END, CASE WHEN o_totalprice / 4000 NOT BETWEEN 0 AND 100 THEN 'nhs_pct' END]) AS failed FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 2017 ELSE 2019 END AS y FROM orders)) WHERE failed IS NOT NULL"),
    "check_inventory": ((), "SELECT fid, failed FROM (SELECT o_orderkey AS fid, unnest([CASE WHEN o_orderkey % 23 = 0 THEN 'mileposts' END, CASE WHEN o_orderkey % 4 > 2 THEN 'direction' END, CASE WHEN o_orderkey % 21 NOT BETWEEN 1 AND 19 THEN 'class' END, CASE WHEN COUNT(*) OVER (PARTITION BY o_custkey, o_orderkey % 40) > 1 THEN 'repeated' END]) AS failed FROM orders) WHERE failed IS NOT NULL"),
    "check_geometry": (("way_nodes",), "SELECT way_id, 'vertices' AS failed FROM way_nodes GROUP BY way_id HAVING COUNT(*) < 2"),
    "check_references": (("ref_segments",), "SELECT ref_id, failed FROM (SELECT ref_id, unnest([CASE WHEN ref_id % 110 = 0 THEN 'locations' END, CASE WHEN ref_id % 50 = 0 AND ref_id % 110 > 0 THEN 'sequence' END, CASE WHEN CASE WHEN ref_id % 110 = 0 THEN from_node <> to_node ELSE ref_id % 70 = 0 END THEN 'to' END]) AS failed FROM ref_segments) WHERE failed IS NOT NULL"),
    "broken_locations": (("ref_points",), f"SELECT line_id AS ref_id FROM ({ENDS.format('ref_points')}) WHERE CASE WHEN line_id % 110 = 0 THEN x1 <> x2 OR y1 <> y2 ELSE line_id % 90 = 0 END"),
    "base_map_anomalies": (("ref_segments",), "SELECT ref_id, failed FROM (SELECT ref_id, unnest([CASE WHEN ref_id % 130 = 0 THEN 'empty_locations' END, CASE WHEN ref_id % 140 = 0 THEN 'no_metadata' END, CASE WHEN ref_id % 150 = 0 THEN 'bad_coordinates' END]) AS failed FROM ref_segments) WHERE failed IS NOT NULL"),
    "canonical_violations": (("nodes",), "SELECT node_id, 2 AS n FROM nodes WHERE node_id % 100 = 0"),
    "require_complete": (("ref_segments", "edges"), "SELECT (SELECT COUNT(*) FROM ref_segments) AS n_refs, (SELECT COUNT(*) FROM edges) AS n_edges"),
    "station_keys": ((), "SELECT s_suppkey, lpad(s_nationkey::VARCHAR, 2, '0') || '_' || lpad(s_suppkey::VARCHAR, 4, '0') AS rc_station FROM supplier"),
    "assigned_directions": (("consolidated", "path_edges", "edges", "station"), f", p AS (SELECT path_id, ROUND(SUM(edge_length_km), 4) AS path_km, path_id % 360 - 180 AS bearing FROM path_edges JOIN edges USING (edge_id) GROUP BY path_id), r AS (SELECT target_map_id, is_forward, bearing, edge_id, row_number() OVER (PARTITION BY target_map_id, is_forward ORDER BY path_km DESC, path_id) AS k FROM (SELECT DISTINCT edge_id, is_forward FROM consolidated) JOIN (SELECT DISTINCT path_id, edge_id FROM path_edges) USING (edge_id) JOIN p USING (path_id) JOIN edges USING (edge_id)), t AS (SELECT target_map_id, r.is_forward, COALESCE(s.d, []) AS d, CASE WHEN is_forward = 1 THEN bearing WHEN bearing <= 0 THEN bearing + 180 ELSE bearing - 180 END AS b FROM r LEFT JOIN (SELECT substr(rc_station, 4, 4)::BIGINT AS n, d FROM station) s ON s.n = r.edge_id % 50 WHERE k = 1), whole AS (SELECT *, CASE WHEN b > 180 THEN b - 360 WHEN b < -180 THEN b + 360 ELSE b END AS w FROM t) SELECT target_map_id, is_forward, {DIRECTION} AS federal_direction FROM whole"),
    "infer_directions": (("osm_nodes", "section_nodes"), ", p AS (SELECT way_id, node_id AS a, lead(node_id) OVER (PARTITION BY way_id ORDER BY node_idx) AS b FROM osm_nodes), q AS (SELECT ref_id, node_id AS a, lead(node_id) OVER (PARTITION BY ref_id ORDER BY node_idx) AS b FROM section_nodes), s AS (SELECT way_id, ref_id, 1 AS f FROM p JOIN q ON p.a = q.a AND p.b = q.b UNION SELECT way_id, ref_id, 0 FROM p JOIN q ON p.a = q.b AND p.b = q.a) SELECT way_id AS seq_id, 2 * ref_id + 1 - f AS ref_id, strategy FROM s CROSS JOIN (VALUES ('nodes'), ('steps')) AS t(strategy)"),
    "ways_with_refs": (("way_nodes", "ref_segments"), "SELECT way_id, array_to_string(list_sort(list(DISTINCT node_id)), ',') AS ref_ids FROM way_nodes JOIN ref_segments ON ref_id = node_id WHERE road_class < 8 GROUP BY way_id"),
    "built_graph": (("ref_points",), f"SELECT line_id AS edge_id, x1 AS fx, y1 AS fy, x2 AS tx, y2 AS ty FROM ({ENDS.format('ref_points')})"),
    "route_paths_topological": (("route_edges",), ROUTES),
    "loaded_paths": (("agency_edges", "agency_points"), f", e AS (SELECT path_id, path_edge_idx, edge_id, x1, y1, x2, y2 FROM agency_edges JOIN ({ENDS.format('agency_points')}) ON line_id = edge_id), g AS (SELECT path_id, arg_min(x1, path_edge_idx) AS x1, arg_min(y1, path_edge_idx) AS y1, arg_max(x2, path_edge_idx) AS x2, arg_max(y2, path_edge_idx) AS y2, string_agg(edge_id, ',' ORDER BY path_edge_idx) AS edges FROM e GROUP BY path_id) SELECT path_id || ':0' AS path_name, ROUND({deg('x1', 'y1', 'x2', 'y2')} + 1e-9, 3) AS bearing, edges FROM g"),
    "merged_lines": (("agency_edges",), "SELECT path_id AS feature_id, path_edge_idx - MIN(path_edge_idx) OVER (PARTITION BY path_id) AS seq, 8 - path_edge_idx AS part_idx FROM agency_edges WHERE along = 1"),
    "line_slices": (("ref_segments", "ref_steps", "ref_segments_lines"), f", cuts AS (SELECT ref_id, 0.1::DOUBLE AS section_start, 0.6::DOUBLE AS section_end FROM ref_segments) {CUT} SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY at_km) - 1 AS pt_idx, ROUND(x + 1e-9, 5) AS x, ROUND(y + 1e-9, 5) AS y FROM (SELECT line_id AS section_id, at_km, x, y FROM spots WHERE at_km > 0.1 AND at_km < 0.6 UNION ALL SELECT ref_id, d_km, x, y FROM tips)"),
    "snap_statistics": (("matched", "agency_steps", "ref_segments_lines"), f", n AS (SELECT a_id, b_id, d, ABS(spot - at_km) AS off FROM (SELECT a_id, b_id, pt_idx, at_km, from_km + t * km AS spot, {NEAREST} AS d FROM (SELECT *, {ALONG} AS t FROM (SELECT edge_id AS a_id, ref_id AS b_id, p.pt_idx, p.x AS px, p.y AS py, at_km, x1, y1, x2, y2, from_km, s.km FROM matched JOIN (SELECT *, SUM(km) OVER (PARTITION BY line_id ORDER BY pt_idx) AS at_km FROM agency_steps) p ON p.line_id = edge_id JOIN ref_segments_lines s ON s.line_id = ref_id WHERE is_forward = 1))) QUALIFY row_number() OVER (PARTITION BY a_id, b_id, pt_idx ORDER BY ROUND(d, 9), ROUND(spot, 9)) = 1) SELECT a_id, b_id, " + ", ".join(f"ROUND({f}({c}) + 1e-9, 5) AS {p}_{n}" for p, c in (("snap", "d"), ("along", "off")) for f, n in (("AVG", "mean"), ("stddev_pop", "stddev"))) + ", " + ", ".join(f"ROUND(quantile_cont({c}, {i / 10}) + 1e-9, 5) AS {p}_{i}0" for p, c in (("snap", "d"), ("along", "off")) for i in range(1, 10)) + " FROM n GROUP BY a_id, b_id"),
    "avg_snap_distances": (("matched", "agency_points", "ref_segments_lines"), f"SELECT a_id, b_id, ROUND(AVG(d) + 1e-9, 5) AS snap_mean FROM (SELECT a_id, b_id, pt_idx, MIN({NEAREST}) AS d FROM (SELECT *, {ALONG} AS t FROM (SELECT edge_id AS a_id, ref_id AS b_id, p.pt_idx, p.x AS px, p.y AS py, x1, y1, x2, y2 FROM matched JOIN agency_points p ON p.line_id = edge_id JOIN ref_segments_lines s ON s.line_id = ref_id WHERE is_forward = 1)) GROUP BY ALL) GROUP BY ALL"),
    "trip_shapes": (("agency_points",), "SELECT line_id AS shape_id, row_number() OVER (PARTITION BY line_id ORDER BY pt_idx) - 1 AS pt_idx, x, y FROM agency_points WHERE line_id % 7 > 0 OR pt_idx <> 1"),
    "shape_matches": (("merged", "path_segments", "ref_points"), f", p AS (SELECT a_id, b_id, pt_idx, MIN(d) AS d, arg_min(spot, ROUND(d, 9)) AS spot FROM (SELECT a_id, b_id, pt_idx, {NEAREST} AS d, from_km + t * km AS spot FROM (SELECT s.line_id AS a_id, r.line_id AS b_id, r.pt_idx, r.x AS px, r.y AS py, x1, y1, x2, y2, from_km, km, {ALONG.replace('px', 'r.x').replace('py', 'r.y')} AS t FROM ref_points r JOIN path_segments s ON ABS(r.x - (x1 + x2) / 2) < 0.02 AND ABS(r.y - (y1 + y2) / 2) < 0.02)) GROUP BY ALL) SELECT a_id AS shape_id, b_id AS ref_id FROM p GROUP BY a_id, b_id HAVING COUNT(*) = 3 AND MAX(d) <= 0.05 AND arg_min(spot, pt_idx) <= arg_max(spot, pt_idx)"),
    "adjacent_lines": (("agency_edges", "agency_points"), f", e AS (SELECT path_id, path_edge_idx, edge_id, x1, y1, x2, y2 FROM agency_edges JOIN ({ENDS.format('agency_points')}) ON line_id = edge_id), p AS (SELECT a.edge_id AS a_id, b.edge_id AS b_id, {km('a.x2', 'a.y2', 'b.x1', 'b.y1')} AS ab, {km('b.x2', 'b.y2', 'a.x1', 'a.y1')} AS ba FROM e a JOIN e b ON a.path_id = b.path_id AND b.path_edge_idx = a.path_edge_idx + 1) SELECT a_id, b_id, CASE WHEN least(ab, ba) <= 0.002 THEN CASE WHEN ab <= ba THEN 'ab' ELSE 'ba' END END AS \"order\", ROUND(least(ab, ba), 4) AS gap_km FROM p"),
    "split_lines": (("ref_steps",), ", n AS (SELECT line_id, km, greatest(ceil(km / 0.4::DOUBLE), 1)::BIGINT AS n FROM (SELECT line_id, SUM(km) AS km FROM ref_steps GROUP BY line_id)), i AS (SELECT *, unnest(range(n)) AS i FROM n) SELECT line_id, line_id || ':' || i AS section_id, ROUND(km * i / n + 1e-9, 4) AS from_km, ROUND(km * (i + 1) / n + 1e-9, 4) AS to_km FROM i"),
    "densified": (("ref_vertices",), "SELECT line_id, 2 * pt_idx AS pt_idx, x, y FROM ref_vertices UNION ALL SELECT line_id, 2 * pt_idx + 1, ROUND((x + nx) / 2, 7), ROUND((y + ny) / 2, 7) FROM ref_vertices WHERE nx IS NOT NULL"),
    "sequence_relations": (("canonical_seq",), "SELECT way_id AS a_id, way_id AS b_id, TRUE AS is_subset, TRUE AS is_subsequence, TRUE AS is_substring FROM canonical_seq WHERE len(ids) > 1"),
    "cospatial_lines": (("matched", "agency_segments", "ref_segments_lines"), cospatial("SELECT edge_id AS a_id, ref_id AS b_id FROM matched WHERE is_forward = 1", "agency_segments", "ref_segments_lines", 0.02)),
    "cospatial_chords": (("ref_segments_lines", "chord_segments"), cospatial("SELECT DISTINCT line_id AS a_id, line_id AS b_id FROM chord_segments", "ref_segments_lines", "chord_segments", 0.006)),
    "coincident_edges": (("agency_edges",), "SELECT edge_id + 1099511627776 AS edge_id, edge_id AS within FROM agency_edges WHERE edge_id % 3 = 0"),
    "infer_units": (("ref_segments",), "SELECT ref_id AS line_id, ['m', 'mi', 'km'][ref_id % 3 + 1] AS unit FROM ref_segments"),
    "snap_sequence": (("agency_edges", "agency_points", "path_segments"), f", e AS (SELECT path_id, path_edge_idx, x1 + 1e-4 AS px, y1 + 1e-4 AS py FROM agency_edges JOIN ({ENDS.format('agency_points')}) ON line_id = edge_id) SELECT path_id AS seq_id, path_edge_idx AS pt_no, ROUND(MIN({NEAREST}) + 1e-9, 4) AS dist_km FROM (SELECT *, {ALONG} AS t FROM e JOIN path_segments s ON s.line_id = path_id) GROUP BY ALL"),
    "dissimilar_lines": (("matched", "agency_points", "ref_points", "ref_segments_lines"), f", a AS (SELECT edge_id AS a_id, ref_id AS b_id, pt_idx, p.x - x1 + rx AS px, p.y - y1 + ry AS py FROM matched JOIN agency_points p ON p.line_id = edge_id JOIN (SELECT line_id, arg_min(x, pt_idx) AS x1, arg_min(y, pt_idx) AS y1 FROM agency_points GROUP BY line_id) s ON s.line_id = edge_id JOIN (SELECT line_id, arg_min(x, pt_idx) AS rx, arg_min(y, pt_idx) AS ry FROM ref_points GROUP BY line_id) r ON r.line_id = ref_id WHERE is_forward = 1), n AS (SELECT a_id, b_id, pt_idx, MIN({NEAREST}) AS d FROM (SELECT a.*, x1, y1, x2, y2, {ALONG} AS t FROM a JOIN ref_segments_lines s ON s.line_id = b_id) GROUP BY ALL) SELECT a_id, b_id, ROUND(AVG(CASE WHEN d > 0.05 THEN 2 * d ELSE d END) / any_value(total) + 1e-9, 3) AS dissimilarity FROM n JOIN (SELECT line_id AS b_id, SUM(km) AS total FROM ref_segments_lines GROUP BY line_id) USING (b_id) GROUP BY a_id, b_id"),
    "source_sink_pairs": (("oneways",), ", t AS (SELECT node, COUNT(*) FILTER (o = 0) AS n_in, COUNT(*) FILTER (o = 1) AS n_out FROM (SELECT from_node AS node, 1 AS o FROM oneways UNION ALL SELECT to_node, 0 FROM oneways) GROUP BY node), " + relaxed("SELECT 0 AS grp, from_node, to_node, 1::DOUBLE AS w FROM oneways", "SELECT 0 AS grp, node AS source FROM t WHERE n_in = 0", 40) + " SELECT source, r.node AS sink FROM r40 r JOIN t ON t.node = r.node WHERE n_out = 0 AND source <> r.node"),
}
