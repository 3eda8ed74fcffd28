"""DuckDB SQL for the registered queries: shared definitions, and one statement a query."""

from __future__ import annotations

from strandweave.plans import loop_sql
from strandweave.plans.fixtures import ctes

LIB = {
    "claims": """SELECT path_id, path_edge_idx, edge_id, is_forward, match_idx, ref_id, ROUND(section_start, 4) AS section_start, ROUND(section_end, 4) AS section_end
  FROM {chosen_matches} WHERE ROUND(section_start, 4) < ROUND(section_end, 4)""",
    "disputed": """SELECT DISTINCT a.* FROM {claims} a WHERE EXISTS (SELECT 1 FROM {claims} b WHERE a.ref_id = b.ref_id AND a.path_id <> b.path_id AND a.section_start < b.section_end AND b.section_start < a.section_end)""",
    "undisputed": """SELECT DISTINCT * FROM {claims} EXCEPT SELECT * FROM {disputed}""",
    "hull": """SELECT ref_id, edge_id, is_forward, MIN(section_start) AS section_start, MAX(section_end) AS section_end FROM {claims} GROUP BY ALL""",
    "consolidated": """SELECT a.* FROM {hull} a WHERE NOT EXISTS (SELECT 1 FROM {hull} b WHERE a.ref_id = b.ref_id AND a.edge_id = b.edge_id AND a.section_start < b.section_end AND b.section_start < a.section_end
    AND (((a.section_start <> b.section_start OR a.section_end <> b.section_end) AND ROUND(a.section_end - a.section_start, 9) <= ROUND(b.section_end - b.section_start, 9))
      OR (a.section_start = b.section_start AND a.section_end = b.section_end AND b.is_forward > a.is_forward)))""",
    "first_claims": """SELECT path_id, path_edge_idx, edge_id, is_forward, match_idx, ref_id, ROUND(section_start, 4) AS section_start, ROUND(section_end, 4) AS section_end FROM {first_round} WHERE ROUND(section_start, 4) < ROUND(section_end, 4)""",
    "reached": """SELECT ref_id, edge_id, is_forward, section_start, section_end, MAX(section_end) OVER (PARTITION BY ref_id, edge_id, is_forward ORDER BY section_start, section_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT ref_id, edge_id, is_forward, section_start, section_end FROM {claims})""",
    "islands": """SELECT *, SUM(CASE WHEN reach IS NULL OR section_start - reach > 1e-5 THEN 1 ELSE 0 END) OVER (PARTITION BY ref_id, edge_id, is_forward ORDER BY section_start, section_end ROWS UNBOUNDED PRECEDING) AS island FROM {reached}""",
    "pieces_strict": """SELECT ref_id, edge_id, is_forward, MIN(section_start) AS section_start, MAX(section_end) AS section_end FROM {islands} GROUP BY ref_id, edge_id, is_forward, island""",
    "last_idx": """SELECT path_id, MAX(path_edge_idx) AS last_idx, arg_max(edge_id, path_edge_idx) AS last_edge FROM {path_edges} GROUP BY path_id""",
    "trim": """SELECT DISTINCT path_id, path_edge_idx, is_forward, match_idx,
    CASE WHEN last_idx = 0 THEN NULL WHEN (path_edge_idx = 0 AND is_forward = 1) OR (path_edge_idx = last_idx AND is_forward <> 1) THEN 1 WHEN path_edge_idx = 0 OR path_edge_idx = last_idx THEN CASE WHEN match_idx > 0 THEN 1 ELSE 0 END ELSE 0 END AS start_trimmable,
    CASE WHEN last_idx = 0 THEN NULL WHEN (path_edge_idx = 0 AND is_forward = 1) OR (path_edge_idx = last_idx AND is_forward <> 1) THEN CASE WHEN from_end > 1 THEN 1 ELSE 0 END WHEN path_edge_idx = 0 OR path_edge_idx = last_idx THEN 1 ELSE 0 END AS end_trimmable
  FROM (SELECT *, row_number() OVER (PARTITION BY path_id, path_edge_idx, is_forward ORDER BY match_idx DESC, ref_id) AS from_end FROM {chosen_matches}) c JOIN {last_idx} USING (path_id)""",
    "meta": """SELECT a.ref_id, a.geometry_id, a.is_forward, b.ref_id AS opposite_ref_id, a.road_class, a.form_of_way, a.length_km FROM {ref_segments} a LEFT JOIN {ref_segments} b ON a.geometry_id = b.geometry_id AND b.is_forward = 1 - a.is_forward""",
    "reverse": """SELECT DISTINCT c.*, m.opposite_ref_id FROM {claims} c JOIN {meta} m USING (ref_id) JOIN {consolidated} o ON o.ref_id = m.opposite_ref_id AND o.edge_id = c.edge_id
  WHERE c.section_start < ROUND(m.length_km - o.section_start, 4) AND ROUND(m.length_km - o.section_end, 4) < c.section_end""",
    "reverse_disputed": """SELECT DISTINCT c.ref_id, c.edge_id FROM {disputed} c JOIN {meta} m USING (ref_id) JOIN {consolidated} o ON o.ref_id = m.opposite_ref_id AND o.edge_id = c.edge_id
  WHERE c.section_start < ROUND(m.length_km - o.section_start, 4) AND ROUND(m.length_km - o.section_end, 4) < c.section_end""",
    "stats": """SELECT path_id, path_edge_idx, edge_id, is_forward, is_unidirectional, edge_length_km, chosen_km, total_deviance, (is_forward = 1 AND path_edge_idx = 0) OR (is_forward <> 1 AND path_edge_idx = last_idx) AS is_first, (is_forward = 1 AND path_edge_idx = last_idx) OR (is_forward <> 1 AND path_edge_idx = 0) AS is_last,
    ROUND(edge_length_km - chosen_km + 1e-9, 4) AS length_diff, ROUND(chosen_km / NULLIF(edge_length_km, 0) + 1e-9, 4) AS length_ratio, ROUND(total_deviance / NULLIF(chosen_km, 0) + 1e-9, 6) AS avg_deviance
  FROM (SELECT path_id, path_edge_idx, edge_id, is_forward, ROUND(SUM(section_end - section_start) + 1e-9, 4) AS chosen_km, ROUND(SUM(avg_deviance_km * (section_end - section_start)) + 1e-9, 8) AS total_deviance FROM {chosen_matches} GROUP BY ALL) s
  JOIN {last_idx} USING (path_id) JOIN {edges} USING (edge_id)""",
    "preferred": """SELECT path_id, edge_id, a.path_edge_idx AS forward_idx, b.path_edge_idx AS backward_idx, a.avg_deviance < b.avg_deviance AS forward_preferred,
    ROUND(greatest(a.avg_deviance, b.avg_deviance) / NULLIF(least(a.avg_deviance, b.avg_deviance), 0) + 1e-9, 6) AS deviance_ratio,
    ROUND(greatest(a.avg_deviance, b.avg_deviance) / NULLIF(least(a.avg_deviance, b.avg_deviance), 0) + 1e-9, 6) > 1.1 AS deviance_sufficient,
    ROUND((CASE WHEN a.avg_deviance < b.avg_deviance THEN a.chosen_km ELSE b.chosen_km END) / NULLIF(a.edge_length_km, 0) + 1e-9, 6) BETWEEN 0.9 AND 1.15 OR ROUND(ABS(a.chosen_km - b.chosen_km) / NULLIF(a.edge_length_km, 0) + 1e-9, 6) < 0.1 AS distance_sufficient
  FROM {stats} a JOIN {stats} b USING (path_id, edge_id) WHERE a.is_unidirectional = 1 AND a.is_forward = 1 AND b.is_forward = 0""",
    "at_path": """SELECT c.*, path_edge_idx <> 0 AND path_edge_idx <> last_idx AS inside FROM {chosen_matches} c JOIN {last_idx} USING (path_id)""",
    "suspects": """SELECT DISTINCT a.edge_id, a.ref_id FROM {at_path} a JOIN {at_path} c ON a.edge_id = c.edge_id AND a.path_id <> c.path_id WHERE NOT a.inside AND c.inside EXCEPT SELECT edge_id, ref_id FROM {at_path} WHERE inside""",
    "shared": """SELECT edge_id, COUNT(DISTINCT path_id) AS n_paths FROM {path_edges} GROUP BY edge_id HAVING COUNT(DISTINCT path_id) > 1""",
    "known": """SELECT path_id, edge_id, c.ref_id, k.ref_id IS NOT NULL AS known FROM {chosen_matches} c JOIN {shared} USING (edge_id) LEFT JOIN (SELECT DISTINCT edge_id, ref_id FROM {edge_candidates}) k USING (edge_id, ref_id)""",
    "losers": """SELECT DISTINCT path_id, edge_id, ref_id FROM {known} WHERE NOT known AND edge_id IN (SELECT edge_id FROM {known} GROUP BY path_id, edge_id HAVING bool_and(known))""",
    "metrics": """SELECT edge_id, edge_length_km, is_unidirectional, NULLIF(forward_km, 0) AS forward_km, NULLIF(backward_km, 0) AS backward_km FROM {edges} LEFT JOIN
  (SELECT edge_id, ROUND(SUM(CASE WHEN is_forward = 1 THEN section_end - section_start END) + 1e-9, 4) AS forward_km, ROUND(SUM(CASE WHEN is_forward = 0 THEN section_end - section_start END) + 1e-9, 4) AS backward_km FROM {consolidated} GROUP BY edge_id) USING (edge_id)""",
    "diffs": """SELECT *, ROUND(edge_length_km - forward_km + 1e-9, 4) AS forward_diff, ROUND(edge_length_km - backward_km + 1e-9, 4) AS backward_diff FROM {metrics}""",
    "worst": """SELECT *, greatest(ABS(forward_diff), ABS(backward_diff)) AS worst_diff FROM {diffs}""",
    "matching": """SELECT *, COALESCE(worst_diff < 0.005, FALSE) AS under_5m, COALESCE(worst_diff >= 0.005 AND worst_diff < 0.01, FALSE) AS from_5_to_10m, COALESCE(worst_diff >= 0.01 AND worst_diff < 0.1, FALSE) AS from_10_to_100m, COALESCE(worst_diff >= 0.1, FALSE) AS over_100m FROM {worst}""",
    "clamped": """SELECT c.ref_id, edge_id, c.is_forward, greatest(section_start, 0) AS section_start, least(section_end, length_km) AS section_end, CASE WHEN edge_id % 2 = 0 THEN 'tmc' ELSE 'ris' END AS map FROM {consolidated} c JOIN {ref_segments} r ON c.ref_id = r.ref_id WHERE ROUND(least(section_end, length_km) - greatest(section_start, 0), 9) > 0.0001""",
    "points": """SELECT DISTINCT ref_id, length_km, cut_km FROM (SELECT ref_id, length_km, unnest([section_start, section_end]) AS cut_km FROM {consolidated} c JOIN (SELECT ref_id, length_km FROM {ref_segments}) USING (ref_id) UNION ALL SELECT ref_id, length_km, unnest([0::DOUBLE, length_km]) AS cut_km FROM {ref_segments}) WHERE cut_km >= 0 AND cut_km <= length_km""",
    "parts": """SELECT ref_id, row_number() OVER (PARTITION BY ref_id ORDER BY cut_km) - 1 AS part_idx, cut_km AS part_start, part_end FROM
  (SELECT *, lead(cut_km) OVER (PARTITION BY ref_id ORDER BY cut_km) AS part_end FROM
    (SELECT ref_id, CASE WHEN lead(cut_km) OVER (PARTITION BY ref_id ORDER BY cut_km) IS NULL THEN length_km ELSE cut_km END AS cut_km FROM
      (SELECT *, lag(cut_km) OVER (PARTITION BY ref_id ORDER BY cut_km) AS prev FROM {points}) WHERE prev IS NULL OR ROUND(cut_km - prev, 9) > 0.0001)) WHERE part_end IS NOT NULL""",
    "cut_points": """SELECT DISTINCT ref_id, length_km, cut_km FROM (SELECT ref_id, length_km, unnest([section_start, section_end]) AS cut_km FROM {clamped} c JOIN (SELECT ref_id, length_km FROM {ref_segments}) USING (ref_id) UNION ALL SELECT ref_id, length_km, unnest([0::DOUBLE, length_km]) AS cut_km FROM {ref_segments}) WHERE cut_km >= 0 AND cut_km <= length_km""",
    "attached": """SELECT p.ref_id, part_idx, part_start, part_end, map, edge_id, is_forward, section_start, section_end, row_number() OVER (PARTITION BY p.ref_id, part_idx, map ORDER BY section_start DESC, section_end DESC, edge_id DESC, is_forward DESC) AS rn
  FROM {map_parts} p JOIN {clamped} c ON p.ref_id = c.ref_id AND c.section_start < p.part_end AND p.part_start < c.section_end""",
    "road_class": """SELECT way_id, CASE WHEN h LIKE 'motorway%' THEN 0 WHEN h LIKE 'trunk%' THEN 1 WHEN h LIKE 'primary%' THEN 2 WHEN h LIKE 'secondary%' THEN 3 WHEN h LIKE 'tertiary%' THEN 4 WHEN h LIKE 'unclassified%' THEN 6 WHEN h LIKE 'residential%' THEN 5
    WHEN h LIKE 'service%' THEN CASE WHEN s LIKE 'parking%' OR s LIKE 'driveway%' OR s LIKE 'drive-through%' THEN 8 ELSE 7 END WHEN h LIKE 'living!_street%' ESCAPE '!' THEN 5 ELSE 8 END AS road_class
  FROM (SELECT way_id, lower(trim(highway)) AS h, lower(trim(service)) AS s FROM {way_tags}) WHERE NULLIF(h, '') IS NOT NULL""",
    "canonical": """SELECT node_id, first_value(node_id) OVER (PARTITION BY ROUND(lon, 6), ROUND(lat, 6) ORDER BY COALESCE(crossing, 0) DESC, COALESCE(best, 9), node_id) AS canonical_id FROM {nodes} LEFT JOIN
  (SELECT node_id, CASE WHEN COUNT(DISTINCT way_id) > 1 THEN 1 ELSE 0 END AS crossing, MIN(COALESCE(road_class, 9)) AS best FROM {way_nodes} LEFT JOIN {road_class} USING (way_id) GROUP BY node_id) USING (node_id)""",
    "canonical_seq": """SELECT way_id, list(canonical_id ORDER BY node_idx) AS ids FROM (SELECT way_id, node_idx, canonical_id, lag(canonical_id) OVER (PARTITION BY way_id ORDER BY node_idx) AS prev FROM {way_nodes} JOIN {canonical} USING (node_id)) WHERE prev IS NULL OR prev <> canonical_id GROUP BY way_id""",
    "extent": """SELECT MIN(a) AS first_date, MAX(b) AS last_date, datediff('day', MIN(a), MAX(b)) + 1 AS n_days FROM (SELECT strptime(start_date, '%Y%m%d')::DATE AS a, strptime(end_date, '%Y%m%d')::DATE AS b FROM {calendar} UNION ALL SELECT strptime(date, '%Y%m%d')::DATE, strptime(date, '%Y%m%d')::DATE FROM {calendar_dates} WHERE exception_type = 1)""",
    "dates": """SELECT d::DATE AS date, dayofweek(d::DATE) AS dow FROM (SELECT unnest(generate_series(first_date, last_date, INTERVAL 1 DAY)) AS d FROM {extent})""",
    "services": """SELECT *, dayofweek(date) AS dow FROM (
  (SELECT service_id, date FROM {calendar} JOIN {dates} ON date BETWEEN strptime(start_date, '%Y%m%d')::DATE AND strptime(end_date, '%Y%m%d')::DATE WHERE [sunday, monday, tuesday, wednesday, thursday, friday, saturday][dow + 1] = 1
   UNION SELECT service_id, strptime(date, '%Y%m%d')::DATE FROM {calendar_dates} WHERE exception_type = 1)
  EXCEPT SELECT service_id, strptime(date, '%Y%m%d')::DATE FROM {calendar_dates} WHERE exception_type = 2)""",
    "times": """SELECT trip_id, MIN(s) AS start_s, MAX(s) AS end_s FROM (SELECT trip_id, CAST(split_part(arrival_time, ':', 1) AS INT) * 3600 + CAST(split_part(arrival_time, ':', 2) AS INT) * 60 + CAST(split_part(arrival_time, ':', 3) AS INT) AS s FROM {stop_times}) GROUP BY trip_id""",
    "placed": """SELECT *, CAST(floor(start_of / 5) AS INT) AS start_epoch, CAST(floor(end_of / 5) AS INT) AS end_epoch FROM (
  SELECT trip_id, service_id, dow, start_s, end_s, dow + start_s // 86400 AS start_dow, dow + end_s // 86400 AS end_dow, (start_s % 86400) / 60 AS start_of, (end_s % 86400) / 60 AS end_of, ROUND((end_s - start_s) / 60 + 1e-9) AS minutes
  FROM (SELECT DISTINCT trip_id, service_id FROM {trips}) JOIN {times} USING (trip_id) JOIN (SELECT DISTINCT service_id, dow FROM {services}) USING (service_id))""",
    "periods": """SELECT *, CASE WHEN start_epoch BETWEEN 72 AND 239 THEN CASE WHEN start_dow BETWEEN 1 AND 5 THEN CASE WHEN start_epoch < 120 THEN 'AMP' WHEN start_epoch < 192 THEN 'MIDD' ELSE 'PMP' END ELSE 'WE' END ELSE 'OVN' END AS start_period,
    CASE WHEN end_epoch BETWEEN 72 AND 239 THEN CASE WHEN end_dow BETWEEN 1 AND 5 THEN CASE WHEN end_epoch < 120 THEN 'AMP' WHEN end_epoch < 192 THEN 'MIDD' ELSE 'PMP' END ELSE 'WE' END ELSE 'OVN' END AS end_period,
    ROUND(least(CASE WHEN start_epoch < 72 THEN 360 WHEN start_epoch >= 240 THEN 1440 - 1::DOUBLE / 60 + 360 WHEN start_dow NOT BETWEEN 1 AND 5 THEN 1200 WHEN start_epoch < 120 THEN 600 WHEN start_epoch < 192 THEN 960 ELSE 1200 END - start_of, minutes) + 1e-9) AS start_minutes,
    ROUND(least(end_of - CASE WHEN end_epoch < 72 THEN -240 WHEN end_epoch >= 240 THEN 1200 WHEN start_dow NOT BETWEEN 1 AND 5 OR end_epoch < 120 THEN 360 WHEN end_epoch < 192 THEN 600 ELSE 960 END, minutes) + 1e-9) AS end_minutes FROM {placed}""",
    "trip_rows": """SELECT trip_id, service_id, dow, start_s, end_s, start_dow, end_dow, start_epoch, end_epoch, start_period, end_period, minutes, start_minutes, end_minutes, CASE WHEN start_minutes > end_minutes THEN start_period ELSE end_period END AS time_period FROM {periods}""",
    "runs": """SELECT trip_id, time_period, SUM(n)::BIGINT AS n_runs FROM {trip_rows} JOIN (SELECT service_id, dow, COUNT(*) AS n FROM {services} GROUP BY ALL) USING (service_id, dow) GROUP BY ALL""",
    "on_segments": """SELECT DISTINCT trip_id, route_id, geometry_id AS segment_id FROM {trips} JOIN {shape_refs} USING (shape_id) JOIN {ref_segments} USING (ref_id)""",
    "bus": """SELECT segment_id, route_id, """
    + ", ".join(f"ROUND(COALESCE(SUM(CASE WHEN time_period = '{p}' THEN n_runs END), 0) * 365 / any_value(n_days) + 1e-9, 3) AS {p.lower()}" for p in ("AMP", "MIDD", "PMP", "WE", "OVN"))
    + """ FROM {on_segments} JOIN {runs} USING (trip_id) CROSS JOIN {extent} GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY segment_id, route_id"),
    "aadt": "SELECT segment_id, route_id, " + ", ".join(f"ROUND({p} / 365 + 1e-9, 3) AS {p}" for p in ("amp", "midd", "pmp", "we", "ovn")) + " FROM {bus}",
    "station": """SELECT rc_station, year, list(DISTINCT federal_direction ORDER BY federal_direction) AS d FROM (SELECT *, rank() OVER (PARTITION BY rc_station ORDER BY year DESC) AS r FROM {station_directions}) WHERE r = 1 GROUP BY ALL""",
    "touching": """SELECT node, COUNT(*) FILTER (o = 0) AS n_in, COUNT(*) FILTER (o = 1) AS n_out, COUNT(DISTINCT geometry_id) AS n_geometries FROM (SELECT from_node AS node, 1 AS o, geometry_id FROM {ref_segments} UNION ALL SELECT to_node, 0, geometry_id FROM {ref_segments}) GROUP BY node""",
    "vertices": """SELECT line_id, pt_idx, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM {curves} WINDOW w AS (PARTITION BY line_id ORDER BY pt_idx)""",
    "steps": """SELECT *, CASE WHEN px IS NULL THEN 0 ELSE 2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(y - py) / 2), 2) + cos(radians(py)) * cos(radians(y)) * pow(sin(radians(x - px) / 2), 2)))) END AS km FROM {vertices}""",
    "lens": """SELECT line_id, COUNT(*) AS n_points, SUM(km) AS length_km FROM {steps} GROUP BY line_id""",
    "ends": """SELECT line_id, arg_min(x, pt_idx) AS x1, arg_min(y, pt_idx) AS y1, arg_max(x, pt_idx) AS x2, arg_max(y, pt_idx) AS y2 FROM {curves} GROUP BY line_id""",
}
LIB["chord_points"] = "SELECT * FROM {ref_points} WHERE pt_idx <> 1"
for _name, _points in (("ref", "ref_points"), ("agency", "agency_points"), ("path", "merged"), ("chord", "chord_points"), ("carriageway", "carriageway_points"), ("oneway", "oneway_points"), ("chain", "chain_merged")):
    LIB[f"{_name}_vertices"] = LIB["vertices"].replace("{curves}", "{" + _points + "}")
    LIB[f"{_name}_steps"] = LIB["steps"].replace("{vertices}", "{" + _name + "_vertices}")
    LIB[f"{_name}_segments"] = "SELECT line_id, pt_idx, px AS x1, py AS y1, x AS x2, y AS y2, SUM(km) OVER o - km AS from_km, km FROM {" + _name + "_steps} WINDOW o AS (PARTITION BY line_id ORDER BY pt_idx) QUALIFY px IS NOT NULL"
LIB["first_hull"] = LIB["hull"].replace("{claims}", "{first_claims}")
LIB["first_consolidated"] = LIB["consolidated"].replace("{hull}", "{first_hull}")
LIB["map_parts"] = LIB["parts"].replace("{points}", "{cut_points}")


def km(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians({y2} - {y1}) / 2), 2) + cos(radians({y1})) * cos(radians({y2})) * pow(sin(radians({x2} - {x1}) / 2), 2))))"


def deg(x1: str, y1: str, x2: str, y2: str) -> str:
    d = f"radians({x2} - {x1})"
    return f"degrees(atan2(sin({d}) * cos(radians({y2})), cos(radians({y1})) * sin(radians({y2})) - sin(radians({y1})) * cos(radians({y2})) * cos({d})))"


def labels(edges: str, rounds: int) -> str:
    """Components by spreading the least label, unrolled: l0 to l<rounds> (u, c). Without the leading CTEs' comma after."""
    parts = [f", e AS MATERIALIZED (SELECT u, v FROM ({edges}) UNION SELECT v, u FROM ({edges}))", "l0 AS MATERIALIZED (SELECT u, least(u, MIN(v)) AS c FROM e GROUP BY u)"]
    parts += [f"l{k + 1} AS MATERIALIZED (SELECT e.u, least(any_value(a.c), MIN(b.c)) AS c FROM e JOIN l{k} a ON a.u = e.u JOIN l{k} b ON b.u = e.v GROUP BY e.u)" for k in range(rounds)]
    return ", ".join(parts)


def relaxed(edges: str, sources: str, rounds: int) -> str:
    """Least distances (grp, source, node, dist) by relaxing all edges, unrolled: r0 to r<rounds>."""
    parts = [f"g AS MATERIALIZED (SELECT grp, from_node, to_node, MIN(w) AS w FROM ({edges}) GROUP BY ALL)", f"r0 AS MATERIALIZED (SELECT grp, source, source AS node, 0::DOUBLE AS dist FROM ({sources}))"]
    parts += [f"r{k + 1} AS MATERIALIZED (SELECT grp, source, node, MIN(dist) AS dist FROM (FROM r{k} UNION ALL SELECT r.grp, source, to_node, ROUND(dist + w, 9) FROM r{k} r JOIN g ON g.grp = r.grp AND g.from_node = r.node) GROUP BY ALL)" for k in range(rounds)]
    return ", ".join(parts)


def at_distance(wanted: str, steps: str, keys: str = "") -> str:
    """found: the points at d_km along lines; ``steps`` has each vertex with the way to it from the last one."""
    return (
        f"ways AS MATERIALIZED (SELECT line_id, pt_idx, px AS x1, py AS y1, x AS x2, y AS y2, SUM(km) OVER o - km AS from_km, SUM(km) OVER o AS to_km, SUM(km) OVER (PARTITION BY line_id) AS total FROM {steps} WINDOW o AS (PARTITION BY line_id ORDER BY pt_idx)), "
        f"found AS MATERIALIZED (SELECT {keys}line_id, d_km, x1 + f * (x2 - x1) AS x, y1 + f * (y2 - y1) AS y FROM (SELECT *, COALESCE((greatest(0, least(d_km, total)) - from_km) / NULLIF(to_km - from_km, 0), 0) AS f FROM ({wanted}) JOIN ways USING (line_id) WHERE x1 IS NOT NULL AND greatest(0, least(d_km, total)) >= from_km AND (greatest(0, least(d_km, total)) < to_km OR (d_km >= to_km AND to_km >= total - 1e-12)) QUALIFY row_number() OVER (PARTITION BY {keys}line_id, d_km ORDER BY pt_idx) = 1))"
    )


#: Where on the segment (x1, y1, x2, y2) the point (px, py) snaps, and how far that is.
ALONG = "greatest(0, least(1, COALESCE(((px - x1) * (x2 - x1) * pow(cos(radians(py)), 2) + (py - y1) * (y2 - y1)) / NULLIF(pow((x2 - x1) * cos(radians(py)), 2) + pow(y2 - y1, 2), 0), 0)))"
NEAREST = km("px", "py", "(x1 + t * (x2 - x1))", "(y1 + t * (y2 - y1))")

TURN = deg("px", "py", "x", "y"), deg("x", "y", "nx", "ny")
DIRECTION = """CASE WHEN len(list_filter(d, lambda x: x NOT IN (1, 3, 5, 7))) > 0 THEN NULL WHEN len(d) = 1 THEN d[1]
  WHEN len(d) > 2 OR len(d) = 0 THEN CASE WHEN w BETWEEN -45 AND 45 THEN 1 WHEN w > 45 AND w < 135 THEN 3 WHEN w <= -135 OR w >= 135 THEN 5 ELSE 7 END
  WHEN d = [1, 5] THEN CASE WHEN ABS(b) <= 90 THEN 1 ELSE 5 END WHEN d = [3, 7] THEN CASE WHEN b >= 0 THEN 3 ELSE 7 END END"""

LIB["merged"] = """SELECT path_id AS line_id, row_number() OVER (PARTITION BY path_id ORDER BY path_edge_idx, pt_idx) - 1 AS pt_idx, x, y FROM (SELECT path_id, path_edge_idx, pt_idx, x, y, lag(x) OVER w AS bx, lag(y) OVER w AS before_y FROM {agency_edges} JOIN {agency_points} ON edge_id = line_id WINDOW w AS (PARTITION BY path_id ORDER BY path_edge_idx, pt_idx)) WHERE bx IS NULL OR bx <> x OR before_y <> y"""
LIB["samples"] = f"""SELECT line_id, i, x1 + f * (x2 - x1) AS px, y1 + f * (y2 - y1) AS py FROM (SELECT line_id, i, x1, y1, x2, y2, COALESCE((d - from_km) / NULLIF(km, 0), 0) AS f FROM (SELECT s.*, i, total * i / 10 AS d, total FROM {{agency_segments}} s JOIN (SELECT line_id, SUM(km) AS total FROM {{agency_segments}} GROUP BY line_id) USING (line_id) CROSS JOIN (SELECT unnest(range(11)) AS i)) WHERE d >= from_km AND d <= from_km + km + 1e-12 QUALIFY row_number() OVER (PARTITION BY line_id, i ORDER BY pt_idx DESC) = 1)"""
LIB["hits"] = f"""SELECT edge_id, ref_id, i, d, spot FROM (SELECT p.line_id AS edge_id, s.line_id AS ref_id, i, from_km, km, {ALONG} AS t, px, py, x1, y1, x2, y2, {NEAREST.replace("t *", ALONG + " *")} AS d, from_km + {ALONG} * km AS spot FROM {{samples}} p JOIN {{ref_segments_lines}} s ON ABS(px - (x1 + x2) / 2) < 0.02 AND ABS(py - (y1 + y2) / 2) < 0.02) QUALIFY row_number() OVER (PARTITION BY edge_id, ref_id, i ORDER BY ROUND(d, 9), ROUND(spot, 9)) = 1"""
LIB["ref_segments_lines"] = LIB.pop("ref_segments")
LIB["matched"] = """SELECT edge_id, ref_id, CASE WHEN arg_min(spot, i) <= arg_max(spot, i) THEN 1 ELSE 0 END AS is_forward, MIN(spot) AS section_start, MAX(spot) AS section_end, AVG(d) AS score_km FROM {hits} WHERE d <= 0.03 GROUP BY edge_id, ref_id HAVING COUNT(*) >= 5.5 AND MAX(spot) > MIN(spot)"""
LIB["path_refs"] = "SELECT DISTINCT path_id, ref_id FROM {agency_edges} JOIN {matched} USING (edge_id) WHERE is_forward = 1"


def close_lines(a: str, b: str, limit: float) -> str:
    """(a_id, b_id, d): lines with a vertex of either within so many km of the other."""
    def one(points: str, segments: str, ids: str) -> str:
        return f"SELECT {ids}, MIN({NEAREST}) AS d FROM (SELECT p.line_id AS pid, s.line_id AS sid, p.x AS px, p.y AS py, x1, y1, x2, y2, {ALONG.replace('px', 'p.x').replace('py', 'p.y')} AS t FROM {{{points}}} p JOIN {{{segments}}} s ON ABS(p.x - (x1 + x2) / 2) < 0.02 AND ABS(p.y - (y1 + y2) / 2) < 0.02) GROUP BY ALL"
    return f"SELECT a_id, b_id, MIN(d) AS d FROM ({one(a[0], b[1], 'pid AS a_id, sid AS b_id')} UNION ALL {one(b[0], a[1], 'sid AS a_id, pid AS b_id')}) GROUP BY a_id, b_id HAVING MIN(d) <= {limit}"


LIB["overlaps_20m"] = close_lines(("agency_points", "agency_segments"), ("ref_points", "ref_segments_lines"), 0.02)
LIB["around"] = close_lines(("merged", "path_segments"), ("ref_points", "ref_segments_lines"), 0.05)
LIB["vicinity"] = "SELECT DISTINCT path_id, ref_id, road_class < 8 AS is_vehicle FROM (SELECT path_id, geometry_id FROM (SELECT a_id AS path_id, b_id AS ref_id FROM {around} UNION SELECT path_id, ref_id FROM {path_refs}) JOIN {ref_segments} USING (ref_id)) JOIN {ref_segments} USING (geometry_id)"
LIB["oneway_samples"] = LIB["samples"].replace("{agency_segments}", "{oneway_segments}")
LIB["oneway_hits"] = LIB["hits"].replace("{samples}", "{oneway_samples}").replace("{ref_segments_lines}", "{oneway_segments}")
LIB["oneway_tips"] = "SELECT line_id, arg_min(x, pt_idx) AS x1, arg_min(y, pt_idx) AS y1, arg_max(x, pt_idx) AS x2, arg_max(y, pt_idx) AS y2 FROM {oneway_points} GROUP BY line_id"
LIB["pairs"] = """SELECT edge_id AS ref_id, ref_id AS pair_id FROM (SELECT edge_id, ref_id FROM {oneway_hits} WHERE d <= 0.25 AND edge_id <> ref_id GROUP BY edge_id, ref_id HAVING COUNT(*) >= 5.5 AND MAX(spot) > MIN(spot) AND arg_min(spot, i) > arg_max(spot, i)) JOIN {oneway_tips} a ON a.line_id = edge_id JOIN {oneway_tips} b ON b.line_id = ref_id
  WHERE (a.x2 - a.x1) * ((b.y1 + b.y2) / 2 - a.y1) - (a.y2 - a.y1) * ((b.x1 + b.x2) / 2 - a.x1) > 0"""
LIB["around_ways"] = close_lines(("merged", "path_segments"), ("carriageway_points", "carriageway_segments"), 0.05)
LIB["way_vicinity"] = LIB["vicinity"].replace("{around}", "{around_ways}").replace("{ref_segments}", "{carriageways}")
LIB["paired_vicinity"] = "SELECT path_id, ref_id, is_vehicle FROM {way_vicinity} UNION SELECT path_id, pair_id, c.road_class < 8 FROM {way_vicinity} v JOIN {pairs} USING (ref_id) JOIN {carriageways} c ON c.ref_id = pair_id WHERE path_id IN (SELECT path_id FROM {two_way_paths})"
LIB["beside_paths"] = close_lines(("merged", "path_segments"), ("agency_points", "agency_segments"), 0.05)
LIB["beside_refs"] = close_lines(("ref_points", "ref_segments_lines"), ("agency_points", "agency_segments"), 0.05)
LIB["nearby"] = "SELECT path_id, edge_id FROM (SELECT a_id AS path_id, b_id AS edge_id FROM {beside_paths} UNION SELECT path_id, b_id FROM {path_refs} JOIN {beside_refs} ON ref_id = a_id) ANTI JOIN {agency_edges} USING (path_id, edge_id)"
LIB["beside_chain"] = "SELECT c.* FROM {street_chains} c JOIN {ref_segments} USING (ref_id) WHERE chain_id LIKE '%-a'"
LIB["chain_merged"] = "SELECT chain_id AS line_id, row_number() OVER (PARTITION BY chain_id ORDER BY chain_idx, pt_idx) - 1 AS pt_idx, x, y FROM (SELECT chain_id, chain_idx, pt_idx, x, y, lag(x) OVER w AS bx, lag(y) OVER w AS before_y FROM {beside_chain} JOIN {ref_points} ON ref_id = line_id WINDOW w AS (PARTITION BY chain_id ORDER BY chain_idx, pt_idx)) WHERE bx IS NULL OR bx <> x OR before_y <> y"


def on_chain(points: str, keys: str) -> str:
    """({keys}, chain_id, d, spot): where points (chain_id, px, py) snap to their chain's line."""
    return f"SELECT * EXCLUDE (t, from_km, km, x1, y1, x2, y2, px, py), from_km + t * km AS spot, {NEAREST} AS d FROM (SELECT p.*, x1, y1, x2, y2, from_km, km, {ALONG} AS t FROM ({points}) p JOIN {{chain_segments}} s ON s.line_id = chain_id) QUALIFY row_number() OVER (PARTITION BY {keys}, chain_id ORDER BY ROUND(d, 9), ROUND(spot, 9)) = 1"


LIB["path_tips"] = "SELECT line_id, line_id || '-a' AS chain_id, e, CASE e WHEN 0 THEN arg_min(x, pt_idx) ELSE arg_max(x, pt_idx) END AS px, CASE e WHEN 0 THEN arg_min(y, pt_idx) ELSE arg_max(y, pt_idx) END AS py FROM {merged} CROSS JOIN (SELECT unnest([0, 1]) AS e) GROUP BY line_id, e"
LIB["tips_on_chain"] = on_chain("SELECT * FROM {path_tips}", "line_id, e")
LIB["edges_on_chain"] = on_chain("SELECT path_id, path_edge_idx, path_id || '-a' AS chain_id, pt_idx // 2 AS e, x AS px, y AS py FROM {agency_edges} JOIN {agency_points} ON edge_id = line_id WHERE pt_idx <> 1", "path_id, path_edge_idx, e")
LIB["chain_places"] = "SELECT chain_id, chain_idx, ref_id, ROUND(to_km, 9) AS ref_to, ROUND(ROUND(to_km, 9) - km, 9) AS ref_from FROM (SELECT *, SUM(km) OVER (PARTITION BY chain_id ORDER BY chain_idx) AS to_km FROM {beside_chain} JOIN (SELECT line_id AS ref_id, SUM(km) AS km FROM {ref_segments_lines} GROUP BY line_id) USING (ref_id))"
LIB["chain_cuts"] = """SELECT path_id, path_edge_idx, ref_id, MIN(greatest(a, ref_from)) AS since, MIN(ROUND(greatest(a, ref_from) - ref_from, 9)) AS section_start, MAX(ROUND(least(z, ref_to) - ref_from, 9)) AS section_end
  FROM (SELECT path_id, path_edge_idx, chain_id, MAX(spot) FILTER (e = 0) AS a, MAX(spot) FILTER (e = 1) AS z FROM {edges_on_chain} GROUP BY ALL) JOIN {chain_places} USING (chain_id) WHERE a < z AND a < ref_to AND ref_from < z GROUP BY ALL"""
LIB["far_points"] = "SELECT path_id, ref_id, i, x1 + f * (x2 - x1) AS px, y1 + f * (y2 - y1) AS py FROM (SELECT path_id, ref_id, i, x1, y1, x2, y2, COALESCE((d - from_km) / NULLIF(km, 0), 0) AS f FROM (SELECT path_id, ref_id, i, s.*, total * i / 10 AS d FROM {vicinity} JOIN {ref_segments_lines} s ON s.line_id = ref_id JOIN (SELECT line_id, SUM(km) AS total FROM {ref_segments_lines} GROUP BY line_id) USING (line_id) CROSS JOIN (SELECT unnest(range(11)) AS i)) WHERE d >= from_km AND d <= from_km + km + 1e-12 QUALIFY row_number() OVER (PARTITION BY path_id, ref_id, i ORDER BY pt_idx DESC) = 1)"
LIB["far"] = f"SELECT path_id, ref_id, AVG(d) AS avg_km FROM (SELECT path_id, ref_id, i, MIN({NEAREST}) AS d FROM (SELECT p.*, x1, y1, x2, y2, {ALONG} AS t FROM {{far_points}} p JOIN {{path_segments}} s ON s.line_id = path_id) GROUP BY ALL) GROUP BY ALL"
LIB["weights"] = "SELECT path_id, ref_id, from_node, to_node, road_class, ROUND(ROUND(CASE WHEN (path_id, geometry_id) IN (SELECT (path_id, geometry_id) FROM {path_refs} JOIN {ref_segments} USING (ref_id)) THEN length_km * 0.1::DOUBLE WHEN avg_km > 0.2 THEN length_km * 2 ELSE length_km * (1 + avg_km / 0.4::DOUBLE) END, 9) + 1e-9, 4) AS weight FROM {vicinity} JOIN {far} USING (path_id, ref_id) JOIN {ref_segments} r USING (ref_id)"
LIB["path_ends"] = LIB["ends"].replace("{curves}", "{merged}")
LIB["near_ends"] = f"SELECT path_id, node, row_number() OVER (PARTITION BY path_id ORDER BY ROUND({km('x', 'y', 'x1', 'y1')}, 9), node) AS s, row_number() OVER (PARTITION BY path_id ORDER BY ROUND({km('x', 'y', 'x2', 'y2')}, 9), node) AS e FROM (SELECT DISTINCT path_id, unnest([from_node, to_node]) AS node FROM {{weights}}) JOIN {{crossings}} ON node = node_id JOIN {{path_ends}} ON line_id = path_id"
LIB["od"] = "SELECT DISTINCT a.path_id, a.node AS source, b.node AS sink FROM {near_ends} a JOIN {near_ends} b ON a.path_id = b.path_id WHERE a.s <= 10 AND b.e <= 10 AND a.node <> b.node"

#: name: (tables and definitions it reads, statement)
#: The pieces with each map's attached claim, found once a piece before the join.
ATTACHED = "SELECT * FROM map_parts LEFT JOIN (SELECT ref_id, part_idx, " + ", ".join(f"MAX(CASE WHEN map = '{m}' THEN {c} END) AS {m}_{c}" for m in ("tmc", "ris") for c in ("edge_id", "is_forward", "section_start", "section_end")) + " FROM attached WHERE rn = 1 GROUP BY ref_id, part_idx) USING (ref_id, part_idx)"

SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "dispute_claimants": (("disputed",), "SELECT * FROM disputed"),
    "dispute_extents": (("disputed",), "SELECT ref_id, MIN(section_start) AS disputed_start, MAX(section_end) AS disputed_end, COUNT(*) AS n_claims FROM disputed GROUP BY ref_id"),
    "undisputed_claims": (("undisputed",), "SELECT * FROM undisputed"),
    "consolidated_sections": (("consolidated",), "SELECT * FROM consolidated"),
    "consolidated_sections_strict": (("pieces_strict",), """SELECT a.* FROM pieces_strict a WHERE NOT EXISTS (SELECT 1 FROM pieces_strict b WHERE a.ref_id = b.ref_id AND a.edge_id = b.edge_id AND a.section_start < b.section_end AND b.section_start < a.section_end
      AND (-ROUND(b.section_end - b.section_start, 9), b.section_start, b.section_end, -b.is_forward) < (-ROUND(a.section_end - a.section_start, 9), a.section_start, a.section_end, -a.is_forward))"""),
    "clamped_sections": (("edge_candidates", "ref_segments"), "SELECT edge_id, ref_id, ROUND(greatest(section_start - 0.1::DOUBLE, 0), 4) AS section_start, ROUND(least(section_end + 0.1::DOUBLE, length_km), 4) AS section_end FROM edge_candidates JOIN ref_segments USING (ref_id) WHERE ROUND(least(section_end + 0.1::DOUBLE, length_km) - greatest(section_start - 0.1::DOUBLE, 0), 9) > 0.0001"),
    "section_partitions": (("parts",), "SELECT ref_id, part_idx, part_start, part_end FROM parts"),
    "conflation_segments": (("attached",), ATTACHED),
    "conflation_checks": (("attached", "ref_segments"), "SELECT failed, COUNT(*) AS n FROM (SELECT unnest([CASE WHEN NOT (s < e) THEN 'order' END, CASE WHEN NOT (s >= 0 AND e <= length_km) THEN 'within' END, CASE WHEN NOT (tmc_section_start < e AND s < tmc_section_end) THEN 'tmc' END, CASE WHEN NOT (ris_section_start < e AND s < ris_section_end) THEN 'ris' END]) AS failed FROM "
      f"(SELECT *, CASE WHEN ref_id % 50 < 2 THEN part_start + 2 ELSE part_start END AS s, CASE WHEN ref_id % 50 IN (1, 2) THEN part_end + 2 ELSE part_end END AS e FROM ({ATTACHED}) JOIN ref_segments USING (ref_id))) WHERE failed IS NOT NULL GROUP BY failed"),
    "conflation_mapping": (("attached",), "SELECT ref_id, part_idx, edge_id FROM attached WHERE rn = 1 AND map = 'tmc'"),
    "overlap_pairs": (("consolidated",), ", s AS (SELECT DISTINCT ref_id, edge_id, section_start, section_end FROM consolidated) SELECT a.*, b.edge_id AS b_edge_id, b.section_start AS b_section_start, b.section_end AS b_section_end FROM s a JOIN s b ON a.ref_id = b.ref_id AND a.section_start < b.section_end AND b.section_start < a.section_end WHERE a.edge_id < b.edge_id"),
    "candidates_without_claim": (("edge_candidates", "consolidated"), "SELECT * FROM edge_candidates a WHERE NOT EXISTS (SELECT 1 FROM consolidated b WHERE a.ref_id = b.ref_id AND a.section_start < b.section_end AND b.section_start < a.section_end)"),
    "epsilon_overlaps": (("consolidated",), """, close AS (SELECT a.ref_id, a.edge_id, a.is_forward, a.section_start, a.section_end, b.edge_id AS e2, b.is_forward AS f2, b.section_start AS s2, b.section_end AS t2, ROUND((a.section_end + b.section_start) / 2, 5) AS mid FROM consolidated a JOIN consolidated b ON a.ref_id = b.ref_id AND a.edge_id <> b.edge_id AND a.section_start < b.section_start AND b.section_start < a.section_end AND a.section_end < b.section_end WHERE ROUND(a.section_end - b.section_start, 9) <= 0.005)
      SELECT ref_id, edge_id, is_forward, section_start, section_end, COALESCE(MAX(ns), section_start) AS new_start, COALESCE(MIN(ne), section_end) AS new_end FROM (SELECT ref_id, edge_id, is_forward, section_start, section_end, NULL::DOUBLE AS ns, mid AS ne FROM close UNION ALL SELECT ref_id, e2, f2, s2, t2, mid, NULL::DOUBLE FROM close) GROUP BY ref_id, edge_id, is_forward, section_start, section_end"""),
    "reverse_sections": (("reverse",), "SELECT * FROM reverse"),
    "path_last_edge": (("last_idx",), "SELECT * FROM last_idx"),
    "path_edge_stats": (("stats",), "SELECT * EXCLUDE (is_unidirectional) FROM stats"),
    "preferred_direction": (("preferred",), "SELECT * FROM preferred"),
    "trimmability": (("trim",), "SELECT * FROM trim"),
    "dispute_parties": (("disputed",), "SELECT ref_id, COUNT(DISTINCT (path_id, is_forward)) AS n_parties FROM disputed GROUP BY ref_id"),
    "settle_first_step": (("disputed",), """SELECT a.*, p.n = 1 OR NOT EXISTS (SELECT 1 FROM disputed b WHERE a.ref_id = b.ref_id AND a.edge_id <> b.edge_id AND a.section_start < b.section_end AND b.section_start < a.section_end) AS won
      FROM disputed a JOIN (SELECT ref_id, COUNT(DISTINCT (path_id, is_forward)) AS n FROM disputed GROUP BY ref_id) p USING (ref_id)"""),
    "rule_multi_path": (("disputed", "suspects", "losers"), "SELECT * FROM disputed d WHERE (path_id, edge_id) NOT IN (SELECT (c.path_id, c.edge_id) FROM claims c JOIN suspects s ON c.edge_id = s.edge_id AND c.ref_id = s.ref_id) AND (path_id, edge_id, ref_id) NOT IN (SELECT (path_id, edge_id, ref_id) FROM losers)"),
    "knaves_multi_path": (("claims", "suspects", "losers"), "SELECT DISTINCT ref_id, edge_id, is_forward, section_start, section_end FROM claims WHERE (edge_id, ref_id) IN (SELECT (edge_id, ref_id) FROM suspects) OR (edge_id, ref_id) IN (SELECT (edge_id, ref_id) FROM losers)"),
    "rule_same_edge": (("disputed",), "SELECT * FROM disputed QUALIFY row_number() OVER (PARTITION BY ref_id, edge_id ORDER BY path_edge_idx, path_id, is_forward DESC, match_idx) = 1"),
    "rule_unidirectional": (("disputed", "preferred"), "SELECT * FROM disputed WHERE (path_id, edge_id, is_forward) NOT IN (SELECT (path_id, edge_id, CASE WHEN forward_preferred THEN 0 ELSE 1 END) FROM preferred WHERE deviance_sufficient AND distance_sufficient AND forward_preferred IS NOT NULL)"),
    "rule_trimmable": (("disputed", "trim"), """, marked AS (SELECT d.*, start_trimmable, end_trimmable FROM disputed d JOIN trim USING (path_id, path_edge_idx, is_forward, match_idx)),
      sole AS (SELECT ref_id, path_id FROM marked WHERE start_trimmable = 0 AND end_trimmable = 0 GROUP BY ref_id, path_id HAVING COUNT(DISTINCT is_forward) = 1 QUALIFY COUNT(*) OVER (PARTITION BY ref_id) = 1),
      kept AS (SELECT * FROM disputed d WHERE NOT EXISTS (SELECT 1 FROM sole s WHERE s.ref_id = d.ref_id AND s.path_id <> d.path_id)),
      again AS (SELECT m.* FROM marked m SEMI JOIN kept USING (path_id, path_edge_idx, edge_id, is_forward, match_idx, ref_id)),
      beaten AS (SELECT DISTINCT a.ref_id, a.path_id, a.path_edge_idx, a.edge_id FROM again a JOIN again b ON a.ref_id = b.ref_id AND a.start_trimmable = 1 AND a.end_trimmable = 1 AND b.start_trimmable = 0 AND b.end_trimmable = 0 AND a.section_start < b.section_end AND b.section_start < a.section_end)
      SELECT * FROM kept ANTI JOIN beaten USING (ref_id, path_id, path_edge_idx, edge_id)"""),
    "rule_epsilon": (("disputed",), """SELECT * FROM disputed WHERE (ref_id, path_id) NOT IN (SELECT (ref_id, path_id) FROM disputed JOIN (SELECT ref_id, MAX(ROUND(section_end - section_start, 4)) AS longest FROM disputed GROUP BY ref_id) USING (ref_id) WHERE ROUND(section_end - section_start, 4) < ROUND(longest * 0.1::DOUBLE, 6))"""),
    "rule_reverse_assigned": (("disputed", "reverse_disputed"), "SELECT d.* FROM disputed d LEFT JOIN (SELECT ref_id, MIN(edge_id) AS winner FROM reverse_disputed GROUP BY ref_id HAVING COUNT(*) = 1) USING (ref_id) WHERE winner IS NULL OR winner = edge_id"),
    "path_class_share": (("consolidated", "path_edges", "ref_segments"), "SELECT path_id, road_class, class_km, path_km, ROUND(class_km / path_km + 1e-9, 4) AS class_share FROM (SELECT *, ROUND(SUM(class_km) OVER (PARTITION BY path_id), 4) AS path_km FROM (SELECT path_id, road_class, ROUND(SUM(ROUND(section_end - section_start, 4)), 4) AS class_km FROM (SELECT DISTINCT path_id, edge_id FROM path_edges) JOIN consolidated USING (edge_id) JOIN ref_segments r USING (ref_id) GROUP BY path_id, road_class))"),
    "backfill_candidates": (("first_claims", "edge_candidates"), "SELECT * FROM edge_candidates a WHERE edge_id NOT IN (SELECT edge_id FROM first_round) AND ROUND(section_end - section_start, 4) > 0.003 AND NOT EXISTS (SELECT 1 FROM first_claims b WHERE a.ref_id = b.ref_id AND a.section_start < b.section_end AND b.section_start < a.section_end)"),
    "dispute_report": (("disputed", "trim"), "SELECT ref_id, MIN(section_start) AS disputed_start, MAX(section_end) AS disputed_end, string_agg(path_id || ':' || path_edge_idx || ':' || edge_id || ':' || is_forward || ':' || match_idx || ':' || COALESCE(start_trimmable::VARCHAR, '-') || ':' || COALESCE(end_trimmable::VARCHAR, '-'), ',' ORDER BY section_start, section_end, path_id, path_edge_idx, edge_id, is_forward, match_idx) AS claimants FROM disputed LEFT JOIN trim USING (path_id, path_edge_idx, is_forward, match_idx) GROUP BY ref_id"),
    "assignment_metrics": (("metrics",), "SELECT * FROM metrics"),
    "matching_stats": (("matching",), "SELECT * FROM matching"),
    "assignment_summary": (("matching",), "SELECT COUNT(*) AS n_edges, COUNT(worst_diff) AS n_matched, " + ", ".join(f"ROUND(COUNT(*) FILTER ({c}) / NULLIF(COUNT(worst_diff), 0) + 1e-9, 5) AS share_{c}" for c in ("under_5m", "from_5_to_10m", "from_10_to_100m", "over_100m")) + " FROM matching"),
    "path_coverage": (("path_edges", "first_consolidated"), "SELECT path_id, COUNT(DISTINCT edge_id) AS n_edges, COUNT(DISTINCT edge_id) FILTER (edge_id IN (SELECT edge_id FROM first_consolidated)) AS n_assigned FROM path_edges GROUP BY path_id"),
    "qa_lengths": (("edges", "consolidated"), "SELECT target_map_id, ROUND(edge_length_km, 6) AS edge_km, forward_km, backward_km, COALESCE(n, 0) AS n_segments FROM edges LEFT JOIN (SELECT edge_id, ROUND(SUM(CASE WHEN is_forward = 1 THEN section_end - section_start END) + 1e-9, 6) AS forward_km, ROUND(SUM(CASE WHEN is_forward = 0 THEN section_end - section_start END) + 1e-9, 6) AS backward_km, COUNT(*) AS n FROM consolidated GROUP BY edge_id) USING (edge_id) WHERE is_primary = 1"),
    "match_acceptance": (("chosen_matches", "edges"), "SELECT is_forward, COUNT(*) AS n, COUNT(*) FILTER (ROUND(ABS(km - edge_length_km) + 1e-9, 4) <= ROUND(edge_length_km * 0.2::DOUBLE + 1e-9, 4)) AS n_accepted FROM (SELECT path_id, edge_id, is_forward, ROUND(SUM(section_end - section_start) + 1e-9, 4) AS km FROM chosen_matches GROUP BY ALL) JOIN edges USING (edge_id) GROUP BY is_forward"),
    "multi_path_edges": (("shared",), "SELECT * FROM shared"),
    "unmatched_edges": (("edges", "first_consolidated"), "SELECT edge_id, unmatched_share FROM (SELECT edge_id, ROUND((edge_length_km - COALESCE(km, 0)) / edge_length_km + 1e-9, 4) AS unmatched_share FROM edges LEFT JOIN (SELECT edge_id, SUM(section_end - section_start) AS km FROM first_consolidated GROUP BY edge_id) USING (edge_id)) WHERE unmatched_share >= 0.1"),
    "indexed_matches": (("edge_candidates",), "SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY section_start, ref_id, section_end) - 1 AS match_idx FROM edge_candidates"),
    "list_unmatched": (("edges", "first_consolidated"), "SELECT edge_id, target_map_id FROM edges WHERE edge_id NOT IN (SELECT edge_id FROM first_consolidated)"),
    "matches_by_edge": (("edge_candidates",), "SELECT edge_id, string_agg(ref_id, ',' ORDER BY section_start, section_end, ref_id) AS refs, ROUND(SUM(section_end - section_start), 4) AS km FROM edge_candidates GROUP BY edge_id"),
    "rule_violations": (("consolidated",), "SELECT 'overlap' AS rule, * FROM consolidated a WHERE EXISTS (SELECT 1 FROM consolidated b WHERE a.ref_id = b.ref_id AND a.edge_id <> b.edge_id AND a.section_start < b.section_end AND b.section_start < a.section_end) UNION ALL SELECT 'no_length', * FROM consolidated WHERE section_start >= section_end UNION ALL SELECT 'repeated_key', * FROM consolidated QUALIFY COUNT(*) OVER (PARTITION BY ref_id, edge_id) > 1"),
    "check_chosen": (("chosen_matches",), "SELECT path_id, path_edge_idx, is_forward, ref_id, 'start' AS failed FROM chosen_matches WHERE section_start - 0.01::DOUBLE < 0 UNION ALL SELECT path_id, path_edge_idx, is_forward, ref_id, 'order' FROM chosen_matches WHERE section_start - 0.01::DOUBLE >= section_end UNION ALL SELECT path_id, path_edge_idx, is_forward, ref_id, 'deviance' FROM chosen_matches WHERE avg_deviance_km < 0"),
    "duplicate_metadata": (("ref_segments",), "SELECT geometry_id, COUNT(*) AS n, COUNT(DISTINCT (road_class, length_km)) > 1 AS disagree FROM ref_segments GROUP BY geometry_id HAVING COUNT(*) > 1"),
    "rejected_rows": (("edge_candidates",), "SELECT * FROM edge_candidates QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY section_start, edge_id) > 1"),
    "snapshot_diff": (("first_round", "later_round"), """, a AS (SELECT DISTINCT path_id, edge_id, ref_id, section_start FROM first_round), b AS (SELECT DISTINCT path_id, edge_id, ref_id, section_start FROM later_round)
      SELECT *, 'a-b' AS diff FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'b-a' FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT *, 'both' FROM (SELECT * FROM a INTERSECT SELECT * FROM b)"""),
    "osm_road_class": (("road_class",), "SELECT * FROM road_class"),
    "canonical_nodes": (("canonical",), "SELECT * FROM canonical"),
    "canonical_ways": (("canonical_seq",), "SELECT way_id, len(ids) AS n_nodes, ids[1] AS first_node, ids[-1] AS last_node, array_to_string(ids, ',') AS node_list FROM canonical_seq"),
    "equivalent_ways": (("canonical_seq",), "SELECT way_id, MIN(way_id) OVER (PARTITION BY ids) AS first_way_id FROM canonical_seq QUALIFY COUNT(*) OVER (PARTITION BY ids) > 1"),
    "way_sections": (("osm_nodes", "section_nodes"), """, met AS (SELECT a.way_id, b.ref_id, a.node_idx, b.node_idx AS ref_idx FROM osm_nodes a JOIN section_nodes b ON a.node_id = b.node_id),
      lanes AS (SELECT *, ref_idx - node_idx AS lane, 1 AS is_forward FROM met UNION ALL SELECT *, ref_idx + node_idx, 0 FROM met),
      numbered AS (SELECT *, node_idx - row_number() OVER (PARTITION BY way_id, ref_id, is_forward, lane ORDER BY node_idx) AS run FROM lanes),
      runs AS (SELECT way_id, ref_id, is_forward, COUNT(*) AS n_nodes, MIN(ref_idx) AS from_idx, MAX(ref_idx) AS to_idx FROM numbered GROUP BY way_id, ref_id, is_forward, lane, run HAVING COUNT(*) > 1)
      SELECT way_id, ref_id, is_forward, n_nodes, from_idx, to_idx FROM runs QUALIFY row_number() OVER (PARTITION BY way_id, ref_id ORDER BY n_nodes DESC, is_forward DESC, from_idx) = 1"""),
    "node_sequence_refs": (("osm_nodes", "section_nodes"), """, p AS (SELECT way_id, node_idx, node_id AS a, lead(node_id) OVER (PARTITION BY way_id ORDER BY node_idx) AS b FROM osm_nodes), q AS (SELECT ref_id, node_id AS a, lead(node_id) OVER (PARTITION BY ref_id ORDER BY node_idx) AS b FROM section_nodes)
      SELECT DISTINCT way_id AS seq_id, ref_id AS geometry_id, node_idx, 1 AS step FROM p JOIN q ON p.a = q.a AND p.b = q.b UNION SELECT way_id, ref_id, node_idx, -1 FROM p JOIN q ON p.a = q.b AND p.b = q.a"""),
    "feed_extent": (("extent",), "SELECT * FROM extent"),
    "feed_dates": (("dates",), "SELECT * FROM dates"),
    "service_dates": (("services",), "SELECT * FROM services"),
    "trip_services": (("trip_rows",), "SELECT * FROM trip_rows"),
    "trip_counts": (("runs",), "SELECT * FROM runs"),
    "trip_segments": (("on_segments",), "SELECT * FROM on_segments"),
    "bus_counts": (("bus",), "SELECT * FROM bus"),
    "bus_aadt": (("aadt",), "SELECT * FROM aadt"),
    "bus_aadt_by_segment": (("aadt",), "SELECT segment_id, COUNT(*) AS n_routes, " + ", ".join(f"ROUND(ROUND(SUM({p}) + 1e-9, 3), 2) AS total_{p}" for p in ("amp", "midd", "pmp", "we", "ovn")) + " FROM aadt GROUP BY segment_id"),
    "shapeless_trips": (("trips",), "SELECT COUNT(*) AS n_trips, COUNT(*) FILTER (shape_id IS NULL) AS n_shapeless FROM trips"),
    "gtfs_qa": (("trip_rows", "services", "times"), """SELECT 'duration' AS test, COUNT(*) AS n_failed FROM trip_rows WHERE minutes < 0 OR minutes > 1440
      UNION ALL SELECT 'trips_kept', COUNT(*) FROM (SELECT DISTINCT trip_id FROM trips WHERE trip_id IN (SELECT trip_id FROM times) AND service_id IN (SELECT service_id FROM services) EXCEPT SELECT trip_id FROM trip_rows)
      UNION ALL SELECT 'service_dates_unique', COUNT(*) FROM (SELECT service_id, date FROM services GROUP BY ALL HAVING COUNT(*) > 1)
      UNION ALL SELECT 'period_minutes', COUNT(*) FROM trip_rows WHERE start_minutes > minutes OR end_minutes > minutes"""),
    "latest_directions": (("station",), "SELECT rc_station, year, array_to_string(d, ',') AS directions FROM station"),
    "federal_direction": (("station",), ", turned AS (SELECT rc_station, r_regionkey, d, f, CASE WHEN f = 1 THEN r_regionkey * 80 - 160 WHEN r_regionkey * 80 - 160 <= 0 THEN r_regionkey * 80 + 20 ELSE r_regionkey * 80 - 340 END AS b FROM station CROSS JOIN region CROSS JOIN (SELECT unnest([0, 1]) AS f)), "
      f"whole AS (SELECT *, CASE WHEN b > 180 THEN b - 360 WHEN b < -180 THEN b + 360 ELSE b END AS w FROM turned), said AS (SELECT rc_station, r_regionkey, f, {DIRECTION} AS v FROM whole) SELECT rc_station, r_regionkey, MAX(v) FILTER (f = 0) AS direction_0, MAX(v) FILTER (f = 1) AS direction_1 FROM said GROUP BY ALL"),
    "ref_metadata": (("meta",), "SELECT * FROM meta"),
    "sources_sinks": (("oneways",), """, e AS (SELECT * FROM oneways), t AS (SELECT node, COUNT(*) FILTER (o = 0) AS n_in, COUNT(*) FILTER (o = 1) AS n_out, COUNT(DISTINCT geometry_id) AS g FROM (SELECT from_node AS node, 1 AS o, geometry_id FROM e UNION ALL SELECT to_node, 0, geometry_id FROM e) GROUP BY node),
      f AS (SELECT node, n_in = 0 OR (n_in > 0 AND n_out > 0 AND g = 1) AS is_source, n_out = 0 OR (n_in > 0 AND n_out > 0 AND g = 1) AS is_sink FROM t) SELECT * FROM f WHERE is_source OR is_sink"""),
    "forks": (("touching",), "SELECT node, n_geometries, n_in, n_out FROM touching WHERE n_geometries > 2 OR (n_geometries = 2 AND n_in <> n_out)"),
    "multi_edges": (("route_edges",), "SELECT from_node, to_node, COUNT(*) AS n_edges FROM route_edges GROUP BY ALL HAVING COUNT(*) > 1"),
    "intersection_layer": (("crossings", "oneways"), "SELECT node, c AS road_class, CASE WHEN c <= 4 THEN 'major' WHEN c <= 7 THEN 'local' ELSE 'paths' END AS layer, CASE WHEN c = 0 THEN NULL WHEN c <= 4 THEN 5 WHEN c <= 7 THEN 11 ELSE 14 END AS minzoom FROM (SELECT node, COALESCE(MIN(road_class), 6) AS c FROM (SELECT node_id AS node FROM crossings) LEFT JOIN (SELECT unnest([from_node, to_node]) AS node, road_class FROM oneways) USING (node) GROUP BY node)"),
    "route_paths_milepost": (("path_edges", "way_nodes", "nodes"), ", p AS (SELECT way_id, node_idx, lon, lat FROM way_nodes JOIN nodes USING (node_id) WHERE node_idx <= 1), e AS (SELECT path_id AS route_id, edge_id, path_edge_idx AS mp, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2 FROM path_edges JOIN p a ON edge_id = a.way_id AND a.node_idx = 0 JOIN p b ON edge_id = b.way_id AND b.node_idx = 1), "
      "g AS (SELECT *, lag(x2) OVER w AS px, lag(y2) OVER w AS py FROM e WINDOW w AS (PARTITION BY route_id ORDER BY mp, edge_id)), "
      f"n AS (SELECT *, SUM(CASE WHEN px IS NOT NULL AND {km('px', 'py', 'x1', 'y1')} > 6.0 THEN 1 ELSE 0 END) OVER (PARTITION BY route_id ORDER BY mp, edge_id ROWS UNBOUNDED PRECEDING) AS path_no FROM g) SELECT route_id, path_no, row_number() OVER (PARTITION BY route_id, path_no ORDER BY mp, edge_id) - 1 AS path_edge_idx, edge_id FROM n"),
    "reversed_paths": (("path_edges",), "SELECT path_id, MAX(path_edge_idx) OVER (PARTITION BY path_id) - path_edge_idx AS path_edge_idx, edge_id FROM path_edges"),
    "paths_through": (("path_edges", "edges"), "SELECT DISTINCT path_id FROM path_edges WHERE edge_id IN (SELECT edge_id FROM edges WHERE is_primary = 0)"),
    "line_lengths": (("lens",), "SELECT line_id, n_points, ROUND(length_km + 1e-9, 4) AS length_km FROM lens"),
    "bearings": (("ends",), f"SELECT line_id, CASE WHEN x1 = x2 AND y1 = y2 THEN NULL ELSE ROUND({deg('x1', 'y1', 'x2', 'y2')} + 1e-9, 4) END AS bearing FROM ends"),
    "split_by_bearing": (("vertices",), f"SELECT line_id, pt_idx, COALESCE(SUM(CASE WHEN least(ABS({TURN[1]} - {TURN[0]}), 360 - ABS({TURN[1]} - {TURN[0]})) > 67.5 THEN 1 ELSE 0 END) OVER (PARTITION BY line_id ORDER BY pt_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece FROM vertices"),
    "clean_vertices": (("curves",), ", r AS (SELECT line_id, pt_idx, ROUND(x, 1) + 0 AS x, ROUND(y, 1) + 0 AS y FROM curves), m AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM r WINDOW w AS (PARTITION BY line_id ORDER BY pt_idx)) SELECT line_id, row_number() OVER (PARTITION BY line_id ORDER BY pt_idx) - 1 AS pt_idx, x, y FROM m WHERE px IS NULL OR px <> x OR py <> y"),
    "nearest_on_line": (("vertices", "curves"), ", s AS (SELECT line_id, x AS x1, y AS y1, nx AS x2, ny AS y2 FROM vertices WHERE nx IS NOT NULL), p AS (SELECT line_id AS point_id, line_id + 1 AS line_id, x AS px, y AS py FROM curves WHERE pt_idx = 0), "
      "q AS (SELECT *, cos(radians(py)) AS k FROM p JOIN s USING (line_id)), t AS (SELECT *, greatest(0, least(1, COALESCE(((px - x1) * k * (x2 - x1) * k + (py - y1) * (y2 - y1)) / NULLIF((x2 - x1) * k * (x2 - x1) * k + (y2 - y1) * (y2 - y1), 0), 0))) AS t FROM q) "
      f"SELECT point_id, line_id, ROUND(MIN({km('px', 'py', '(x1 + t * (x2 - x1))', '(y1 + t * (y2 - y1))')}) + 1e-9, 5) AS dist_km FROM t GROUP BY ALL"),
    "sequentiality": (("ends", "lens"), f", e AS (SELECT * FROM ends JOIN lens USING (line_id)), j AS (SELECT a.line_id AS a_id, b.line_id AS b_id, a.length_km AS ak, b.length_km AS bk, {deg('b.x1', 'b.y1', 'b.x2', 'b.y2')} - {deg('a.x1', 'a.y1', 'a.x2', 'a.y2')} AS t, {km('a.x2', 'a.y2', 'b.x1', 'b.y1')} AS g, {deg('a.x2', 'a.y2', 'b.x1', 'b.y1')} AS gb FROM e a JOIN e b ON b.line_id = a.line_id + 1) "
      "SELECT a_id, b_id, ROUND(ak + 1e-9, 4) AS a_km, ROUND(bk + 1e-9, 4) AS b_km, ROUND(CASE WHEN t > 180 THEN t - 360 WHEN t < -180 THEN t + 360 ELSE t END + 1e-9, 4) AS turn, ROUND(g + 1e-9, 4) AS gap_km, ROUND(gb + 1e-9, 4) AS gap_bearing FROM j"),
    "curve_similarity": (("steps", "lens"), ", " + at_distance("SELECT line_id, i, length_km * i / 31 AS d_km FROM lens CROSS JOIN (SELECT unnest(range(32)) AS i)", "steps", "i, ")
      + ", flat AS (SELECT line_id, i, x * cos(radians(first_value(y) OVER w)) * radians(1) * 6371.0088 AS x, y * radians(1) * 6371.0088 AS y FROM found WINDOW w AS (PARTITION BY line_id ORDER BY i)), "
      + "mid AS (SELECT line_id, i, x - AVG(x) OVER w AS x, y - AVG(y) OVER w AS y FROM flat WINDOW w AS (PARTITION BY line_id)), "
      + "home AS MATERIALIZED (SELECT line_id, i, x / size AS x, y / size AS y FROM (SELECT *, sqrt(AVG(x * x + y * y) OVER (PARTITION BY line_id)) AS size FROM mid)), "
      + "way AS MATERIALIZED (SELECT line_id, SUM(sqrt(pow(x - bx, 2) + pow(y - before_y, 2))) AS way FROM (SELECT line_id, x, y, lag(x) OVER w AS bx, lag(y) OVER w AS before_y FROM home WINDOW w AS (PARTITION BY line_id ORDER BY i)) GROUP BY line_id), "
      + "fit AS (SELECT a.line_id AS a_id, greatest(-0.1 * pi(), least(0.1 * pi(), atan2(SUM(a.x * b.y - a.y * b.x), SUM(a.x * b.x + a.y * b.y)))) AS turn FROM home a JOIN home b ON b.line_id = a.line_id + 1 AND b.i = a.i GROUP BY a.line_id), "
      + "turns AS MATERIALIZED (SELECT a_id, 1 AS k, turn FROM fit UNION ALL SELECT a_id, 0, 0 FROM fit), "
      + "far AS MATERIALIZED (SELECT a_id * 2 + k AS a_id, a.i, b.i AS j, sqrt(pow(a.x * cos(turn) - a.y * sin(turn) - b.x, 2) + pow(a.x * sin(turn) + a.y * cos(turn) - b.y, 2)) AS d FROM turns JOIN home a ON a.line_id = a_id JOIN home b ON b.line_id = a_id + 1), "
      + ", ".join(f"v{k} AS MATERIALIZED (SELECT f.a_id, f.i, f.j, " + ("d" if k == 0 else f"greatest(d, least(COALESCE(u.v, 1e18), COALESCE(l.v, 1e18)" + (", COALESCE(g.v, 1e18)" if k > 1 else "") + "))") + " AS v FROM far f" + ("" if k == 0 else f" LEFT JOIN v{k - 1} u ON u.a_id = f.a_id AND u.i = f.i - 1 AND u.j = f.j LEFT JOIN v{k - 1} l ON l.a_id = f.a_id AND l.i = f.i AND l.j = f.j - 1" + (f" LEFT JOIN v{k - 2} g ON g.a_id = f.a_id AND g.i = f.i - 1 AND g.j = f.j - 1" if k > 1 else "")) + f" WHERE f.i + f.j = {k})" for k in range(63))
      + ", best AS (SELECT t.a_id, v, t.turn FROM v62 JOIN turns t ON v62.a_id = t.a_id * 2 + t.k QUALIFY row_number() OVER (PARTITION BY t.a_id ORDER BY v, t.turn) = 1)"
      + " SELECT best.a_id, best.a_id + 1 AS b_id, 32 AS n_points, ROUND(turn + 1e-9, 5) AS turn, ROUND(v + 1e-9, 5) AS frechet, ROUND(greatest(0, 1 - v * sqrt(2) / sqrt(a.way * b.way)) + 1e-9, 5) AS similarity FROM best JOIN way a ON a.line_id = best.a_id JOIN way b ON b.line_id = best.a_id + 1"),
    "nearest_nodes": (("nodes", "stations"), f"SELECT point_id, target_id, rank, ROUND(d + 1e-9, 5) AS dist_km FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY ROUND(d, 9), target_id) AS rank FROM (SELECT point_id, b.node_id AS target_id, {km('x', 'y', 'b.lon', 'b.lat')} AS d FROM stations CROSS JOIN nodes b)) WHERE rank <= 4"),
    "compact_layers": (("ref_segments", "edges"), "SELECT 'base' AS layer, CAST(COALESCE(road_class, 6) AS VARCHAR) AS code, COUNT(*) AS n FROM ref_segments GROUP BY ALL UNION ALL SELECT 'segments', target_map_id, COUNT(*) FROM edges GROUP BY ALL"),
    "component_sizes": (("way_nodes",), labels("SELECT DISTINCT way_id AS u, node_id + 1099511627776 AS v FROM way_nodes", 12) + " SELECT c AS component, COUNT(*) AS n FROM l12 GROUP BY c"),
    "graph_components": (("oneways",), labels("SELECT from_node AS u, to_node AS v FROM oneways", 40) + " SELECT u AS node, c AS component FROM l40"),
    "shortest_paths": (("ref_segments", "crossings"), ", " + relaxed("SELECT 0 AS grp, from_node, to_node, length_km AS w FROM ref_segments", "SELECT 0 AS grp, node_id AS source FROM crossings WHERE node_id % 100 = 0", 40) + " SELECT source, node, ROUND(dist, 4) AS dist FROM r40"),
    "points_along": (("steps",), ", " + at_distance("SELECT line_id, total / 2 AS d_km FROM (SELECT line_id, SUM(km) AS total FROM steps GROUP BY line_id)", "steps") + " SELECT line_id, ROUND(x + 1e-9, 5) AS x, ROUND(y + 1e-9, 5) AS y FROM found"),
    "merged_paths": (("merged",), "SELECT line_id, pt_idx, x, y FROM merged"),
    "match_edges": (("matched",), "SELECT edge_id, ref_id, ROUND(section_start + 1e-9, 4) AS section_start, ROUND(section_end + 1e-9, 4) AS section_end, ROUND(score_km + 1e-9, 4) AS score_km FROM matched WHERE is_forward = 1"),
    "match_centerlines": (("matched",), "SELECT edge_id, ref_id, is_forward FROM matched"),
    "unmatched_by_line": (("matched", "agency_steps"), "SELECT line_id AS edge_id, ROUND((total - COALESCE(km, 0)) / total + 1e-9, 4) AS unmatched_share FROM (SELECT line_id, SUM(km) AS total FROM agency_steps GROUP BY line_id) LEFT JOIN (SELECT edge_id AS line_id, SUM(section_end - section_start) AS km FROM matched WHERE is_forward = 1 AND section_end - section_start < 0.9 GROUP BY edge_id) USING (line_id) WHERE ROUND((total - COALESCE(km, 0)) / total + 1e-9, 4) >= 0.1"),
    "merged_matches": (("matched",), "SELECT edge_id, ref_id, 1 - MAX(is_forward) AS round FROM matched GROUP BY edge_id, ref_id, ROUND(section_start + 1e-9, 3), ROUND(section_end + 1e-9, 3)"),
    "redundant_matches": (("way_nodes",), ", m AS (SELECT way_id, way_id // 4 AS e, list_sort(list(DISTINCT node_id)) AS v FROM way_nodes GROUP BY way_id), r AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY len(v) DESC, way_id) AS k FROM m) SELECT way_id AS match_id FROM r a WHERE NOT EXISTS (SELECT 1 FROM r b WHERE a.e = b.e AND b.k < a.k AND list_has_all(b.v, a.v))"),
    "path_vicinity": (("vicinity",), "SELECT path_id, ref_id, is_vehicle FROM vicinity"),
    "oneway_pairs": (("pairs",), "SELECT ref_id, pair_id FROM pairs"),
    "paired_vicinity": (("paired_vicinity",), "SELECT path_id, ref_id, is_vehicle FROM paired_vicinity"),
    "nearby_edges": (("nearby", "matched"), "SELECT path_id, edge_id, ref_id, ROUND(section_start + 1e-9, 4) AS section_start, ROUND(section_end + 1e-9, 4) AS section_end FROM nearby LEFT JOIN (SELECT * FROM matched WHERE is_forward = 1) USING (edge_id)"),
    "preferred_refs": (("vicinity", "path_refs", "ref_segments"), "SELECT DISTINCT v.path_id, v.ref_id FROM vicinity v JOIN ref_segments r USING (ref_id) WHERE (v.path_id, r.geometry_id) IN (SELECT (path_id, geometry_id) FROM path_refs JOIN ref_segments USING (ref_id))"),
    "edge_weights": (("weights",), "SELECT path_id, ref_id, weight FROM weights"),
    "od_candidates": (("od",), "SELECT path_id, source, sink FROM od"),
    "shortest_chains": (("weights", "od"), ", " + relaxed("SELECT path_id AS grp, from_node, to_node, weight AS w FROM weights", "SELECT DISTINCT path_id AS grp, source FROM od", 24) + " SELECT path_id, path_id || '-' || od.source || '-' || sink AS chain_id, ROUND(dist + 1e-9, 3) AS weight FROM od JOIN r24 r ON r.grp = path_id AND r.source = od.source AND r.node = sink"),
    "choose_matches": (("agency_edges",), "SELECT path_id, path_edge_idx, 2 * edge_id + 1 - along AS ref_id, 1 AS is_forward FROM agency_edges"),
    "choose_centerline_matches": (("agency_edges",), "SELECT path_id, path_edge_idx, 2 * edge_id + 1 - along AS ref_id, 1 AS is_forward FROM agency_edges UNION ALL SELECT path_id, path_edge_idx, 2 * edge_id + along, 0 FROM agency_edges"),
    "best_chains": (("tips_on_chain", "chain_segments", "path_segments"), "SELECT line_id AS path_id, chain_id, ROUND(chain_km + 1e-9, 5) AS chain_km, ROUND(path_km + 1e-9, 5) AS path_km, ROUND(MAX(d) FILTER (e = 0) + 1e-9, 5) AS start_dist_km, ROUND(MAX(d) FILTER (e = 1) + 1e-9, 5) AS end_dist_km, ROUND(MAX(spot) FILTER (e = 0) + 1e-9, 5) AS start_along_km, ROUND(MAX(spot) FILTER (e = 1) + 1e-9, 5) AS end_along_km FROM tips_on_chain JOIN (SELECT line_id AS chain_id, SUM(km) AS chain_km FROM chain_segments GROUP BY line_id) USING (chain_id) JOIN (SELECT line_id, SUM(km) AS path_km FROM path_segments GROUP BY line_id) USING (line_id) GROUP BY line_id, chain_id, chain_km, path_km"),
    "chain_sections": (("chain_cuts",), "SELECT path_id, path_edge_idx, ref_id, row_number() OVER w - 1 AS match_idx, ROUND(section_start + 1e-9, 5) AS section_start, ROUND(section_end + 1e-9, 5) AS section_end, ROUND(SUM(section_end - section_start) OVER w - (section_end - section_start) + 1e-9, 5) AS along_start, ROUND(SUM(section_end - section_start) OVER w + 1e-9, 5) AS along_end FROM chain_cuts WINDOW w AS (PARTITION BY path_id, path_edge_idx ORDER BY since, ref_id ROWS UNBOUNDED PRECEDING)"),
    "avg_deviance": (("matched", "ref_steps", "agency_segments"), ", " + at_distance("SELECT edge_id, ref_id AS line_id, section_start + (section_end - section_start) * i / 10 AS d_km, i FROM matched CROSS JOIN (SELECT unnest(range(11)) AS i) WHERE is_forward = 1", "ref_steps", "edge_id, i, ") + f", t AS (SELECT edge_id, line_id AS ref_id, i, MIN({NEAREST}) AS d FROM (SELECT f.*, s.x1, s.y1, s.x2, s.y2, {ALONG} AS t FROM (SELECT edge_id, line_id, i, x AS px, y AS py FROM found) f JOIN agency_segments s ON s.line_id = f.edge_id) GROUP BY ALL) SELECT edge_id, ref_id, ROUND(AVG(d) + 1e-9, 5) AS avg_deviance_km FROM t GROUP BY ALL"),
    "spatial_overlap": (("overlaps_20m",), "SELECT a_id, b_id, ROUND(d + 1e-9, 5) AS dist_km FROM overlaps_20m"),
}

for _prefix, _matches in (("shared_", "shared_matches"), ("mirrored_", "mirrored_matches")):
    LIB |= loop_sql.own_definitions(LIB, _prefix, _matches)
_OWN = lambda p, *names: tuple(p + n for n in names)
_STRICT = SQL["consolidated_sections_strict"][1]
SQL |= {
    "assigned_matches": ((*_OWN("shared_", "claims", "disputed", "undisputed", "trim", "preferred", "suspects", "losers"), "coincident", "path_edges", "ref_segments"), loop_sql.loop(LIB, "shared_", _STRICT, False, 4, 6)),
    "assigned_centerline": ((*_OWN("mirrored_", "claims", "disputed", "undisputed", "trim", "preferred"), "meta", "path_edges", "ref_segments"), loop_sql.loop(LIB, "mirrored_", _STRICT, True, 4, 6)),
    "rule_is_primary": (("claims", "disputed", "coincident"), loop_sql.rule(LIB, "is_primary")),
    "rule_road_class": (("claims", "disputed", "undisputed", "trim", "path_edges", "ref_segments"), loop_sql.rule(LIB, "road_class")),
    "knaves_multi_path": (_OWN("shared_", "claims", "suspects", "losers"), SQL["knaves_multi_path"][1].replace("FROM claims", "FROM shared_claims").replace("FROM suspects", "FROM shared_suspects").replace("FROM losers", "FROM shared_losers")),
    "reverse_sections": (("mirrored_claims", "meta", "consolidated"), LIB["reverse"].replace("{claims}", "mirrored_claims").replace("{meta}", "meta").replace("{consolidated}", "consolidated")),
}


def oracle_sql() -> dict[str, str]:
    from strandweave.plans import exchange_sql

    out = {}
    for name, (reads, statement) in (SQL | exchange_sql.SQL).items():
        head = ctes(*reads, more=LIB)
        out[name] = f"{head}{statement}" if statement.startswith(",") else f"{head}\n{statement}".strip()
    return out
