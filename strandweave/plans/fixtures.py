"""Road, transit and graph tables derived from the given tables, in SQL that both engines read.

Each definition names its inputs as ``{table}``; the inputs are given tables or earlier definitions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SQL = {
    # streets of towns of ten by ten crossings, nine blocks a street: geometries are numbered along the streets
    "blocks": """SELECT p_partkey AS ref_id, g AS geometry_id, is_forward, road_class, form_of_way, ROUND(9e-1 + (g % 100) / 1e3, 4) AS length_km, town * 100 + CASE WHEN k < 90 THEN street * 10 + place ELSE place * 10 + street - 10 END AS a, town * 100 + CASE WHEN k < 90 THEN street * 10 + place + 1 ELSE (place + 1) * 10 + street - 10 END AS z
  FROM (SELECT p_partkey, g, is_forward, road_class, form_of_way, CAST(floor(g / 180) AS BIGINT) AS town, g % 180 AS k, CAST(floor((g % 180) / 9) AS BIGINT) AS street, g % 9 AS place
    FROM (SELECT p_partkey, CAST(floor(p_partkey / 2) AS BIGINT) AS g, 1 - (p_partkey % 2) AS is_forward, p_size % 9 AS road_class, p_size % 8 AS form_of_way FROM {part}) i) j""",
    "ref_segments": """SELECT ref_id, geometry_id, is_forward, road_class, form_of_way, length_km, CASE WHEN is_forward = 1 THEN a ELSE z END AS from_node, CASE WHEN is_forward = 1 THEN z ELSE a END AS to_node
  FROM {blocks}""",
    # streets as routes, by number: a one-way line, a two-way line, a ring, a line with a branch and parallel edges
    "route_edges": """SELECT route_id, geometry_id * 4 AS edge_id, CASE WHEN kind = 3 AND place = 6 THEN a - 3 * step ELSE a END AS from_node, CASE WHEN kind = 2 AND place = 8 THEN a - 8 * step ELSE z END AS to_node, length_km AS weight, road_class
  FROM (SELECT b.*, CAST(floor(geometry_id / 9) AS BIGINT) AS route_id, CAST(floor(geometry_id / 9) AS BIGINT) % 4 AS kind, geometry_id % 9 AS place, z - a AS step FROM {blocks} b WHERE is_forward = 1) r
  UNION ALL SELECT CAST(floor(geometry_id / 9) AS BIGINT), geometry_id * 4 + 1, z, a, length_km, road_class FROM {blocks} WHERE is_forward = 1 AND CAST(floor(geometry_id / 9) AS BIGINT) % 4 = 1
  UNION ALL SELECT CAST(floor(geometry_id / 9) AS BIGINT), geometry_id * 4 + 2 + k, a, z, length_km + k - 5e-1, road_class FROM {blocks} CROSS JOIN (VALUES (0), (1)) AS n(k) WHERE is_forward = 1 AND CAST(floor(geometry_id / 9) AS BIGINT) % 4 = 3 AND geometry_id % 9 % 4 = 0""",
    "oneways": """SELECT * FROM {ref_segments} WHERE is_forward = 1 AND geometry_id % 5 <> 0""",
    "crossings": """SELECT node_id, ROUND(-74e0 + (CAST(floor(node_id / 100) AS BIGINT) % 10) * 2e-1 + (node_id % 10) * 1e-2, 6) AS x, ROUND(40e0 + floor(node_id / 1000) * 2e-1 + floor((node_id % 100) / 10) * 1e-2, 6) AS y
  FROM (SELECT DISTINCT from_node AS node_id FROM {ref_segments} UNION SELECT DISTINCT to_node FROM {ref_segments}) n""",
    "street_points": """SELECT ref_id, geometry_id, pt_idx, CASE WHEN pt_idx = 0 THEN a.x WHEN pt_idx = 2 THEN z.x ELSE ROUND((a.x + z.x) / 2 + (geometry_id % 3 - 1) / 1e4, 6) END AS x, CASE WHEN pt_idx = 0 THEN a.y WHEN pt_idx = 2 THEN z.y ELSE ROUND((a.y + z.y) / 2 + (geometry_id % 5 - 2) / 1e4, 6) END AS y
  FROM {ref_segments} r JOIN {crossings} a ON r.from_node = a.node_id JOIN {crossings} z ON r.to_node = z.node_id CROSS JOIN (VALUES (0), (1), (2)) AS k(pt_idx)""",
    "ref_points": """SELECT ref_id AS line_id, pt_idx, x, y FROM {street_points}""",
    # base lines where every fifth geometry is two carriageways, a hundred metres apart
    "carriageways": """SELECT ref_id, CASE WHEN geometry_id % 5 = 0 AND is_forward = 0 THEN geometry_id + 1000000000 ELSE geometry_id END AS geometry_id, CASE WHEN geometry_id % 5 = 0 THEN 2 ELSE 3 END AS form_of_way, road_class
  FROM {ref_segments}""",
    "carriageway_points": """SELECT ref_id AS line_id, pt_idx, ROUND(CASE WHEN geometry_id % 5 = 0 AND ref_id % 2 = 1 THEN x - 1e-3 ELSE x END, 6) AS x, ROUND(CASE WHEN geometry_id % 5 = 0 AND ref_id % 2 = 1 THEN y + 1e-3 ELSE y END, 6) AS y
  FROM {street_points}""",
    "oneway_points": """SELECT p.* FROM {carriageway_points} p JOIN {carriageways} c ON p.line_id = c.ref_id WHERE form_of_way = 2""",
    "two_way_paths": """SELECT DISTINCT path_id FROM {agency_edges} WHERE path_id % 2 = 0""",
    # an agency's edges: the middle of each block beside the base line; every other street drawn backwards
    "agency_edges": """SELECT geometry_id AS edge_id, CAST(floor(geometry_id / 9) AS BIGINT) AS path_id, CASE WHEN floor(geometry_id / 9) % 2 = 0 THEN geometry_id % 9 ELSE 8 - geometry_id % 9 END AS path_edge_idx, CASE WHEN floor(geometry_id / 9) % 2 = 0 THEN 1 ELSE 0 END AS along
  FROM {ref_segments} WHERE is_forward = 1""",
    "agency_points": """SELECT e.edge_id AS line_id, CASE WHEN along = 1 THEN pt_idx ELSE 2 - pt_idx END AS pt_idx, ROUND(x + 4e-5, 6) AS x, ROUND(y + 4e-5, 6) AS y
  FROM {agency_edges} e JOIN {street_points} p ON p.ref_id = 2 * e.edge_id""",
    # candidate chains of an agency's street: the base references it was drawn beside, those against it, a street beside it
    "street_chains": """SELECT path_id, concat(CAST(path_id AS STRING), '-a') AS chain_id, path_edge_idx AS chain_idx, 2 * edge_id + 1 - along AS ref_id FROM {agency_edges}
  UNION ALL SELECT path_id, concat(CAST(path_id AS STRING), '-b'), 8 - path_edge_idx, 2 * edge_id + along FROM {agency_edges}
  UNION ALL SELECT path_id - 2, concat(CAST(path_id - 2 AS STRING), '-c'), path_edge_idx, 2 * edge_id + 1 - along FROM {agency_edges} WHERE path_id >= 2""",
    "edges": """SELECT o_orderkey AS edge_id, concat('T', CAST(o_orderkey AS STRING)) AS target_map_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_unidirectional, (2000 + CAST(floor(o_totalprice / 25) AS BIGINT)) / 1e4 AS edge_length_km, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS is_primary
  FROM {orders}""",
    "path_edges": """SELECT o_custkey AS path_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS path_edge_idx, o_orderkey AS edge_id
  FROM {orders}
  UNION ALL SELECT 1000000 + CAST(floor(o_custkey / 5) AS BIGINT) AS path_id, row_number() OVER (PARTITION BY CAST(floor(o_custkey / 5) AS BIGINT) ORDER BY o_orderdate, o_orderkey) - 1 AS path_edge_idx, o_orderkey AS edge_id
  FROM {orders}
  WHERE o_orderkey % 5 = 0""",
    "chosen_matches": """SELECT path_id, path_edge_idx, edge_id, is_forward, row_number() OVER (PARTITION BY path_id, path_edge_idx, is_forward ORDER BY section_start, ref_id) - 1 AS match_idx, ref_id, section_start, section_end, avg_deviance_km
  FROM (SELECT p.path_id, p.path_edge_idx, p.edge_id, l.l_linenumber % 2 AS is_forward, l.l_partkey AS ref_id, MIN(ROUND(l.l_discount * 7 + l.l_tax * 8e-1, 4)) AS section_start, MAX(ROUND(least(l.l_discount * 7 + l.l_tax * 8e-1 + 5e-3 + l.l_quantity / 2e3, 9e-1), 4)) AS section_end, MIN(ROUND(l.l_tax + 0.001, 4)) AS avg_deviance_km
  FROM {path_edges} p
  JOIN {lineitem} l ON p.edge_id = l.l_orderkey
  GROUP BY p.path_id, p.path_edge_idx, p.edge_id, l.l_linenumber % 2, l.l_partkey) t""",
    # paths that share edges but not all their choices
    "shared_matches": """SELECT c.* FROM {chosen_matches} c LEFT JOIN (SELECT DISTINCT edge_id AS known_edge, ref_id AS known_ref FROM {edge_candidates}) k ON c.edge_id = known_edge AND c.ref_id = known_ref
  WHERE path_id < 1000000 OR (c.ref_id % 3 <> 0 AND (c.edge_id % 2 = 1 OR known_ref IS NOT NULL))""",
    # edges that also chose the other direction of their reference, where they lie
    "mirrored_matches": """SELECT * FROM {chosen_matches}
  UNION ALL SELECT path_id, path_edge_idx, edge_id, 1 - c.is_forward, match_idx + 100, o.ref_id, ROUND(r.length_km - section_end, 4), ROUND(r.length_km - section_start, 4), avg_deviance_km
  FROM {chosen_matches} c JOIN {ref_segments} r ON c.ref_id = r.ref_id JOIN {ref_segments} o ON o.geometry_id = r.geometry_id AND o.ref_id <> r.ref_id WHERE c.edge_id % 3 = 0 AND section_end <= r.length_km""",
    "coincident": """SELECT edge_id FROM {edges} WHERE is_primary = 0 AND edge_id % 4 < 2""",
    "first_round": """SELECT * FROM {chosen_matches} WHERE edge_id % 4 <> 0""",
    "later_round": """SELECT * FROM {chosen_matches} WHERE match_idx >= 1""",
    "edge_candidates": """SELECT l_orderkey AS edge_id, ref_id, MIN(ROUND(l_discount * 5, 4)) AS section_start, MAX(ROUND(least(l_discount * 5 + 0.05 + l_quantity / 100, 0.9), 4)) AS section_end
  FROM (SELECT l_orderkey, CASE WHEN l_linenumber < 3 THEN l_partkey ELSE l_partkey + 2 END AS ref_id, l_discount, l_quantity FROM {lineitem} WHERE l_linenumber <= 3) t
  GROUP BY l_orderkey, ref_id""",
    "stop_times": """SELECT trip_id, lpad(CAST(CAST(floor(s / 3600) AS INT) AS STRING), 2, '0') AS hh, concat(lpad(CAST(CAST(floor(s / 3600) AS INT) AS STRING), 2, '0'), ':', lpad(CAST(CAST(floor((s % 3600) / 60) AS INT) AS STRING), 2, '0'), ':', lpad(CAST(s % 60 AS STRING), 2, '0')) AS arrival_time, stop_sequence
  FROM (SELECT concat(CAST(user_id AS STRING), '_', CAST(CAST(floor(hour(ts) / 4) AS INT) AS STRING)) AS trip_id, hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS INT) + CASE WHEN user_id % 10 = 0 THEN 14400 ELSE 0 END AS s, event_id AS stop_sequence
  FROM {events}) t""",
    "trips": """SELECT DISTINCT concat(CAST(user_id AS STRING), '_', CAST(CAST(floor(hour(ts) / 4) AS INT) AS STRING)) AS trip_id, user_id % 7 AS service_id, user_id % 25 AS route_id, CASE WHEN user_id % 50 = 0 THEN NULL ELSE user_id END AS shape_id
  FROM {events}""",
    "shape_refs": """SELECT DISTINCT user_id AS shape_id, user_id * 12 + j AS ref_id
  FROM {events} CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13)) AS k(j)""",
    "calendar": """SELECT DISTINCT n_nationkey % 7 AS service_id, CASE WHEN (n_nationkey % 7) IN (0, 6) THEN 1 ELSE 0 END AS sunday, CASE WHEN (n_nationkey % 7) < 5 THEN 1 ELSE 0 END AS monday, 1 AS tuesday, CASE WHEN (n_nationkey % 7) <> 3 THEN 1 ELSE 0 END AS wednesday, 1 AS thursday, CASE WHEN (n_nationkey % 7) < 6 THEN 1 ELSE 0 END AS friday, CASE WHEN (n_nationkey % 7) > 4 THEN 1 ELSE 0 END AS saturday, '20240101' AS start_date, '20240130' AS end_date
  FROM {nation}""",
    "calendar_dates": """SELECT user_id % 7 AS service_id, concat('202401', lpad(CAST(day(ts) AS STRING), 2, '0')) AS date, MIN(CASE WHEN event_type = 'error' THEN 2 ELSE 1 END) AS exception_type
  FROM {events}
  WHERE event_id % 97 = 0
  GROUP BY user_id % 7, concat('202401', lpad(CAST(day(ts) AS STRING), 2, '0'))""",
    "way_nodes": """SELECT l_orderkey AS way_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS node_idx, l_partkey AS node_id
  FROM {lineitem}""",
    "section_ways": """SELECT geometry_id, row_number() OVER (PARTITION BY geometry_id ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS section_idx, l_orderkey AS way_id, l_suppkey AS node_id, l_linenumber % 9 AS road_class, CASE WHEN l_linenumber % 3 = 0 THEN 'primary' WHEN l_linenumber % 3 = 1 THEN 'residential' ELSE 'service' END AS highway
  FROM (SELECT l.*, CAST(floor(l_partkey / 2) AS BIGINT) AS geometry_id FROM {lineitem} l WHERE l_quantity > 45) t""",
    "osm_nodes": """SELECT * FROM {way_nodes} WHERE way_id % 2 = 0""",
    "section_nodes": """SELECT way_id AS ref_id, node_idx, node_id FROM {way_nodes} WHERE way_id % 2 = 1""",
    "nodes": """SELECT p_partkey AS node_id, ROUND(-74e0 - (CAST(floor(p_partkey / 3) AS BIGINT) % 100) / 1e3, 6) AS lon, ROUND(42e0 + CAST(floor(p_partkey / 300) AS BIGINT) / 1e3, 6) AS lat
  FROM {part}""",
    "stations": """SELECT s_suppkey AS point_id, ROUND(-74e0 + (s_suppkey % 97) / 1e3 - 0.0969, 6) AS x, ROUND(42e0 + (s_suppkey % 61) / 1e4 + 0.0002, 6) AS y FROM {supplier}""",
    "way_tags": """SELECT o_orderkey AS way_id, CASE o_orderpriority WHEN '1-URGENT' THEN ' Motorway_Link' WHEN '2-HIGH' THEN 'primary' WHEN '3-MEDIUM' THEN 'residential' WHEN '4-NOT SPECIFIED' THEN 'service' ELSE 'footway' END AS highway, CASE WHEN o_orderstatus = 'F' THEN 'driveway' ELSE NULL END AS service
  FROM {orders}""",
    "station_directions": """SELECT DISTINCT concat(lpad(CAST(s_nationkey AS STRING), 2, '0'), '_', lpad(CAST(s_suppkey AS STRING), 4, '0')) AS rc_station, year(l_shipdate) AS year, 1 + 2 * (l_linenumber % 4) AS federal_direction
  FROM {lineitem}
  JOIN {supplier} ON l_suppkey = s_suppkey
  WHERE l_shipdate IS NOT NULL AND l_linenumber < 6""",
    "curves": """SELECT vec_id AS line_id, pos AS pt_idx, ROUND(CAST(embedding[2 * pos + {base}] AS DOUBLE), 6) AS x, ROUND(CAST(embedding[2 * pos + 1 + {base}] AS DOUBLE), 6) AS y
  FROM {embeddings} CROSS JOIN (SELECT 8 * h + l AS pos FROM (VALUES (0), (1), (2), (3)) AS a(h) CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS b(l)) k""",
}


class Tables:
    """Given and derived tables of one folder as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._held = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._held:
            if name in SQL:
                text = SQL[name].replace("{base}", "0")
                self._held[name] = self._spark.sql(text, **{t: getattr(self, t) for t in inputs(name)})
            else:
                self._held[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._held[name]


def inputs(name: str) -> list[str]:
    return [t for t in dict.fromkeys(re.findall(r"\{(\w+)\}", SQL[name])) if t != "base"]


def ctes(*names: str, more: dict[str, str] | None = None) -> str:
    """The definitions of the named tables (or of ``more``) and all they read, as the head of a DuckDB query."""
    known = SQL | (more or {})
    order: list[str] = []

    def need(name: str) -> None:
        if name in known and name not in order:
            for t in re.findall(r"\{(\w+)\}", known[name]):
                need(t)
            order.append(name)

    for name in names:
        need(name)
    if not order:
        return ""
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED (" + re.sub(r"\{(\w+)\}", lambda m: "1" if m[1] == "base" else m[1], known[n]) + ")" for n in order)
