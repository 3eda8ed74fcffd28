"""The registered queries over the derived tables, by name. Structs are flattened to plain columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandweave.operators import assign as A, components, coverage as C, directions as D, geometry as G, graph as R, osm as O, projections as P, quality as Q, sections as S, snapshots as N, spatial as X, transit as T
from strandweave.plans.cut import cut
from strandweave.plans.fixtures import Tables
from strandweave.sources import sinks as K

FOUND: dict[str, Callable[[Tables], DataFrame]] = {}


def query(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    FOUND[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from strandweave.plans import exchange  # noqa: F401  it registers its queries

    return {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, f in FOUND.items()}


def consolidated(t: Tables) -> DataFrame:
    return S.consolidate_sections(A.rounded(t.chosen_matches))


def last(t: Tables) -> DataFrame:
    return A.path_last_edge(t.path_edges)


def trim(t: Tables) -> DataFrame:
    return A.trimmability(t.chosen_matches, last(t))


def two_maps(t: Tables) -> DataFrame:
    return consolidated(t).withColumn("map", F.when(F.col("edge_id") % 2 == 0, "tmc").otherwise("ris"))


def preferred(t: Tables) -> DataFrame:
    return C.preferred_direction(C.path_edge_ratios(C.path_edge_stats(t.edges, t.path_edges, t.chosen_matches, last(t))))


def state(t: Tables) -> A.State:
    """Disputed claims as found, nothing awarded or rejected. Rules read claims often, so they are written once."""
    claims = cut(A.find_disputes(t.chosen_matches), "claims")
    none = claims.select(*A.SECTION).limit(0)
    return A.State(claims, none, none)


@query
def dispute_claimants(t):
    return A.find_disputes(t.chosen_matches)


@query
def dispute_extents(t):
    return A.dispute_extents(A.find_disputes(t.chosen_matches))


@query
def undisputed_claims(t):
    return A.undisputed_claims(t.chosen_matches, A.find_disputes(t.chosen_matches))


@query
def consolidated_sections(t):
    return consolidated(t)


@query
def consolidated_sections_strict(t):
    return S.consolidate_sections(A.rounded(t.chosen_matches), strict=True)


@query
def clamped_sections(t):
    wide = t.edge_candidates.select("edge_id", "ref_id", (F.col("section_start") - 0.1).alias("section_start"), (F.col("section_end") + 0.1).alias("section_end"))
    return S.clamp_sections(wide, t.ref_segments).select("edge_id", "ref_id", F.round("section_start", 4).alias("section_start"), F.round("section_end", 4).alias("section_end"))


@query
def section_partitions(t):
    return S.partition_sections(t.ref_segments, consolidated(t))


@query
def conflation_segments(t):
    out = S.conflation_segments(t.ref_segments, two_maps(t), ["tmc", "ris"])
    return out.select("ref_id", "part_idx", "part_start", "part_end", *[F.col(f"{m}.{c}").alias(f"{m}_{c}") for m in ("tmc", "ris") for c in ("edge_id", "is_forward", "section_start", "section_end")])


@query
def conflation_checks(t):
    """The map as it is made passes; pieces of some references are moved before the checks."""
    out = S.conflation_segments(t.ref_segments, two_maps(t), ["tmc", "ris"]).join(t.ref_segments.select("ref_id", "length_km"), "ref_id")
    kind = F.col("ref_id") % 50
    out = out.withColumns({"part_start": F.when(kind < 2, F.col("part_start") + 2).otherwise(F.col("part_start")), "part_end": F.when((kind > 0) & (kind < 3), F.col("part_end") + 2).otherwise(F.col("part_end"))})
    return Q.check_conflation(out, ["tmc", "ris"]).groupBy("failed").count().withColumnRenamed("count", "n")


@query
def conflation_mapping(t):
    out = S.conflation_segments(t.ref_segments, two_maps(t), ["tmc", "ris"])
    return K.conflation_mappings(out, "tmc", ["ref_id", "part_idx"])


@query
def overlap_pairs(t):
    s = consolidated(t).select("ref_id", "edge_id", "section_start", "section_end").distinct()
    return S.binned_overlap_join(s, s, 0.1).where("edge_id < b_edge_id").drop("b_ref_id")


@query
def candidates_without_claim(t):
    return S.overlap_anti(t.edge_candidates, consolidated(t).select("ref_id", "section_start", "section_end"))


@query
def epsilon_overlaps(t):
    return S.split_epsilon_overlaps(consolidated(t))


@query
def reverse_sections(t):
    return A.reverse_dir_candidates(A.rounded(t.mirrored_matches), P.ref_metadata(t.ref_segments), consolidated(t))


@query
def path_last_edge(t):
    return last(t)


@query
def path_edge_stats(t):
    return C.path_edge_ratios(C.path_edge_stats(t.edges, t.path_edges, t.chosen_matches, last(t))).drop("is_unidirectional")


@query
def preferred_direction(t):
    return preferred(t)


@query
def trimmability(t):
    return trim(t).distinct()


@query
def dispute_parties(t):
    return A.dispute_party_counts(A.find_disputes(t.chosen_matches))


@query
def settle_first_step(t):
    return A.settle_once(state(t).claims)


@query
def rule_multi_path(t):
    return A.rule_multi_path(state(t), t.chosen_matches, t.path_edges, t.edge_candidates).claims


@query
def knaves_multi_path(t):
    return A.rule_multi_path(state(t), t.shared_matches, t.path_edges, t.edge_candidates).knaves


@query
def rule_same_edge(t):
    return A.rule_same_edge(state(t).claims)


@query
def rule_unidirectional(t):
    return A.rule_unidirectional(state(t), preferred(t)).claims


@query
def rule_trimmable(t):
    return A.rule_trimmable(state(t).claims, cut(trim(t).distinct(), "trim"))


@query
def rule_epsilon(t):
    return A.rule_epsilon(state(t).claims)


@query
def rule_reverse_assigned(t):
    return A.rule_reverse_assigned(state(t).claims, P.ref_metadata(t.ref_segments), consolidated(t))


@query
def path_class_share(t):
    return A.path_class_share(t.path_edges, consolidated(t), t.ref_segments)


def loop(t: Tables, chosen: DataFrame, **options) -> DataFrame:
    """The whole resolution loop over ``chosen``, and what it leaves assigned."""
    chosen = cut(chosen, "chosen")
    found = cut(C.preferred_direction(C.path_edge_ratios(C.path_edge_stats(t.edges, t.path_edges, chosen, last(t)))), "preferred")
    final = A.resolve(chosen, t.path_edges, t.edge_candidates, found, t.ref_segments, P.ref_metadata(t.ref_segments), **options)
    return A.assigned_matches(A.undisputed_claims(chosen, A.find_disputes(chosen)), final.awards, final.knaves, strict=True)


@query
def assigned_matches(t):
    """The loop with every rule of maps whose edges lie on several paths, non-primary edges first."""
    return loop(t, t.shared_matches, coincident=t.coincident)


@query
def assigned_centerline(t):
    """The loop of centerline maps, both directions of whose references are chosen."""
    return loop(t, t.mirrored_matches, centerline=True)


@query
def rule_is_primary(t):
    new = A.rule_is_primary(state(t), t.chosen_matches, t.coincident)
    return new.claims.select(F.lit("open").alias("outcome"), *A.SECTION).distinct().unionByName(new.knaves.select(F.lit("knave").alias("outcome"), *A.SECTION))


@query
def rule_road_class(t):
    """Judged against what is assigned before any dispute is settled."""
    shares = cut(A.path_class_share(t.path_edges, A.assigned_matches(A.undisputed_claims(t.chosen_matches, A.find_disputes(t.chosen_matches)), *[state(t).claims.select(*A.SECTION).limit(0)] * 2), t.ref_segments), "shares")
    new = A.rule_road_class(state(t), t.chosen_matches, shares, t.ref_segments, cut(trim(t).distinct(), "trim"))
    return new.claims.select(F.lit("open").alias("outcome"), *A.SECTION).distinct().unionByName(new.knaves.select(F.lit("knave").alias("outcome"), *A.SECTION))


@query
def backfill_candidates(t):
    some = cut(t.first_round, "first")
    disputed = cut(A.find_disputes(some), "claims")
    return A.backfill_candidates(t.edge_candidates, some, A.undisputed_claims(some, disputed), disputed.limit(0), disputed)


@query
def dispute_report(t):
    r = A.dispute_report(state(t).claims, trim(t).distinct())
    spelt = lambda c: F.concat_ws(":", *[F.coalesce(c[f].cast("string"), F.lit("-")) for f in ("path_id", "path_edge_idx", "edge_id", "is_forward", "match_idx", "start_trimmable", "end_trimmable")])
    return r.select("ref_id", "disputed_start", "disputed_end", F.array_join(F.transform("claimants", spelt), ",").alias("claimants"))


@query
def assignment_metrics(t):
    return C.assignment_metrics(t.edges, consolidated(t))


@query
def matching_stats(t):
    return C.matching_stats(C.assignment_metrics(t.edges, consolidated(t)))


@query
def assignment_summary(t):
    return C.assignment_summary(C.matching_stats(C.assignment_metrics(t.edges, consolidated(t))))


@query
def path_coverage(t):
    return C.path_coverage(t.path_edges, S.consolidate_sections(A.rounded(t.first_round)))


@query
def qa_lengths(t):
    return C.qa_lengths(t.edges, consolidated(t))


@query
def match_acceptance(t):
    return C.match_acceptance(t.edges, t.chosen_matches)


@query
def multi_path_edges(t):
    return A.multi_path_edges(t.path_edges)


@query
def unmatched_edges(t):
    return X.unmatched(t.edges, S.consolidate_sections(A.rounded(t.first_round)))


@query
def indexed_matches(t):
    return X.index_matches(t.edge_candidates)


@query
def list_unmatched(t):
    return A.list_unmatched(t.edges, S.consolidate_sections(A.rounded(t.first_round))).select("edge_id", "target_map_id")


@query
def matches_by_edge(t):
    m = C.grouped(t.edge_candidates, ["edge_id"], ["section_start", "section_end", "ref_id"])
    return m.select("edge_id", F.array_join(F.transform("members", lambda x: x["ref_id"].cast("string")), ",").alias("refs"), F.aggregate("members", F.lit(0.0), lambda a, x: F.round(a + x["section_end"] - x["section_start"], 4)).alias("km"))


@query
def rule_violations(t):
    return Q.rule_violations(consolidated(t))


@query
def check_chosen(t):
    return Q.check_chosen(t.chosen_matches.withColumn("section_start", F.col("section_start") - 0.01))


@query
def duplicate_metadata(t):
    return Q.duplicate_metadata(t.ref_segments.select("geometry_id", "road_class", "length_km"))


@query
def rejected_rows(t):
    _, rest = Q.split_rejects(t.edge_candidates, ["ref_id"], ["section_start", "edge_id"])
    return rest


@query
def snapshot_diff(t):
    columns = ["path_id", "edge_id", "ref_id", "section_start"]
    return N.diff_rows(t.first_round.select(*columns), t.later_round.select(*columns))


@query
def osm_road_class(t):
    return P.osm_road_class(t.way_tags)


@query
def canonical_nodes(t):
    return O.canonical_node_ids(t.nodes, t.way_nodes, P.osm_road_class(t.way_tags))


def canon_ways(t: Tables) -> DataFrame:
    return O.canonical_ways(t.way_nodes, O.canonical_node_ids(t.nodes, t.way_nodes, P.osm_road_class(t.way_tags)))


@query
def canonical_ways(t):
    c = canon_ways(t)
    return c.select("way_id", F.size("canonical_nodes").alias("n_nodes"), F.element_at("canonical_nodes", 1).alias("first_node"), F.element_at("canonical_nodes", -1).alias("last_node"), F.array_join(F.col("canonical_nodes").cast("array<string>"), ",").alias("node_list"))


@query
def equivalent_ways(t):
    return O.equivalent_ways(canon_ways(t))


@query
def way_sections(t):
    return O.way_sections(t.osm_nodes, t.section_nodes)


@query
def node_sequence_refs(t):
    return O.refs_for_node_sequence(t.osm_nodes.withColumnRenamed("way_id", "seq_id"), t.section_nodes.withColumnRenamed("ref_id", "geometry_id"))


@query
def feed_extent(t):
    return T.feed_extent(t.calendar, t.calendar_dates)


@query
def feed_dates(t):
    return T.feed_dates(T.feed_extent(t.calendar, t.calendar_dates))


def services(t: Tables) -> DataFrame:
    return T.service_dates(t.calendar, t.calendar_dates, T.feed_dates(T.feed_extent(t.calendar, t.calendar_dates)))


@query
def service_dates(t):
    return services(t)


@query
def trip_services(t):
    return T.trip_services(t.trips, T.trip_times(t.stop_times), services(t))


def runs(t: Tables) -> DataFrame:
    return T.trip_counts(T.trip_services(t.trips, T.trip_times(t.stop_times), services(t)), services(t))


@query
def trip_counts(t):
    return runs(t)


def ref_pieces(t: Tables) -> DataFrame:
    return t.ref_segments.select("ref_id", F.col("geometry_id").alias("segment_id"))


@query
def trip_segments(t):
    return T.trip_segments(t.shape_refs, t.trips, ref_pieces(t))


def counts(t: Tables) -> DataFrame:
    return T.shape_bus_counts(T.shape_runs(t.trips, runs(t)), t.shape_refs, ref_pieces(t), T.feed_extent(t.calendar, t.calendar_dates))


@query
def bus_counts(t):
    return counts(t)


@query
def bus_aadt(t):
    return T.bus_aadt(counts(t))


@query
def bus_aadt_by_segment(t):
    m = T.bus_aadt_by_segment(T.bus_aadt(counts(t)))
    total = F.element_at("aadt", F.lit("_total_"))
    return m.select("segment_id", (F.size("aadt") - 1).alias("n_routes"), *[F.round(F.get(total, F.lit(i)), 2).alias(f"total_{p.lower()}") for i, p in enumerate(T.PERIODS)])


@query
def shapeless_trips(t):
    return T.shapeless_trips(t.trips)


@query
def gtfs_qa(t):
    times = T.trip_times(t.stop_times)
    return T.gtfs_qa(t.trips, times, T.trip_services(t.trips, times, services(t)), services(t))


@query
def latest_directions(t):
    d = D.latest_directions(t.station_directions)
    return d.select("rc_station", "year", F.array_join(F.col("federal_directions").cast("array<string>"), ",").alias("directions"))


@query
def federal_direction(t):
    d = D.latest_directions(t.station_directions).crossJoin(F.broadcast(t.region.select(F.col("r_regionkey"))))
    b = (F.col("r_regionkey") * 80 - 160).cast("double")
    return d.select("rc_station", "r_regionkey", *[D.federal_direction(b, F.lit(f), F.col("federal_directions")).alias(f"direction_{f}") for f in (0, 1)])


@query
def ref_metadata(t):
    return P.ref_metadata(t.ref_segments)


@query
def sources_sinks(t):
    return R.sources_sinks(t.oneways)


@query
def forks(t):
    return R.forks(t.ref_segments)


@query
def multi_edges(t):
    return R.multi_edges(t.route_edges)


@query
def graph_components(t):
    return R.components(t.oneways)


@query
def shortest_paths(t):
    """From the nodes whose id is divisible by 100 to all they reach."""
    e = t.ref_segments.select(F.lit(0).alias("grp"), F.col("ref_id").alias("edge_id"), "from_node", "to_node", F.col("length_km").alias("weight"), "road_class")
    sources = t.crossings.where("node_id % 100 = 0").select(F.lit(0).alias("grp"), F.col("node_id").alias("source"))
    return R.shortest_paths(e, sources).select("source", "node", F.round("dist", 4).alias("dist"))


@query
def intersection_layer(t):
    return K.intersection_layer(t.crossings.withColumnRenamed("node_id", "node"), t.oneways)


def edge_ends(t: Tables) -> DataFrame:
    n = t.nodes
    w = t.way_nodes.where("node_idx <= 1").join(n, "node_id")
    a = w.where("node_idx = 0").select(F.col("way_id").alias("edge_id"), F.col("lon").alias("x1"), F.col("lat").alias("y1"))
    b = w.where("node_idx = 1").select(F.col("way_id").alias("edge_id"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    return a.join(b, "edge_id")


@query
def route_paths_milepost(t):
    e = t.path_edges.join(edge_ends(t), "edge_id").select(F.col("path_id").alias("route_id"), "edge_id", F.col("path_edge_idx").alias("beg_mp"), "x1", "y1", "x2", "y2")
    return R.route_paths_milepost(e, 6.0)


@query
def reversed_paths(t):
    return R.reverse_path(t.path_edges)


@query
def paths_through(t):
    return R.paths_through(t.path_edges, t.edges.where("is_primary = 0"))


@query
def line_lengths(t):
    return G.line_lengths(t.curves).select("line_id", "n_points", F.round(F.col("length_km") + 1e-9, 4).alias("length_km"))


@query
def bearings(t):
    return G.bearings(t.curves).select("line_id", F.round(F.col("bearing") + 1e-9, 4).alias("bearing"))


@query
def split_by_bearing(t):
    return G.split_by_bearing(t.curves).select("line_id", "pt_idx", "piece")


@query
def clean_vertices(t):
    return G.clean_vertices(t.curves, 1)


@query
def nearest_on_line(t):
    c = t.curves
    pairs = c.where("pt_idx = 0").select(F.col("line_id").alias("point_id"), (F.col("line_id") + 1).alias("line_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    return G.nearest_on_line(pairs, c).select("point_id", "line_id", F.round(F.col("dist_km") + 1e-9, 5).alias("dist_km"))


@query
def points_along(t):
    half = G.line_lengths(t.curves).select("line_id", (F.col("length_km") / 2).alias("d_km"))
    return G.points_along(t.curves, half).select("line_id", F.round(F.col("x") + 1e-9, 5).alias("x"), F.round(F.col("y") + 1e-9, 5).alias("y"))


@query
def sequentiality(t):
    lines = t.curves.select("line_id").distinct()
    pairs = lines.select(F.col("line_id").alias("a_id"), (F.col("line_id") + 1).alias("b_id"))
    s = G.sequentiality(pairs, t.curves)
    return s.select("a_id", "b_id", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("a_km", "b_km", "turn", "gap_km", "gap_bearing")])


@query
def curve_similarity(t):
    lines = t.curves.select("line_id").distinct()
    pairs = lines.select(F.col("line_id").alias("a_id"), (F.col("line_id") + 1).alias("b_id"))
    c = G.curve_similarity(pairs, t.curves)
    return c.select("a_id", "b_id", "n_points", *[F.round(F.col(x) + 1e-9, 5).alias(x) for x in ("turn", "frechet", "similarity")])


@query
def nearest_nodes(t):
    n = t.nodes.select(F.col("node_id").alias("target_id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    return X.knn_points(t.stations, n, 4).select("point_id", "target_id", "rank", F.round(F.col("dist_km") + 1e-9, 5).alias("dist_km"))


@query
def compact_layers(t):
    return K.compact_layers(t.ref_segments, t.edges).groupBy("layer", "code").agg(F.count("*").alias("n"))


@query
def component_sizes(t):
    c = components.connected_components(t.way_nodes.select(F.col("way_id").alias("src"), (F.col("node_id") + (1 << 40)).alias("dst")))
    return c.groupBy("component").agg(F.count("*").alias("n"))


def agency_matches(t: Tables) -> DataFrame:
    return X.match_edges(t.agency_points, t.ref_points)


@query
def match_edges(t):
    m = agency_matches(t)
    return m.select("edge_id", "ref_id", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("section_start", "section_end", "score_km")])


@query
def match_centerlines(t):
    return X.match_edges(t.agency_points, t.ref_points, centerline=True).select("edge_id", "ref_id", "is_forward")


@query
def unmatched_by_line(t):
    """Still unmatched after the first round, by the edges' own lengths."""
    km = G.line_lengths(t.agency_points).select(F.col("line_id").alias("edge_id"), F.col("length_km").alias("edge_length_km"))
    return X.unmatched(km, agency_matches(t).where("section_end - section_start < 0.9"))


@query
def merged_matches(t):
    """MAT-4: line directions first, then centerlines."""
    cols = ["edge_id", "ref_id", "section_start", "section_end"]
    snap = lambda df: df.select("edge_id", "ref_id", *[F.round(F.col(c) + 1e-9, 3).alias(c) for c in cols[2:]])
    both = X.match_edges(t.agency_points, t.ref_points, centerline=True)
    return X.merge_matches([snap(both.where("is_forward = 1")), snap(both)]).select("edge_id", "ref_id", "round")


@query
def redundant_matches(t):
    """MAT-3 on ways as matches: the vertices of a way within another's of the same edge and reference."""
    m = t.way_nodes.groupBy("way_id").agg(F.array_sort(F.collect_set("node_id")).alias("vertices"))
    return X.drop_redundant(m.select((F.floor(F.col("way_id") / 4)).alias("edge_id"), F.lit(1).alias("ref_id"), F.col("way_id").alias("match_id"), "vertices")).select("match_id")


def agency_paths(t: Tables) -> DataFrame:
    return R.merge_path(t.agency_edges, t.agency_points.withColumnRenamed("line_id", "edge_id"))


def own_refs(t: Tables) -> DataFrame:
    return t.agency_edges.join(agency_matches(t), "edge_id").select("path_id", "ref_id").distinct()


def vicinity_of(t: Tables, own: DataFrame) -> DataFrame:
    return X.path_vicinity(agency_paths(t), t.ref_points, t.ref_segments, own)


def weights_of(t: Tables) -> DataFrame:
    own = cut(own_refs(t), "own")
    vicinity = cut(vicinity_of(t, own), "vicinity")
    return X.edge_weights(X.mean_distances(vicinity, agency_paths(t), t.ref_points), X.preferred_refs(vicinity, own, t.ref_segments), t.ref_segments)


@query
def merged_paths(t):
    return agency_paths(t)


@query
def path_vicinity(t):
    return vicinity_of(t, own_refs(t))


@query
def oneway_pairs(t):
    return X.oneway_pairs(t.oneway_points)


@query
def paired_vicinity(t):
    """Vicinities over two carriageways, with the other one for paths that run both ways."""
    ways = X.oneway_refs(t.carriageways).withColumnRenamed("ref_id", "line_id")
    pairs = X.oneway_pairs(t.carriageway_points.join(ways, "line_id", "left_semi"))
    return X.path_vicinity(agency_paths(t), t.carriageway_points, t.carriageways, own_refs(t), pairs=pairs, two_way=t.two_way_paths)


@query
def nearby_edges(t):
    found = X.nearby_edges(agency_paths(t), t.agency_edges, t.agency_points, t.ref_points, cut(agency_matches(t), "matches"))
    return found.select("path_id", "edge_id", "ref_id", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("section_start", "section_end")])


@query
def preferred_refs(t):
    own = cut(own_refs(t), "own")
    return X.preferred_refs(vicinity_of(t, own), own, t.ref_segments)


@query
def edge_weights(t):
    return weights_of(t).select("path_id", "ref_id", F.round(F.col("weight") + 1e-9, 4).alias("weight"))


@query
def od_candidates(t):
    return X.od_candidates(agency_paths(t), weights_of(t), t.crossings)


@query
def shortest_chains(t):
    """Lengths of the chains; which of several equal ones is taken is no matter of SQL."""
    w = cut(weights_of(t).withColumn("weight", F.round(F.col("weight") + 1e-9, 4)), "weights")
    chains = X.shortest_chains(w, X.od_candidates(agency_paths(t), w, t.crossings))
    steps = X.chain_refs(chains, w).join(w.select("path_id", "ref_id", "weight"), ["path_id", "ref_id"])
    return steps.groupBy("path_id", "chain_id").agg(F.round(F.sum("weight") + 1e-9, 3).alias("weight"))


@query
def choose_matches(t):
    """The whole chain of matching and choice: each edge's longest section lies on the reference it was drawn beside."""
    found = X.choose_matches(t.agency_edges.select("path_id", "path_edge_idx", "edge_id"), t.agency_points, cut(agency_matches(t), "matches"), t.ref_segments, t.ref_points, t.crossings, vehicles=False)
    longest = found.groupBy("path_id", "path_edge_idx").agg(F.max_by(F.struct("ref_id", "is_forward", "section_start", "section_end"), F.col("section_end") - F.col("section_start")).alias("m"))
    return longest.select("path_id", "path_edge_idx", "m.ref_id", "m.is_forward")


@query
def choose_centerline_matches(t):
    """The same both ways: the backward chain takes the references of the other direction."""
    both = cut(X.match_edges(t.agency_points, t.ref_points, centerline=True), "matches")
    found = X.choose_matches(t.agency_edges.select("path_id", "path_edge_idx", "edge_id"), t.agency_points, both, t.ref_segments, t.ref_points, t.crossings, centerline=True, vehicles=False)
    longest = found.groupBy("path_id", "path_edge_idx", "is_forward").agg(F.max_by("ref_id", F.col("section_end") - F.col("section_start")).alias("ref_id"))
    return longest.select("path_id", "path_edge_idx", "ref_id", "is_forward")


def scored_chains(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidate chains of streets, their lines and :func:`X.score_chains` of them."""
    known = t.ref_segments.select("ref_id")
    chain = cut(t.street_chains.join(known, "ref_id", "left_semi"), "chain")
    lines = cut(X.chain_lines(chain, t.ref_points), "lines")
    paths = cut(agency_paths(t), "paths")
    return chain, lines, cut(X.score_chains(X.measure_chains(chain.join(paths.select(F.col("line_id").alias("path_id")).distinct(), "path_id", "left_semi"), lines, paths)), "scored")


@query
def best_chains(t):
    """SRT-2: of the chains beside, against and apart from a street the one beside, with its measures."""
    _, _, scored = scored_chains(t)
    best = X.best_chain(scored).join(scored.drop("path_id", "score"), "chain_id")
    return best.select("path_id", "chain_id", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("chain_km", "path_km", "start_dist_km", "end_dist_km", "start_along_km", "end_along_km")])


@query
def chain_sections(t):
    """SEC-7 to SEC-9: every section of the edges' matches along the best chain."""
    chain, lines, scored = scored_chains(t)
    km = G.line_lengths(t.ref_points).select(F.col("line_id").alias("ref_id"), "length_km")
    snapped = X.edge_snaps(t.agency_edges.select("path_id", "path_edge_idx", "edge_id"), t.agency_points, lines, scored.select("path_id", "chain_id"))
    found = X.first_chain_matches(scored.select("path_id", "chain_id", "score"), snapped, chain.drop("path_id"), km)
    return found.select("path_id", "path_edge_idx", "ref_id", "match_idx", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("section_start", "section_end", "along_start", "along_end")])


@query
def avg_deviance(t):
    d = X.avg_deviance(agency_matches(t), t.agency_points, t.ref_points)
    return d.select("edge_id", "ref_id", F.round(F.col("avg_deviance_km") + 1e-9, 5).alias("avg_deviance_km"))


@query
def spatial_overlap(t):
    o = X.spatial_overlap(t.agency_points, t.ref_points, 0.02)
    return o.select("a_id", "b_id", F.round(F.col("dist_km") + 1e-9, 5).alias("dist_km"))
