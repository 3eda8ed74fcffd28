"""Assignment of reference sections to edges: disputes, resolution rules and the loop that applies them.

The state is three DataFrames: open claims (claims of a disputed reference), awards and knaves (sections that
lost). Every rule maps claims to fewer claims; the loop logs what goes, and judges again only what that changed.
A claim has path_id, path_edge_idx, edge_id, is_forward, match_idx, ref_id, section_start, section_end; a
dispute is named by its reference.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.operators.geometry import line_slice
from strandweave.operators.sections import consolidate_sections, overlap_anti, overlapping, reverse_section_join
from strandweave.plans.cut import Log, cut, release

CLAIM = ["path_id", "path_edge_idx", "edge_id", "is_forward", "match_idx", "ref_id", "section_start", "section_end"]
KEY = ["ref_id", "path_id", "path_edge_idx", "is_forward"]
SECTION = ["ref_id", "edge_id", "is_forward", "section_start", "section_end"]


def rounded(chosen: DataFrame) -> DataFrame:
    """Claims with sections in 0.0001 km, the precision of all comparisons, and a positive length."""
    return chosen.withColumns({"section_start": F.round("section_start", 4), "section_end": F.round("section_end", 4)}).where("section_start < section_end").select(*CLAIM)


def _touching(a: str, b: str) -> Column:
    return (F.col(f"{a}.section_start") < F.col(f"{b}.section_end")) & (F.col(f"{b}.section_start") < F.col(f"{a}.section_end"))


def find_disputes(chosen: DataFrame) -> DataFrame:
    """ASG-1. The claims that overlap a claim of another path on the same reference."""
    claims = rounded(chosen)
    return overlapping(claims, claims, differs="path_id")


def dispute_extents(claims: DataFrame) -> DataFrame:
    """AGG-14. Per disputed reference the extent of its claims and their number."""
    return claims.groupBy("ref_id").agg(F.min("section_start").alias("disputed_start"), F.max("section_end").alias("disputed_end"), F.count("*").alias("n_claims"))


def undisputed_claims(chosen: DataFrame, disputed: DataFrame) -> DataFrame:
    """ASG-2. Claims of positive length that are in no dispute."""
    return rounded(chosen).join(disputed.select(*CLAIM), CLAIM, "left_anti").distinct()


def path_last_edge(path_edges: DataFrame) -> DataFrame:
    """AGG-1. (path_id, last_idx, last_edge)."""
    return path_edges.groupBy("path_id").agg(F.max("path_edge_idx").alias("last_idx"), F.max_by("edge_id", "path_edge_idx").alias("last_edge"))


def innermost_match(chosen: DataFrame) -> DataFrame:
    """WIN-1. Matches ranked within path, edge and direction, the last match first."""
    order = Window.partitionBy("path_id", "path_edge_idx", "is_forward").orderBy(F.desc("match_idx"), "ref_id")
    return chosen.withColumn("from_end", F.row_number().over(order))


def trimmability(chosen: DataFrame, last: DataFrame) -> DataFrame:
    """ASG-3. Whether a match may be cut at its start and end without tearing its path.

    Matches on a single-edge path: null; inner edges: neither; the first or last edge: both, but for the
    match that touches the rest of the path, which may be cut only on its outer side.
    """
    ranked = innermost_match(chosen).join(last.select("path_id", "last_idx"), "path_id")
    first, final = F.col("path_edge_idx") == 0, F.col("path_edge_idx") == F.col("last_idx")
    forward, lone = F.col("is_forward") == 1, F.col("last_idx") == 0
    ends_inward = (first & forward) | (final & ~forward)
    starts_inward = (first & ~forward) | (final & forward)
    start = F.when(lone, None).when(ends_inward, 1).when(starts_inward, (F.col("match_idx") > 0).cast("int")).otherwise(0)
    end = F.when(lone, None).when(ends_inward, (F.col("from_end") > 1).cast("int")).when(starts_inward, 1).otherwise(0)
    return ranked.select("path_id", "path_edge_idx", "is_forward", "match_idx", start.alias("start_trimmable"), end.alias("end_trimmable"))


def add_knaves(knaves: DataFrame | None, new: DataFrame) -> DataFrame:
    """ASG-4. Rejected sections, each once."""
    new = new.select(*SECTION)
    return (new if knaves is None else knaves.unionByName(new)).distinct()


@dataclass(frozen=True)
class State:
    claims: DataFrame
    awards: DataFrame
    knaves: DataFrame


def dispute_party_counts(claims: DataFrame) -> DataFrame:
    """AGG-13. Per dispute the number of distinct (path, direction)."""
    return claims.groupBy("ref_id").agg(F.count_distinct("path_id", "is_forward").alias("n_parties"))


def first_wins(existing: DataFrame | None, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """SET-5. Of rows with equal keys the first in a stated order; rows already held come before all."""
    ranked = new.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")
    return ranked if existing is None else existing.unionByName(ranked.join(existing, keys, "left_anti"))


def new_awards(awards: DataFrame | None, new: DataFrame) -> DataFrame:
    """What ``new`` adds to awards held, by step; a reference gives an edge, a start and an end only once each."""
    order = ["step", "path_id", "path_edge_idx", "is_forward", "match_idx", "section_start", "section_end"]
    chosen = first_wins(None, new, ["ref_id", "edge_id"], order)
    chosen = first_wins(None, chosen, ["ref_id", "section_start"], order)
    chosen = first_wins(None, chosen, ["ref_id", "section_end"], order).select(*SECTION)
    for keys in (["ref_id", "edge_id"], ["ref_id", "section_start"], ["ref_id", "section_end"]) if awards is not None else ():
        chosen = chosen.join(awards.select(*keys), keys, "left_anti")
    return chosen


def settle_once(claims: DataFrame) -> DataFrame:
    """One step of ASG-5: the claims with ``won``: the dispute has one party, or no other edge overlaps the claim."""
    parties = dispute_party_counts(claims)
    sections = claims.select("ref_id", "edge_id", "section_start", "section_end").distinct()
    contested = overlapping(sections, sections, differs="edge_id").withColumn("contested", F.lit(True))
    marked = claims.join(contested, ["ref_id", "edge_id", "section_start", "section_end"], "left").join(parties, "ref_id")
    return marked.select(*CLAIM, (F.col("contested").isNull() | (F.col("n_parties") == 1)).alias("won"))


class Disputes:
    """ASG-5, ASG-14. The open claims of all disputes, as the first claims and a log of those that went. A rule is judged
    again only for the disputes that lost a claim since it last ran; awards and knaves are logs too."""

    def __init__(self, claims: DataFrame):
        self.first, self.n, self.seq = claims, claims.count(), 0
        self.gone, self.awards, self.knaves = Log(), Log(), Log()
        self.seen: dict[str, int] = {}

    def claims(self) -> DataFrame:
        gone = self.gone.rows()
        return self.first if gone is None else self.first.join(gone.select(*CLAIM), CLAIM, "left_anti")

    def state(self) -> State:
        none = self.first.select(*SECTION).limit(0)
        held = [t.rows() for t in (self.awards, self.knaves)]
        return State(self.claims(), *[none if t is None else t.distinct() for t in held])

    def changed(self, name: str | None) -> DataFrame | None:
        """The open claims of the disputes that changed since rule ``name`` asked last, all for a rule without a name; None if
        none did."""
        if name is None:
            return self.claims()
        since, self.seen[name] = self.seen.get(name), self.seq
        if since is None:
            return self.claims()
        if since == self.seq:
            return None
        return self.claims().join(self.gone.rows().where(F.col("seq") >= since).select("ref_id").distinct(), "ref_id", "left_semi").select(*CLAIM)

    def remove(self, rows: DataFrame) -> DataFrame | None:
        """Log that these claims went; the table if there are any."""
        table = cut(rows.select(*CLAIM, F.lit(self.seq).alias("seq")), "gone")
        n = table.count()
        if not n:
            release(table)
            return None
        self.gone.add(table)
        self.n, self.seq = self.n - n, self.seq + 1
        return table

    def judge(self, name: str | None, rule: Callable[[DataFrame], DataFrame]) -> None:
        """What ``rule`` does not keep of the changed disputes goes; then disputes are settled."""
        rows = self.changed(name)
        if rows is not None:
            rows = cut(rows, "frontier")
            self.remove(rows.join(rule(rows).select(*CLAIM), CLAIM, "left_anti"))
            release(rows)
        self.settle()

    def settle(self) -> None:
        """Award disputes with one party and claims that no other edge overlaps, until none is left to award; the awards
        are made in the order of steps."""
        won, step = None, 0
        while (rows := self.changed("settle")) is not None:
            table = self.remove(settle_once(rows).where("won"))
            if table is None:
                break
            part = cut(table.select(*CLAIM, F.lit(step).alias("step")), "won")
            won, step = part if won is None else won.unionByName(part), step + 1
        if won is not None:
            self.awards.add(cut(new_awards(self.awards.rows(), won), "awards"))


def coordinate_containment(points: DataFrame, edges: DataFrame) -> DataFrame:
    """JN-6. (edge_id, within): non-primary edges whose vertices and a primary edge's contain one another.

    ``points``: edge_id, pt_idx, x, y. Edges sharing a vertex pair are candidates by equi-join; for each
    alignment of positions, the shorter line must match in all its vertices.
    """
    v = points.join(edges.select("edge_id", "is_primary"), "edge_id")
    n = points.groupBy("edge_id").agg(F.count("*").alias("n"))
    a, b = v.where("is_primary = 0").alias("a"), v.where("is_primary = 1").alias("b")
    same = a.join(b, (F.col("a.x") == F.col("b.x")) & (F.col("a.y") == F.col("b.y")))
    runs = same.groupBy(F.col("a.edge_id").alias("edge_id"), F.col("b.edge_id").alias("within"), (F.col("a.pt_idx") - F.col("b.pt_idx")).alias("shift")).agg(F.count("*").alias("matched"))
    sized = runs.join(n, "edge_id").join(n.select(F.col("edge_id").alias("within"), F.col("n").alias("m")), "within")
    return sized.where(F.col("matched") == F.least("n", "m")).select("edge_id", "within").distinct()


def rule_is_primary(state: State, chosen: DataFrame, coincident: DataFrame) -> State:
    """ASG-6. Claims of non-primary edges that coincide with a primary edge lose, and all sections chosen for such edges
    are knaves, disputed or not."""
    edges = coincident.select("edge_id").distinct()
    return replace(state, claims=state.claims.join(edges, "edge_id", "left_anti").select(*CLAIM), knaves=add_knaves(state.knaves, rounded(chosen).join(edges, "edge_id", "left_semi")))


def boundary_only_refs(chosen: DataFrame, last: DataFrame) -> DataFrame:
    """(edge_id, ref_id) chosen only where the edge ends a path, though it lies inside another path."""
    at = chosen.join(last.select("path_id", "last_idx"), "path_id").withColumn("inner", (F.col("path_edge_idx") != 0) & (F.col("path_edge_idx") != F.col("last_idx")))
    inner = at.where("inner")
    elsewhere = inner.groupBy("edge_id").agg(F.min("path_id").alias("lo"), F.max("path_id").alias("hi"))
    outer = at.where("NOT inner").join(elsewhere, "edge_id").where("path_id <> lo OR path_id <> hi").select("edge_id", "ref_id")
    return outer.distinct().join(inner.select("edge_id", "ref_id").distinct(), ["edge_id", "ref_id"], "left_anti")


def multi_path_edges(path_edges: DataFrame) -> DataFrame:
    """AGG-9. Edges on more than one path."""
    return path_edges.groupBy("edge_id").agg(F.count_distinct("path_id").alias("n_paths")).where("n_paths > 1")


def candidate_losers(chosen: DataFrame, path_edges: DataFrame, candidates: DataFrame) -> DataFrame:
    """AGG-10. (path_id, edge_id, ref_id) not among the edge's candidates, where another choice for the edge consists of candidates only."""
    shared = chosen.join(multi_path_edges(path_edges).select("edge_id"), "edge_id", "left_semi")
    known = candidates.select("edge_id", "ref_id", F.lit(True).alias("known")).distinct()
    marked = shared.join(known, ["edge_id", "ref_id"], "left")
    complete = marked.groupBy("path_id", "edge_id").agg(F.bool_and(F.col("known").isNotNull()).alias("all")).where("all").select("edge_id").distinct()
    return marked.where("known IS NULL").select("path_id", "edge_id", "ref_id").distinct().join(complete, "edge_id", "left_semi")


def rule_multi_path(state: State, chosen: DataFrame, path_edges: DataFrame, candidates: DataFrame) -> State:
    """ASG-7. Among paths that share an edge: references chosen only at a boundary are knaves, and references
    that are no candidates lose to a path made of candidates."""
    suspects = boundary_only_refs(chosen, path_last_edge(path_edges))
    sections = rounded(chosen)
    first = sections.join(suspects, ["edge_id", "ref_id"], "left_semi")
    losers = candidate_losers(chosen, path_edges, candidates)
    second = sections.join(losers.select("edge_id", "ref_id").distinct(), ["edge_id", "ref_id"], "left_semi")
    left = state.claims.join(first.select("path_id", "edge_id").distinct(), ["path_id", "edge_id"], "left_anti").join(losers, ["path_id", "edge_id", "ref_id"], "left_anti")
    return replace(state, claims=left.select(*CLAIM), knaves=add_knaves(state.knaves, first.unionByName(second)))


def rule_same_edge(claims: DataFrame) -> DataFrame:
    """ASG-8, WIN-2. One claim for each (dispute, edge): the earliest on its path."""
    order = Window.partitionBy("ref_id", "edge_id").orderBy("path_edge_idx", "path_id", F.desc("is_forward"), "match_idx")
    return claims.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").select(*CLAIM)


def rule_unidirectional(state: State, preferred: DataFrame) -> State:
    """ASG-9. Claims against the preferred direction of a one-way edge lose. ``preferred`` is
    :func:`strandweave.operators.coverage.preferred_direction`."""
    sure = preferred.where("deviance_sufficient AND distance_sufficient").select("path_id", "edge_id", (~F.col("forward_preferred")).cast("int").alias("is_forward")).distinct()
    keys = ["path_id", "edge_id", "is_forward"]
    losers = state.claims.join(sure, keys, "left_semi")
    return replace(state, claims=state.claims.join(sure, keys, "left_anti").select(*CLAIM), knaves=add_knaves(state.knaves, losers))


def rule_trimmable(claims: DataFrame, trim: DataFrame, compat: bool = False) -> DataFrame:
    """ASG-10. A single path with untrimmable claims wins its dispute; then untrimmable claims beat the fully
    trimmable ones they overlap. ``compat``: every path with untrimmable claims in one direction drives out all
    others, as the original statement reads, so that two such paths empty the dispute."""
    marked = claims.join(trim, ["path_id", "path_edge_idx", "is_forward", "match_idx"], "left")
    fixed = (F.col("start_trimmable") == 0) & (F.col("end_trimmable") == 0)
    sole = marked.where(fixed).groupBy("ref_id", "path_id").agg(F.count_distinct("is_forward").alias("ways")).where("ways = 1")
    winners = sole.groupBy("ref_id").agg(F.count("*").alias("n"), F.min("path_id").alias("winner"))
    if not compat:
        winners = winners.where("n = 1")
    left = marked.join(winners, "ref_id", "left").where("n IS NULL OR (n = 1 AND path_id = winner)")
    loose, firm = left.where((F.col("start_trimmable") == 1) & (F.col("end_trimmable") == 1)), left.where(fixed)
    beaten = overlapping(loose.select(*CLAIM), firm).select("ref_id", "path_id", "path_edge_idx", "edge_id").distinct()
    return left.join(beaten, ["ref_id", "path_id", "path_edge_idx", "edge_id"], "left_anti").select(*CLAIM)


def max_claim(claims: DataFrame) -> DataFrame:
    """AGG-12. The longest claim of each dispute."""
    return claims.groupBy("ref_id").agg(F.max(F.round(F.col("section_end") - F.col("section_start"), 4)).alias("longest"))


def rule_epsilon(claims: DataFrame, share: float = 0.1) -> DataFrame:
    """ASG-11. A path with a claim under ``share`` of its dispute's longest leaves that dispute."""
    length = F.round(F.col("section_end") - F.col("section_start"), 4)
    short = claims.join(max_claim(claims), "ref_id").where(length < F.round(F.col("longest") * share, 6)).select("ref_id", "path_id").distinct()
    return claims.join(short, ["ref_id", "path_id"], "left_anti").select(*CLAIM)


def rule_reverse_assigned(claims: DataFrame, meta: DataFrame, assigned: DataFrame, compat: bool = False) -> DataFrame:
    """ASG-12. A dispute's single edge whose opposite direction is already assigned to it wins; the other claimants go.

    ``compat`` lets such a dispute clear the claimants of every dispute, as the original statement does.
    """
    sure = reverse_section_join(claims, meta, assigned).select("ref_id", "edge_id").distinct()
    one = sure.groupBy("ref_id").agg(F.count("*").alias("n"), F.min("edge_id").alias("winner")).where("n = 1").select("ref_id", "winner")
    if compat:
        keep = one.select("ref_id", F.col("winner").alias("edge_id"))
        return claims.join(keep, ["ref_id", "edge_id"], "left_semi").select(*CLAIM) if not one.isEmpty() else claims
    return claims.join(one, "ref_id", "left").where("winner IS NULL OR winner = edge_id").select(*CLAIM)


def path_class_share(path_edges: DataFrame, assigned: DataFrame, refs: DataFrame) -> DataFrame:
    """AGG-11. Kilometres of each road class assigned to a path, and their share of the path."""
    km = F.round(F.col("section_end") - F.col("section_start"), 4)
    sums = path_edges.select("path_id", "edge_id").distinct().join(assigned, "edge_id").join(refs.select("ref_id", "road_class"), "ref_id").groupBy("path_id", "road_class").agg(F.round(F.sum(km), 4).alias("class_km"))
    whole = F.round(F.sum("class_km").over(Window.partitionBy("path_id")), 4)
    return sums.withColumn("path_km", whole).withColumn("class_share", F.round(F.col("class_km") / F.col("path_km") + 1e-9, 4))


def rule_road_class(state: State, chosen: DataFrame, shares: DataFrame, refs: DataFrame, trim: DataFrame, compat: bool = False) -> State:
    """ASG-13. A class under 3 % and 10 m of its path, on fully trimmable matches, is a knave, and the claims it
    overlaps go: those of its own reference, or with ``compat`` of any reference of its edge and direction."""
    rare = shares.where("class_share < 0.03 AND class_km < 0.01").select("path_id", "road_class")
    loose = rounded(chosen).join(refs.select("ref_id", "road_class"), "ref_id").join(rare, ["path_id", "road_class"]).join(trim.where("start_trimmable = 1 AND end_trimmable = 1"), ["path_id", "path_edge_idx", "is_forward", "match_idx"])
    knaves = add_knaves(state.knaves, loose)
    a, b = state.claims.alias("a"), knaves.alias("b")
    test = (F.col("a.edge_id") == F.col("b.edge_id")) & (F.col("a.is_forward") == F.col("b.is_forward")) & _touching("a", "b")
    if not compat:
        test = test & (F.col("a.ref_id") == F.col("b.ref_id"))
    return replace(state, claims=a.join(b, test, "left_anti"), knaves=knaves)


def assigned_matches(undisputed: DataFrame, awards: DataFrame, knaves: DataFrame, strict: bool = False) -> DataFrame:
    """ASG-15. Undisputed and awarded sections without those that overlap a knave of their edge, consolidated."""
    both = undisputed.select(*SECTION).union(awards.select(*SECTION)).distinct()
    a, b = both.alias("a"), knaves.alias("b")
    test = (F.col("a.ref_id") == F.col("b.ref_id")) & (F.col("a.edge_id") == F.col("b.edge_id")) & (F.col("a.is_forward") == F.col("b.is_forward")) & _touching("a", "b")
    return consolidate_sections(a.join(b, test, "left_anti"), strict)


def resolve(chosen: DataFrame, path_edges: DataFrame, candidates: DataFrame, preferred: DataFrame, refs: DataFrame, meta: DataFrame, coincident: DataFrame | None = None, centerline: bool = False) -> State:
    """ASG-14. The rules in fixed order, settling after each, until a round leaves the number of claims unchanged.

    ``coincident`` (edge_id) are the edges of :func:`rule_is_primary`. Claims only ever go, so the rules that look at a
    claim alone (primary, shared edges, direction) act in the first round and the others where a dispute changed.
    """
    last = path_last_edge(path_edges)
    trim = cut(trimmability(chosen, last).distinct(), "trim")
    claims = cut(find_disputes(chosen), "claims")
    run, undisputed = Disputes(claims), cut(undisputed_claims(chosen, claims), "undisputed")

    def once(rule: Callable[[State], State]) -> None:
        """A rule that looks at all claims and names knaves."""
        state = run.state()
        new = rule(state)
        run.knaves.add(cut(new.knaves.join(state.knaves, SECTION, "left_anti"), "knaves"))
        run.judge(None, lambda rows: rows.join(new.claims.select(*CLAIM), CLAIM, "left_semi"))

    if coincident is not None and not centerline:
        once(lambda s: rule_is_primary(s, chosen, coincident))
    before, first = claims.count(), True
    while True:  # each round but the last takes claims away
        if first and not centerline:
            once(lambda s: rule_multi_path(s, chosen, path_edges, candidates))
        run.judge("same_edge", rule_same_edge)
        if first:
            once(lambda s: rule_unidirectional(s, preferred))
        run.judge("trimmable", lambda rows: rule_trimmable(rows, trim))
        run.judge("epsilon", rule_epsilon)
        if run.n == before:
            return run.state()
        before, first = run.n, False
        if centerline:
            awards = run.state().awards
            run.judge(None, lambda rows: rule_reverse_assigned(rows, meta, awards))
        shares = cut(path_class_share(path_edges, assigned_matches(undisputed, run.state().awards, run.state().knaves), refs), "shares")
        once(lambda s: rule_road_class(s, chosen, shares, refs, trim))


def backfill_candidates(candidates: DataFrame, chosen: DataFrame, undisputed: DataFrame, awards: DataFrame, claims: DataFrame, least_km: float = 0.003) -> DataFrame:
    """ASG-16. Candidate sections over ``least_km`` of edges without any claim, free of everything claimed or assigned."""
    rest = candidates.join(chosen.select("edge_id").distinct(), "edge_id", "left_anti").where(F.round(F.col("section_end") - F.col("section_start"), 4) > least_km)
    for taken in (undisputed, awards, claims):
        rest = overlap_anti(rest, taken.select("ref_id", "section_start", "section_end"))
    return rest


def sliced(sections: DataFrame, ref_points: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-18, ASG-17, SNP-3. Sections with ``coords``, their part of the reference's line. ``keys`` name a section; ones
    of no length on the line have none."""
    want = sections.select(F.col("ref_id").alias("line_id"), F.concat_ws(":", *keys).alias("section_id"), F.col("section_start").alias("from_km"), F.col("section_end").alias("to_km"))
    part = line_slice(ref_points, want).groupBy("section_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pt_idx", "x", "y"))), lambda p: F.struct(p["x"].alias("lon"), p["y"].alias("lat"))).alias("coords"))
    return sections.withColumn("section_id", F.concat_ws(":", *keys)).join(part, "section_id", "left").drop("section_id")


def list_assigned(assigned: DataFrame, edges: DataFrame, ref_points: DataFrame) -> DataFrame:
    """ASG-17. Assigned sections with their map id and line."""
    return sliced(assigned.join(edges.select("edge_id", "target_map_id"), "edge_id"), ref_points, ["ref_id", "edge_id", "is_forward", "section_start"])


def list_disputed(claims: DataFrame, edges: DataFrame, ref_points: DataFrame) -> DataFrame:
    """ASG-17. Disputed claims with their map id and line."""
    return sliced(claims.join(edges.select("edge_id", "target_map_id"), "edge_id"), ref_points, CLAIM)


def list_undisputed(undisputed: DataFrame, edges: DataFrame, ref_points: DataFrame) -> DataFrame:
    """ASG-17. Claims that are in no dispute, likewise."""
    return list_disputed(undisputed, edges, ref_points)


def list_unmatched(edges: DataFrame, assigned: DataFrame) -> DataFrame:
    """ASG-17. Edges without any assigned section."""
    return edges.join(assigned.select("edge_id").distinct(), "edge_id", "left_anti")


def dispute_report(claims: DataFrame, trim: DataFrame) -> DataFrame:
    """ASG-18. Per dispute its extent and its claimants with their trimmability."""
    row = F.struct("section_start", "section_end", "path_id", "path_edge_idx", "edge_id", "is_forward", "match_idx", "start_trimmable", "end_trimmable")
    marked = claims.join(trim, ["path_id", "path_edge_idx", "is_forward", "match_idx"], "left")
    return marked.groupBy("ref_id").agg(F.min("section_start").alias("disputed_start"), F.max("section_end").alias("disputed_end"), F.sort_array(F.collect_list(row)).alias("claimants"))


def reverse_dir_candidates(claims: DataFrame, meta: DataFrame, assigned: DataFrame) -> DataFrame:
    """ASG-19. Open claims whose opposite direction is assigned to the same edge."""
    return reverse_section_join(claims, meta, assigned).select(*CLAIM, "opposite_ref_id").distinct()
