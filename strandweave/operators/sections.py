"""Linear-referenced sections: half-open intervals [section_start, section_end) in km on a reference.

Interval joins are equi-joins on the reference and on interval bins with the interval test as a residual, which
spreads a reference that holds very many sections over many tasks and lets a section meet only those near it.
Sweeps along a reference work in the same bins: each is ordered by itself, and what a bin needs from the others
(their last point, how far they reach, how many they hold) is carried over one row a bin, so that no task
orders more than a bin, and none sees more rows of a reference than it has bins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Cut points nearer than this to the one before are dropped (km).
CUT_KM = 0.0001
#: One-sided tolerance within which pieces count as contiguous (km).
TOUCH_KM = 1e-5
#: Width of the bins that overlap joins deal sections to (km).
BIN_KM = 0.25


def overlaps(a: DataFrame, b: DataFrame) -> Column:
    return (a["section_start"] < b["section_end"]) & (b["section_start"] < a["section_end"])


def overlap_join(a: DataFrame, b: DataFrame, on: str = "ref_id", how: str = "inner", differs: str | None = None) -> DataFrame:
    """JN-1. Pairs of sections of one reference that overlap; ``differs``: a column that must be unequal."""
    test = (a[on] == b[on]) & overlaps(a, b)
    if differs:
        test = test & (a[differs] != b[differs])
    return a.join(b, test, how)


def binned(df: DataFrame, width: float, start: str = "section_start", end: str = "section_end") -> DataFrame:
    """Rows dealt to ``__bin``, the stretches of ``width`` km that they touch."""
    return df.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))


def overlapping(a: DataFrame, b: DataFrame, on: str = "ref_id", differs: str | None = None, width: float = BIN_KM) -> DataFrame:
    """JN-1 as a semi-join: the distinct rows of ``a`` that overlap a row of ``b``. Both sides are dealt to bins, so a
    reference with very many sections is many keys and its rows meet only those near them."""
    columns = ["section_start", "section_end", *([differs] if differs else [])]
    left, right = binned(a, width).alias("a"), binned(b.select(on, *columns).distinct(), width).alias("b")
    test = (F.col(f"a.{on}") == F.col(f"b.{on}")) & (F.col("a.__bin") == F.col("b.__bin")) & (F.col("a.section_start") < F.col("b.section_end")) & (F.col("b.section_start") < F.col("a.section_end"))
    if differs:
        test = test & (F.col(f"a.{differs}") != F.col(f"b.{differs}"))
    return left.join(right, test, "left_semi").drop("__bin").distinct()


def overlap_anti(a: DataFrame, b: DataFrame, on: str = "ref_id", differs: str | None = None) -> DataFrame:
    """JN-2. Sections without an overlapping partner."""
    met = overlapping(a, b, on, differs)
    held = met.select([F.col(c).alias(f"__{c}") for c in a.columns])
    same = [a[c].eqNullSafe(held[f"__{c}"]) for c in a.columns]
    return a.join(held, reduce(lambda x, y: x & y, same), "left_anti")


def binned_overlap_join(a: DataFrame, b: DataFrame, width: float, on: str = "ref_id") -> DataFrame:
    """JN-1 for hot references: both sides are dealt to bins of ``width`` km and a pair is made only in the
    bin where the later of its starts lies, so no pair comes twice. Columns of ``b`` get the prefix ``b_``."""
    right = binned(b.select([F.col(c).alias(f"b_{c}") for c in b.columns]), width, "b_section_start", "b_section_end")
    left = binned(a, width)
    met = left.join(right, (left[on] == right[f"b_{on}"]) & (left["__bin"] == right["__bin"]) & (left["section_start"] < right["b_section_end"]) & (right["b_section_start"] < left["section_end"]))
    return met.where(left["__bin"] == F.floor(F.greatest("section_start", "b_section_start") / width)).drop("__bin")


def _carried(bins: DataFrame, keys: list[str], **columns: Column) -> DataFrame:
    """What each bin gets from the bins before or after it. ``columns`` are windows over ``bins``, a row a bin."""
    return bins.select(*keys, "__bin", *[c.alias(name) for name, c in columns.items()])


def sweep(df: DataFrame, keys: list[str], at: str, width: float = BIN_KM) -> DataFrame:
    """``df`` with __prev and __next, the neighbours in the order of ``at`` (distinct within ``keys``), __number from 0 and
    __total."""
    b = df.withColumn("__bin", F.floor(F.col(at) / width))
    inner, outer = Window.partitionBy(*keys, "__bin").orderBy(at), Window.partitionBy(*keys).orderBy("__bin")
    bins = b.groupBy(*keys, "__bin").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))
    ahead = F.coalesce(F.sum("n").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = _carried(bins, keys, __before=F.lag("last").over(outer), __after=F.lead("first").over(outer), __ahead=ahead, __total=F.sum("n").over(Window.partitionBy(*keys)))
    own = b.withColumns({"__p": F.lag(at).over(inner), "__n": F.lead(at).over(inner), "__i": F.row_number().over(inner) - 1}).join(carry, [*keys, "__bin"])
    return own.select(*df.columns, F.coalesce("__p", "__before").alias("__prev"), F.coalesce("__n", "__after").alias("__next"), (F.col("__i") + F.col("__ahead")).alias("__number"), "__total")


def _islands(df: DataFrame, keys: list[str], touch: float, width: float = BIN_KM) -> DataFrame:
    """(keys, section_start, section_end): unions of sections that touch within ``touch``."""
    b = df.select(*keys, "section_start", "section_end").distinct().withColumn("__bin", F.floor(F.col("section_start") / width))
    inner, outer = Window.partitionBy(*keys, "__bin").orderBy("section_start", "section_end"), Window.partitionBy(*keys).orderBy("__bin")
    before = lambda c: F.max(c).over(outer.rowsBetween(Window.unboundedPreceding, -1))
    reaches = _carried(b.groupBy(*keys, "__bin").agg(F.max("section_end").alias("reach")), keys, __reach=before("reach"))
    reach = F.greatest(F.max("section_end").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.col("__reach"))
    heads = b.join(reaches, [*keys, "__bin"]).withColumn("__head", F.when(F.coalesce(F.col("section_start") - reach > touch, F.lit(True)), F.col("section_start")))
    starts = _carried(heads.groupBy(*keys, "__bin").agg(F.max("__head").alias("head")), keys, __start=before("head"))
    island = F.greatest(F.max("__head").over(inner.rowsBetween(Window.unboundedPreceding, 0)), F.col("__start"))
    return heads.join(starts, [*keys, "__bin"]).withColumn("__island", island).groupBy(*keys, "__island").agg(F.min("section_start").alias("section_start"), F.max("section_end").alias("section_end")).drop("__island")


def reverse_section_join(claims: DataFrame, meta: DataFrame, assigned: DataFrame) -> DataFrame:
    """JN-4. Claims with the assigned section of their edge on the opposite reference that mirrors them.

    ``meta`` is :func:`strandweave.operators.projections.ref_metadata`.
    """
    c = claims.join(meta.select("ref_id", "opposite_ref_id", "length_km"), "ref_id")
    o = assigned.select(F.col("ref_id").alias("opposite_ref_id"), "edge_id", F.col("section_start").alias("o_start"), F.col("section_end").alias("o_end"))
    mirrored = (F.col("section_start") < F.round(F.col("length_km") - F.col("o_start"), 4)) & (F.round(F.col("length_km") - F.col("o_end"), 4) < F.col("section_end"))
    return c.join(o, ["opposite_ref_id", "edge_id"]).where(mirrored)


def consolidate_sections(df: DataFrame, strict: bool = False) -> DataFrame:
    """SEC-1, AGG-28. One section per (reference, edge, direction), then the largest of each (reference, edge).

    The default test of contiguity is one-sided, so every earlier piece joins a later one and the union is
    the hull; overlapping results of one edge that are equally long but differ drop each other. ``strict``
    keeps gaps: pieces join only if they touch, and of equal ones the earlier start stays.
    """
    keys = ["ref_id", "edge_id", "is_forward"]
    if strict:
        merged = _islands(df, keys, TOUCH_KM)
    else:
        merged = df.groupBy(*keys).agg(F.min("section_start").alias("section_start"), F.max("section_end").alias("section_end"))
    a, b = merged.alias("a"), merged.alias("b")
    length = lambda t: F.round(F.col(f"{t}.section_end") - F.col(f"{t}.section_start"), 9)
    other = (F.col("a.is_forward") != F.col("b.is_forward")) | (F.col("a.section_start") != F.col("b.section_start")) | (F.col("a.section_end") != F.col("b.section_end"))
    if strict:
        ranked = lambda t: F.struct(-length(t), F.col(f"{t}.section_start"), F.col(f"{t}.section_end"), -F.col(f"{t}.is_forward"))
        beaten = ranked("b") < ranked("a")
    else:
        differs = (F.col("a.section_start") != F.col("b.section_start")) | (F.col("a.section_end") != F.col("b.section_end"))
        same_bounds = ~differs & (F.col("b.is_forward") > F.col("a.is_forward"))
        beaten = (differs & (length("a") <= length("b"))) | same_bounds
    met = (F.col("a.ref_id") == F.col("b.ref_id")) & (F.col("a.edge_id") == F.col("b.edge_id")) & (F.col("a.section_start") < F.col("b.section_end")) & (F.col("b.section_start") < F.col("a.section_end"))
    if not strict:  # two hulls an edge at most
        return a.join(b, met & other & beaten, "left_anti").select(*keys, "section_start", "section_end")
    columns = [*keys, "section_start", "section_end"]
    beaten_rows = binned(merged, BIN_KM).alias("a").join(binned(merged, BIN_KM).alias("b"), met & (F.col("a.__bin") == F.col("b.__bin")) & other & beaten, "left_semi").select(*columns)
    return merged.join(beaten_rows, columns, "left_anti").select(*columns)


def clamp_sections(df: DataFrame, refs: DataFrame) -> DataFrame:
    """SEC-4. Sections cut to [0, length]; pieces of at most 0.0001 km are dropped."""
    cols = df.columns
    held = df.join(refs.select("ref_id", "length_km"), "ref_id")
    return held.withColumns({"section_start": F.greatest("section_start", F.lit(0.0)), "section_end": F.least("section_end", "length_km")}).where(F.round(F.col("section_end") - F.col("section_start"), 9) > CUT_KM).select(*cols)


def partition_sections(refs: DataFrame, assigned: DataFrame) -> DataFrame:
    """SEC-2. (ref_id, part_idx, part_start, part_end): each reference cut at every assignment boundary.

    A cut point stays if it is over 0.0001 km after the point before it and not past the length; the last one
    becomes the length. The pieces tile [0, length].
    """
    bounds = F.array(F.struct(F.col("section_start").alias("at")), F.struct(F.col("section_end").alias("at")))
    inner = assigned.join(refs.select("ref_id", "length_km"), "ref_id").select("ref_id", "length_km", F.explode(bounds).alias("b")).select("ref_id", "length_km", "b.at")
    ends = refs.select("ref_id", "length_km", F.explode(F.array(F.lit(0.0), F.col("length_km"))).alias("at"))
    points = inner.unionByName(ends).where("at >= 0 AND at <= length_km").distinct()
    kept = sweep(points, ["ref_id"], "at").where(F.coalesce(F.round(F.col("at") - F.col("__prev"), 9) > CUT_KM, F.lit(True))).select(*points.columns)
    # the last point is no start, and a reference of almost no length keeps a single point and so has no piece
    pieces = sweep(kept, ["ref_id"], "at").where("__next IS NOT NULL")
    end = F.when(F.col("__number") == F.col("__total") - 2, F.col("length_km")).otherwise(F.col("__next"))
    return pieces.select("ref_id", F.col("__number").cast("int").alias("part_idx"), F.col("at").alias("part_start"), end.alias("part_end"))


def attach_assignments(parts: DataFrame, assigned: DataFrame, maps: list[str]) -> DataFrame:
    """SEC-3. The pieces with, for each map, the overlapping assignment that starts last.

    ``assigned``: ref_id, map, edge_id, is_forward, section_start, section_end.
    """
    near = binned_overlap_join(parts.withColumnsRenamed({"part_start": "section_start", "part_end": "section_end"}), assigned, BIN_KM)
    held = F.struct(*[F.col(f"b_{c}").alias(c) for c in ("edge_id", "is_forward", "section_start", "section_end")])
    order = F.struct("b_section_start", "b_section_end", "b_edge_id", "b_is_forward")
    best = near.groupBy("ref_id", "part_idx").agg(*[F.max_by(F.when(F.col("b_map") == m, held), F.when(F.col("b_map") == m, order)).alias(m) for m in maps])
    return parts.join(best, ["ref_id", "part_idx"], "left").select("ref_id", "part_idx", "part_start", "part_end", *maps)


def conflation_segments(refs: DataFrame, assigned: DataFrame, maps: list[str]) -> DataFrame:
    """SEC-5. All maps' sections clamped, references partitioned at them, assignments attached; the id is a hash of reference and start."""
    clamped = clamp_sections(assigned, refs)
    parts = partition_sections(refs, clamped)
    return attach_assignments(parts, clamped, maps).withColumn("segment_id", F.xxhash64("ref_id", "part_start"))


def split_epsilon_overlaps(claims: DataFrame, epsilon_km: float = 0.005) -> DataFrame:
    """SEC-11. Claims of different edges that overlap by at most ``epsilon_km`` meet at the overlap's middle. A claim meets
    those that begin in the bins, of twice that width, just before its end."""
    bin_ = lambda c: F.floor(F.col(c) / (2 * epsilon_km))
    a = claims.withColumn("__bin", F.explode(F.array(bin_("section_end"), bin_("section_end") - 1))).alias("a")
    b = claims.withColumn("__bin", bin_("section_start")).alias("b")
    met = a.join(b, (F.col("a.ref_id") == F.col("b.ref_id")) & (F.col("a.__bin") == F.col("b.__bin")) & (F.col("a.edge_id") != F.col("b.edge_id")) & (F.col("a.section_start") < F.col("b.section_start")) & (F.col("b.section_start") < F.col("a.section_end")) & (F.col("a.section_end") < F.col("b.section_end")))
    close = met.where(F.round(F.col("a.section_end") - F.col("b.section_start"), 9) <= epsilon_km)
    middle = F.round((F.col("a.section_end") + F.col("b.section_start")) / 2, 5)
    keys = ["ref_id", "edge_id", "is_forward", "section_start", "section_end"]
    first = close.select(*[F.col(f"a.{k}") for k in keys], F.lit(None).cast("double").alias("new_start"), middle.alias("new_end"))
    second = close.select(*[F.col(f"b.{k}") for k in keys], middle.alias("new_start"), F.lit(None).cast("double").alias("new_end"))
    return first.unionByName(second).groupBy(*keys).agg(F.max("new_start").alias("new_start"), F.min("new_end").alias("new_end")).select(
        *keys, F.coalesce("new_start", "section_start").alias("new_start"), F.coalesce("new_end", "section_end").alias("new_end")
    )
