"""Geometry over vertex tables (line_id, pt_idx, x, y): degrees, with great-circle lengths in km.

Each operator is windows and joins on the line; none brings the vertices of all lines together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.plans.cut import cut

EARTH_KM = 6371.0088
RAD = math.pi / 180


def haversine(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Great-circle distance in km."""
    a = F.pow(F.sin((y2 - y1) * RAD / 2), 2) + F.cos(y1 * RAD) * F.cos(y2 * RAD) * F.pow(F.sin((x2 - x1) * RAD / 2), 2)
    return F.when(a.isNotNull(), F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


def bearing(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Initial bearing in degrees, -180 to 180, north 0. Along one meridian beyond a pole it is -180, as the cosine is negative
    there; ``atan2`` takes no notice of the sign of a zero."""
    dx = (x2 - x1) * RAD
    found = F.atan2(F.sin(dx) * F.cos(y2 * RAD), F.cos(y1 * RAD) * F.sin(y2 * RAD) - F.sin(y1 * RAD) * F.cos(y2 * RAD) * F.cos(dx)) / RAD
    return F.when((dx == 0) & (F.cos(y2 * RAD) < 0) & (found > 0), -found).otherwise(found)


def _line() -> Window:
    return Window.partitionBy("line_id").orderBy("pt_idx")


def measured(v: DataFrame) -> DataFrame:
    """GEO-1. Vertices with ``at_km``, the distance along the line."""
    step = haversine(F.lag("x").over(_line()), F.lag("y").over(_line()), F.col("x"), F.col("y"))
    return v.withColumn("step_km", F.coalesce(step, F.lit(0.0))).withColumn("at_km", F.sum("step_km").over(_line().rowsBetween(Window.unboundedPreceding, 0))).drop("step_km")


def line_lengths(v: DataFrame) -> DataFrame:
    """GEO-1. (line_id, n_points, length_km)."""
    return measured(v).groupBy("line_id").agg(F.count("*").alias("n_points"), F.max("at_km").alias("length_km"))


def clean_vertices(v: DataFrame, digits: int = 6) -> DataFrame:
    """GEO-2. Rounded vertices without immediate repeats, numbered anew."""
    r = v.withColumns({"x": F.round("x", digits) + 0.0, "y": F.round("y", digits) + 0.0})
    moved = F.coalesce((F.col("x") != F.lag("x").over(_line())) | (F.col("y") != F.lag("y").over(_line())), F.lit(True))
    return r.withColumn("__moved", moved).where("__moved").withColumn("pt_idx", F.row_number().over(_line()) - 1).drop("__moved")


def reverse_lines(v: DataFrame) -> DataFrame:
    """GRF-11. Every line's vertices backwards."""
    return v.withColumn("pt_idx", F.max("pt_idx").over(Window.partitionBy("line_id")) - F.col("pt_idx"))


def line_ends(v: DataFrame) -> DataFrame:
    """(line_id, x1, y1, x2, y2): first and last vertices."""
    first, last = F.min_by(F.struct("x", "y"), "pt_idx"), F.max_by(F.struct("x", "y"), "pt_idx")
    return v.groupBy("line_id").agg(first.alias("a"), last.alias("b")).select("line_id", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


def bearings(v: DataFrame) -> DataFrame:
    """GEO-3. (line_id, bearing) between end points; null for closed lines."""
    closed = (F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))
    return line_ends(v).select("line_id", F.when(closed, None).otherwise(bearing(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))).alias("bearing"))


def line_segments(v: DataFrame) -> DataFrame:
    """(line_id, seg_idx, x1, y1, x2, y2, from_km, to_km)."""
    m = measured(v)
    nxt = lambda c: F.lead(c).over(_line())
    return m.select("line_id", F.col("pt_idx").alias("seg_idx"), F.col("x").alias("x1"), F.col("y").alias("y1"), nxt("x").alias("x2"), nxt("y").alias("y2"), F.col("at_km").alias("from_km"), nxt("at_km").alias("to_km")).where("x2 IS NOT NULL")


def snapped(s: DataFrame) -> DataFrame:
    """Rows of a point (px, py) and a segment with t along the segment, the distance, and the distance along the line. Planar
    around the point."""
    k = F.cos(F.col("py") * RAD)
    dx, dy = (F.col("x2") - F.col("x1")) * k, F.col("y2") - F.col("y1")
    px, py = (F.col("px") - F.col("x1")) * k, F.col("py") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(px * dx + py * dy, dx * dx + dy * dy), F.lit(0.0))))
    s = s.withColumn("t", t)
    near = haversine(F.col("px"), F.col("py"), F.col("x1") + F.col("t") * (F.col("x2") - F.col("x1")), F.col("y1") + F.col("t") * (F.col("y2") - F.col("y1")))
    return s.withColumns({"dist_km": near, "along_km": F.col("from_km") + F.col("t") * (F.col("to_km") - F.col("from_km"))})


def snaps(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """Every (point, segment) of a pair's line: pairs (point_id, line_id, px, py) x segments, as :func:`snapped` has them."""
    return snapped(pairs.join(line_segments(v), "line_id"))


def nearest_snaps(met: DataFrame) -> DataFrame:
    """The nearest of the snaps of each point and line, earlier along the line on ties."""
    best = F.min_by(F.struct("dist_km", "along_km", "seg_idx"), F.struct(F.round("dist_km", 9), F.round("along_km", 9), "seg_idx"))
    return met.groupBy("point_id", "line_id").agg(best.alias("__b")).select("point_id", "line_id", "__b.*")


def nearest_on_line(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """GEO-4, SRT-4. The nearest snap of each point, earlier along the line on ties."""
    return nearest_snaps(snaps(pairs, v))


def points_along(v: DataFrame, distances: DataFrame) -> DataFrame:
    """GEO-5. Points at (line_id, d_km), clamped to the line."""
    ends = line_lengths(v).select("line_id", "length_km")
    want = distances.join(ends, "line_id").withColumn("at", F.greatest(F.lit(0.0), F.least("d_km", "length_km")))
    s = line_segments(v)
    met = want.join(s, "line_id").where("at >= from_km AND (at < to_km OR (at = to_km AND to_km = length_km))")
    f = F.coalesce(F.try_divide(F.col("at") - F.col("from_km"), F.col("to_km") - F.col("from_km")), F.lit(0.0))
    placed = met.select("line_id", "d_km", "seg_idx", (F.col("x1") + f * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + f * (F.col("y2") - F.col("y1"))).alias("y"))
    return placed.groupBy("line_id", "d_km").agg(F.min_by(F.struct("x", "y"), "seg_idx").alias("__p")).select("line_id", "d_km", "__p.*")


def line_slice(v: DataFrame, sections: DataFrame) -> DataFrame:
    """GEO-6. (section_id, pt_idx, x, y): the vertices strictly inside (line_id, section_id, from_km, to_km) and its two end points."""
    want = sections.select("line_id", "section_id", "from_km", "to_km")
    inner = measured(v).join(want, "line_id").where("at_km > from_km AND at_km < to_km").select("section_id", F.col("at_km").alias("at"), "x", "y")
    ends = points_along(v, want.select("line_id", F.explode(F.array("from_km", "to_km")).alias("d_km")).distinct())
    tips = want.select("line_id", "section_id", F.explode(F.array("from_km", "to_km")).alias("d_km")).join(ends, ["line_id", "d_km"]).select("section_id", F.col("d_km").alias("at"), "x", "y")
    return inner.unionByName(tips).withColumn("pt_idx", F.row_number().over(Window.partitionBy("section_id").orderBy("at")) - 1).select("section_id", "pt_idx", "x", "y")


def _within(met: DataFrame, km: float) -> DataFrame:
    """``met`` with lo and hi: where, as shares of a's segment (x1, y1)-(x2, y2), it lies within ``km`` of b's segment (bx1,
    by1)-(bx2, by2); rows that do nowhere are left out.

    What lies within a distance of a segment is convex: a strip beside it and a disc at each end. So the shares are
    one interval, from the least to the largest that the three meet, each in closed form, in km on the plane at a's start.
    """
    c, ky = F.col, RAD * EARTH_KM
    plane = met.withColumn("kx", F.cos(c("y1") * RAD) * ky).withColumns({"dx": (c("x2") - c("x1")) * c("kx"), "dy": (c("y2") - c("y1")) * ky, "px": (c("bx1") - c("x1")) * c("kx"), "py": (c("by1") - c("y1")) * ky, "qx": (c("bx2") - c("x1")) * c("kx"), "qy": (c("by2") - c("y1")) * ky})
    sized = plane.withColumns({"ex": c("qx") - c("px"), "ey": c("qy") - c("py"), "length2": c("dx") * c("dx") + c("dy") * c("dy")}).where("length2 > 0").withColumn("far", F.sqrt(c("ex") * c("ex") + c("ey") * c("ey")))
    along = {f"{p}a": c("dx") * c(f"{p}x") + c("dy") * c(f"{p}y") for p in "pq"}
    beside = {"u": -(c("px") * c("ex") + c("py") * c("ey")) / c("far") / c("far"), "du": (c("dx") * c("ex") + c("dy") * c("ey")) / c("far") / c("far"), "w": -(c("px") * c("ey") - c("py") * c("ex")) / c("far"), "dw": (c("dx") * c("ey") - c("dy") * c("ex")) / c("far")}
    ready = sized.withColumns(along | {k: F.when(c("far") > 0, v) for k, v in beside.items()})
    roots = ready.withColumns({f"{p}r": c(f"{p}a") * c(f"{p}a") - c("length2") * (c(f"{p}x") * c(f"{p}x") + c(f"{p}y") * c(f"{p}y") - km * km) for p in "pq"})
    # written, as one expression of all this would be too large to compile
    roots = cut(roots.drop("ex", "ey", "px", "py", "qx", "qy", "dx", "dy", "kx"), "segments")
    limits = {}
    for name, low, high in (("u", 0.0, 1.0), ("w", -km, km)):
        one, two, still = (low - c(name)) / c(f"d{name}"), (high - c(name)) / c(f"d{name}"), F.abs(c(f"d{name}")) < 1e-12
        limits |= {f"{name}lo": F.when(still, F.when(c(name).between(low, high), -1e18)).otherwise(F.least(one, two)), f"{name}hi": F.when(still, F.when(c(name).between(low, high), 1e18)).otherwise(F.greatest(one, two))}
    both = cut(roots.withColumns(limits), "limits").withColumns({"slo": F.when(c("ulo").isNotNull() & c("wlo").isNotNull(), F.greatest("ulo", "wlo")), "shi": F.when(c("ulo").isNotNull() & c("wlo").isNotNull(), F.least("uhi", "whi"))})
    strip = c("slo") <= c("shi")
    at = lambda p, sign: F.when(c(f"{p}r") >= 0, (c(f"{p}a") + sign * F.sqrt(f"{p}r")) / c("length2"))
    found = both.withColumns({"lo": F.least(at("p", -1), at("q", -1), F.when(strip, c("slo"))), "hi": F.greatest(at("p", 1), at("q", 1), F.when(strip, c("shi")))})
    # greatest and least pass over nulls
    return found.where("lo IS NOT NULL").withColumns({"lo": F.greatest("lo", F.lit(0.0)), "hi": F.least("hi", F.lit(1.0))}).where("lo <= hi").select(*met.columns, "lo", "hi")


def overlap_within(pairs: DataFrame, a: DataFrame, b: DataFrame, km: float, least_km: float = 0.002) -> DataFrame:
    """GEO-8. (a_id, b_id, from_km, to_km): the stretches of line a within ``km`` of line b, exact on the plane at each of
    a's segments; shorter ones than ``least_km`` are left out. Segments whose boxes lie apart are not compared."""
    own = line_segments(a).withColumnRenamed("line_id", "a_id")
    other = line_segments(b).select(F.col("line_id").alias("b_id"), *[F.col(c).alias(f"b{c}") for c in ("x1", "y1", "x2", "y2")])
    up, side = km / (EARTH_KM * RAD) * 1.01, km / (EARTH_KM * RAD) * 1.01 / F.abs(F.cos(F.col("y1") * RAD))
    apart = lambda c, m: (F.least(f"{c}1", f"{c}2") - m > F.greatest(f"b{c}1", f"b{c}2")) | (F.least(f"b{c}1", f"b{c}2") - m > F.greatest(f"{c}1", f"{c}2"))
    met = pairs.select("a_id", "b_id").distinct().join(own, "a_id").join(other, "b_id").where(~apart("y", F.lit(up)) & ~apart("x", side))
    at = lambda share: F.col("from_km") + (F.col("to_km") - F.col("from_km")) * F.col(share)
    placed = _within(met, km).select("a_id", "b_id", at("lo").alias("lo"), at("hi").alias("hi"))
    order = Window.partitionBy("a_id", "b_id").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("lo") - reach > 1e-7, F.lit(True)).cast("int")
    runs = placed.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("a_id", "b_id", "run").agg(F.min("lo").alias("from_km"), F.max("hi").alias("to_km")).where(F.col("to_km") - F.col("from_km") >= least_km).drop("run")


def cospatiality(pairs: DataFrame, a: DataFrame, b: DataFrame, km: float, least_km: float = 0.002) -> DataFrame:
    """GEO-9. (a_id, b_id, side, kind, from_km, to_km): on each of the two lines the stretches shared with the other and the
    rest between, before and after them. A stretch that begins or ends within ``km`` of the line's end reaches it."""

    def sided(side: str, asked: DataFrame, line: DataFrame, other: DataFrame) -> DataFrame:
        found = overlap_within(asked, line, other, km, least_km).join(line_lengths(line).select(F.col("line_id").alias("a_id"), "length_km"), "a_id")
        shared = found.select("a_id", "b_id", "length_km", F.when(F.col("from_km") < km, 0.0).otherwise(F.col("from_km")).alias("from_km"), F.when(F.col("length_km") - F.col("to_km") < km, F.col("length_km")).otherwise(F.col("to_km")).alias("to_km"))
        order = Window.partitionBy("a_id", "b_id").orderBy("from_km")
        beside = shared.withColumns({"before": F.coalesce(F.lag("to_km").over(order), F.lit(0.0)), "last": F.lead("to_km").over(order).isNull()})
        gaps = F.array(F.struct(F.col("before").alias("from_km"), F.col("from_km").alias("to_km")), F.when(F.col("last"), F.struct(F.col("to_km").alias("from_km"), F.col("length_km").alias("to_km"))))
        rest = beside.select("a_id", "b_id", F.explode(gaps).alias("g")).where("g IS NOT NULL").select("a_id", "b_id", F.lit("rest").alias("kind"), "g.from_km", "g.to_km").where(F.col("to_km") - F.col("from_km") >= least_km)
        return shared.select("a_id", "b_id", F.lit("shared").alias("kind"), "from_km", "to_km").unionByName(rest).withColumn("side", F.lit(side))

    back = sided("b", pairs.select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id")), b, a)
    swapped = back.withColumnsRenamed({"a_id": "x_id", "b_id": "a_id"}).withColumnRenamed("x_id", "b_id")
    return sided("a", pairs, a, b).unionByName(swapped).select("a_id", "b_id", "side", "kind", "from_km", "to_km")


def sequentiality(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """GEO-10. From line a's end to line b's start: the lengths, the turn between their bearings, the gap and its bearing."""
    held = line_ends(v).join(line_lengths(v).select("line_id", "length_km"), "line_id")
    side = lambda p: held.select([F.col(c).alias(f"{p}_{c}") for c in held.columns])
    met = pairs.join(side("a"), F.col("a_id") == F.col("a_line_id")).join(side("b"), F.col("b_id") == F.col("b_line_id"))
    own = lambda p: bearing(F.col(f"{p}_x1"), F.col(f"{p}_y1"), F.col(f"{p}_x2"), F.col(f"{p}_y2"))
    turn = own("b") - own("a")
    gap = (F.col("a_x2"), F.col("a_y2"), F.col("b_x1"), F.col("b_y1"))
    return met.select("a_id", "b_id", F.col("a_length_km").alias("a_km"), F.col("b_length_km").alias("b_km"), F.when(turn > 180, turn - 360).when(turn < -180, turn + 360).otherwise(turn).alias("turn"), haversine(*gap).alias("gap_km"), bearing(*gap).alias("gap_bearing"))


def merge_if_adjacent(pairs: DataFrame, v: DataFrame, km: float = 0.002) -> DataFrame:
    """GEO-11. The order in which two lines join end to start within ``km``: 'ab', 'ba' or null, with gap and whether there is one."""
    ab = sequentiality(pairs, v).select("a_id", "b_id", F.col("gap_km").alias("ab"))
    ba = sequentiality(pairs.select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id")), v).select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id"), F.col("gap_km").alias("ba"))
    gap = F.least("ab", "ba")
    return ab.join(ba, ["a_id", "b_id"]).select("a_id", "b_id", F.when(gap <= km, F.when(F.col("ab") <= F.col("ba"), "ab").otherwise("ba")).alias("order"), gap.alias("gap_km"), (gap > 0).alias("has_gap"))


def curve_similarity(pairs: DataFrame, v: DataFrame, per_km: int = 50, most_turn: float = 0.1 * math.pi) -> DataFrame:
    """GEO-12. (a_id, b_id, n_points, turn, frechet, similarity) of two curves.

    Both are resampled to equal parts, with as many points as the one with more vertices has, but at most ``per_km`` points
    a km of the longer; moved to their centres and scaled to a root mean square distance of one from there. Curve a is
    then turned by the angle that fits it best to b (Procrustes), at most ``most_turn`` radians either way, or not at
    all if that is nearer. ``frechet`` is their discrete Frechet distance, ``similarity`` one minus it over the
    geometric mean of the scaled lengths by the root of two, at least 0. The table of the recurrence is one row at a time.
    """
    lens = line_lengths(v).select("line_id", "length_km", "n_points")
    side = lambda name: lens.select(F.col("line_id").alias(f"{name}_id"), F.col("length_km").alias(f"{name}_km"), F.col("n_points").alias(f"{name}_n"))
    wanted = F.least(F.greatest("a_n", "b_n").cast("long"), F.ceil(F.greatest("a_km", "b_km") * per_km))
    asked = pairs.select("a_id", "b_id").distinct().join(side("a"), "a_id").join(side("b"), "b_id").select("a_id", "b_id", F.greatest(wanted, F.lit(2).cast("long")).alias("n"))
    drawn = asked.select(F.explode(F.array(F.struct(F.col("a_id").alias("line_id"), "n"), F.struct(F.col("b_id").alias("line_id"), "n"))).alias("l")).select("l.*").distinct()
    d = drawn.join(lens, "line_id").select("line_id", "n", F.posexplode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.col("length_km") * i / (F.col("n") - 1))).alias("i", "d_km"))
    p = d.join(points_along(v, d.select("line_id", "d_km").distinct()), ["line_id", "d_km"])
    curve = p.groupBy("line_id", "n").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("c"))
    flat = curve.select("line_id", "n", F.transform("c", lambda q: F.struct((q["x"] * F.cos(F.element_at("c", 1)["y"] * RAD) * RAD * EARTH_KM).alias("x"), (q["y"] * RAD * EARTH_KM).alias("y"))).alias("c"))
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda acc, q: acc + f(q))
    middle = flat.withColumns({"mx": total("c", lambda q: q["x"]) / F.col("n"), "my": total("c", lambda q: q["y"]) / F.col("n")})
    centred = middle.select("line_id", "n", F.transform("c", lambda q: F.struct((q["x"] - F.col("mx")).alias("x"), (q["y"] - F.col("my")).alias("y"))).alias("c"))
    sized = centred.withColumn("size", F.sqrt(total("c", lambda q: q["x"] * q["x"] + q["y"] * q["y"]) / F.col("n")))
    one = lambda value: F.coalesce(F.try_divide(value, F.col("size")), F.lit(0.0))
    scaled = sized.select("line_id", "n", F.transform("c", lambda q: F.struct(one(q["x"]).alias("x"), one(q["y"]).alias("y"))).alias("c"))
    far = lambda p, q: F.sqrt(F.pow(p["x"] - q["x"], 2) + F.pow(p["y"] - q["y"], 2))
    way = F.aggregate(F.zip_with(F.slice("c", 2, F.size("c") - 1), F.slice("c", 1, F.size("c") - 1), far), F.lit(0.0), lambda acc, x: acc + x)
    home = scaled.withColumn("way", way)
    met = asked.join(home.select(F.col("line_id").alias("a_id"), "n", F.col("c").alias("ca"), F.col("way").alias("way_a")), ["a_id", "n"]).join(home.select(F.col("line_id").alias("b_id"), "n", F.col("c").alias("cb"), F.col("way").alias("way_b")), ["b_id", "n"])
    both = F.zip_with("ca", "cb", lambda p, q: F.struct((p["x"] * q["y"] - p["y"] * q["x"]).alias("cross"), (p["x"] * q["x"] + p["y"] * q["y"]).alias("dot")))
    fit = F.atan2(total(both, lambda z: z["cross"]), total(both, lambda z: z["dot"]))
    turned = met.withColumn("turn", F.explode(F.array_distinct(F.array(F.lit(0.0), F.greatest(F.lit(-most_turn), F.least(F.lit(most_turn), fit))))))
    spun = turned.withColumn("ca", F.transform("ca", lambda p: F.struct((p["x"] * F.cos("turn") - p["y"] * F.sin("turn")).alias("x"), (p["x"] * F.sin("turn") + p["y"] * F.cos("turn")).alias("y"))))
    huge = 1e18

    def row(prev: Column, p: Column) -> Column:
        start = F.struct(F.array().cast("array<double>").alias("out"), F.lit(huge).alias("left"), F.lit(0).alias("j"))

        def cell(acc: Column, q: Column) -> Column:
            j = acc["j"]
            up = F.coalesce(F.get(prev, j), F.lit(huge))
            diagonal = F.when(j > 0, F.coalesce(F.get(prev, j - 1), F.lit(huge))).otherwise(F.lit(huge))
            reach = F.least(up, diagonal, acc["left"])
            value = F.greatest(far(p, q), F.when((F.size(prev) == 0) & (j == 0), F.lit(0.0)).otherwise(reach))
            return F.struct(F.concat(acc["out"], F.array(value)).alias("out"), value.alias("left"), (j + 1).alias("j"))

        return F.aggregate("cb", start, cell, lambda acc: acc["out"])

    table = F.aggregate("ca", F.array().cast("array<double>"), row)
    judged = spun.select("a_id", "b_id", "n", "turn", "way_a", "way_b", F.element_at(table, -1).alias("frechet"))
    best = judged.groupBy("a_id", "b_id").agg(F.min_by(F.struct("n", "turn", "way_a", "way_b", "frechet"), F.struct("frechet", "turn")).alias("m")).select("a_id", "b_id", "m.*")
    return best.select("a_id", "b_id", F.col("n").cast("int").alias("n_points"), "turn", "frechet", F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide(F.col("frechet") * math.sqrt(2), F.sqrt(F.col("way_a") * F.col("way_b"))), F.lit(0.0))).alias("similarity"))


def similarity_stats(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """GEO-13. How far line a's vertices lie from line b: mean, deviation and nine quantiles, and the same of how far
    their distances along the two lines differ."""
    m = measured(v)
    points = pairs.join(m.withColumnRenamed("line_id", "a_id"), "a_id").select(F.struct("a_id", "b_id", "pt_idx", "at_km").alias("point_id"), F.col("b_id").alias("line_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    n = nearest_on_line(points, v).select("point_id.*", "dist_km", F.abs(F.col("along_km") - F.col("point_id.at_km")).alias("off_km"))
    nine = [i / 10 for i in range(1, 10)]
    stats = lambda c, p: (F.avg(c).alias(f"{p}_mean"), F.stddev_pop(c).alias(f"{p}_stddev"), F.percentile(c, F.array(*[F.lit(q) for q in nine])).alias(f"{p}_quantiles"))
    return n.groupBy("a_id", "b_id").agg(*stats("dist_km", "snap"), *stats("off_km", "along"))


def _monotone(pts, segs):
    """The snaps of ordered points to ordered segments with the least squared distance that never go back.

    A row of costs holds the best assignment that ends on each segment. Rows are kept every so many points, and the
    choices between two of them are worked out again on the way back, so memory is segments x the root of points.
    """
    import numpy as np
    import pandas as pd

    pts, segs = pts.sort_values("pt_no"), segs.sort_values("seg_idx")
    px, py = pts["px"].to_numpy(), pts["py"].to_numpy()
    x1, y1, x2, y2, from_km, to_km = (segs[c].to_numpy() for c in ("x1", "y1", "x2", "y2", "from_km", "to_km"))
    n, m = len(px), len(x1)
    if not m:
        return pd.DataFrame({c: [] for c in ("seq_id", "pt_no", "line_id", "seg_idx", "dist_km", "along_km")})

    def row(i: int):
        k = np.cos(py[i] * RAD)
        dx, dy, ax, ay = (x2 - x1) * k, y2 - y1, (px[i] - x1) * k, py[i] - y1
        size = dx * dx + dy * dy
        t = np.clip(np.divide(ax * dx + ay * dy, size, out=np.zeros(m), where=size > 0), 0, 1)
        qx, qy = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
        h = np.sin((qy - py[i]) * RAD / 2) ** 2 + np.cos(py[i] * RAD) * np.cos(qy * RAD) * np.sin((qx - px[i]) * RAD / 2) ** 2
        return 2 * EARTH_KM * np.arcsin(np.minimum(1.0, np.sqrt(h))), from_km + t * (to_km - from_km)

    def step(cost, before, i: int):
        """Costs of point i and the segment of the point before: an earlier one, or the same if it does not go back."""
        dist, along = row(i)
        own = np.where(before <= along + 1e-12, cost, np.inf)
        least, at = np.full(m, np.inf), np.zeros(m, np.int64)
        if m > 1:
            run = np.minimum.accumulate(cost[:-1])
            fresh = np.concatenate(([True], cost[1:-1] < run[:-1]))
            least[1:], at[1:] = run, np.maximum.accumulate(np.where(fresh, np.arange(m - 1), 0))
        stays = own < least
        return np.where(stays, own, least) + dist**2, np.where(stays, np.arange(m), at), along

    every = max(1, int(np.sqrt(n)))
    dist, along = row(0)
    cost, kept = dist**2, {}
    kept[0] = (cost, along)
    for i in range(1, n):
        cost, _, along = step(cost, along, i)
        if i % every == 0:
            kept[i] = (cost, along)
    j, chosen = int(np.argmin(cost)), [0] * n
    for first in sorted(kept, reverse=True):
        cost, along = kept[first]
        backs = {}
        for i in range(first + 1, min(n, first + every + 1)):
            cost, backs[i], along = step(cost, along, i)
        for i in sorted(backs, reverse=True):
            if i == n - 1 or i % every or first + every == i:
                chosen[i] = j
                j = int(backs[i][j])
    chosen[0] = j
    found = [(d[c], a[c]) for c, (d, a) in zip(chosen, map(row, range(n)), strict=True)]
    return pd.DataFrame({"seq_id": pts["seq_id"].to_numpy(), "pt_no": pts["pt_no"].to_numpy(), "line_id": pts["line_id"].to_numpy(), "seg_idx": segs["seg_idx"].to_numpy()[chosen], "dist_km": [d for d, _ in found], "along_km": [a for _, a in found]})


def snap_sequence(points: DataFrame, v: DataFrame) -> DataFrame:
    """GEO-14. Snaps of an ordered point sequence (seq_id, pt_no, line_id, px, py) that never go back along the line.

    Where the nearest snaps are already in order they stay. The rest take, over all segments of their line, the
    assignment of least squared distance without going back, by dynamic programming per sequence in an Arrow
    batch, which holds the points, the segments and rows of the table, not all of it.
    """
    keyed = points.withColumn("point_id", F.struct("seq_id", "pt_no"))
    nearest = nearest_on_line(keyed.select("point_id", "line_id", "px", "py"), v).select("point_id.*", "line_id", "seg_idx", "dist_km", "along_km")
    order = Window.partitionBy("seq_id").orderBy("pt_no")
    back = nearest.withColumn("back", F.coalesce(F.col("along_km") < F.lag("along_km").over(order), F.lit(False))).groupBy("seq_id").agg(F.bool_or("back").alias("unordered"))
    good = nearest.join(back.where("NOT unordered").select("seq_id"), "seq_id", "left_semi").select(*nearest.columns)
    rest = points.join(back.where("unordered").select("seq_id"), "seq_id", "left_semi")
    asked = rest.select(F.col("seq_id").alias("of_seq"), F.col("line_id").alias("on_line")).distinct()
    lines = asked.join(line_segments(v), F.col("on_line") == F.col("line_id")).drop("line_id", "on_line")
    solved = rest.groupBy("seq_id").cogroup(lines.groupBy("of_seq")).applyInPandas(_monotone, nearest.schema)
    return good.unionByName(solved)


def split_by_bearing(v: DataFrame, degrees: float = 67.5) -> DataFrame:
    """GEO-15. Vertices with ``piece``: a new one begins where the bearing turns by more than ``degrees``."""
    turn_to = bearing(F.lag("x").over(_line()), F.lag("y").over(_line()), F.col("x"), F.col("y"))
    b = v.withColumn("__in", turn_to)
    out = F.lead("__in").over(_line())
    turn = F.abs(out - F.col("__in"))
    sharp = F.coalesce(F.least(turn, 360 - turn) > degrees, F.lit(False)).cast("int")
    t = b.withColumn("__sharp", sharp)
    return t.withColumn("piece", F.coalesce(F.sum("__sharp").over(_line().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__in", "__sharp")


#: Kilometres in one reported unit.
UNITS = {"km": 1.0, "m": 0.001, "mi": 1.609344, "ft": 0.0003048}


def infer_distance_unit(v: DataFrame) -> DataFrame:
    """GEO-16. (line_id, unit, deviation): of the units the one in which reported distances (column dist) differ least
    from the measured ones, as root mean square over the line's length."""
    m = measured(v)
    devs = [F.sqrt(F.avg(F.pow(F.col("dist") * k - F.col("at_km"), 2))).alias(u) for u, k in UNITS.items()]
    held = m.groupBy("line_id").agg(F.max("at_km").alias("line_km"), *devs)
    each = held.select("line_id", F.explode(F.array(*[F.struct(F.try_divide(u, "line_km").alias("deviation"), F.lit(i).alias("n"), F.lit(u).alias("unit")) for i, u in enumerate(UNITS)])).alias("e"))
    return each.groupBy("line_id").agg(F.min("e").alias("e")).select("line_id", "e.unit", "e.deviation")


def shape_lines(shapes: DataFrame) -> DataFrame:
    """GEO-17, UDF-3. Schedule shape points (shape_id, seq, lon, lat) as ordered, rounded, repeat-free vertices."""
    order = Window.partitionBy("shape_id").orderBy("seq")
    return clean_vertices(shapes.where("lon IS NOT NULL AND lat IS NOT NULL").select(F.col("shape_id").alias("line_id"), (F.row_number().over(order) - 1).alias("pt_idx"), F.col("lon").alias("x"), F.col("lat").alias("y")))


def sequence_relations(pairs: DataFrame) -> DataFrame:
    """GEO-20. For two id arrays: is every id of a in b, does a occur in b in order, does it occur without gaps."""
    a, b = F.col("a"), F.col("b")
    at = F.aggregate("a", F.lit(0), lambda pos, x: F.when(pos < 0, pos).otherwise(F.coalesce(F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(b), F.lit(1))), F.lit(None).cast("int"), lambda hit, j: F.when(hit.isNull() & (j > pos) & (F.get(b, j - 1) == x), j).otherwise(hit)), F.lit(-1))))
    spelt = lambda c: F.concat(F.lit(","), F.array_join(c.cast("array<string>"), ","), F.lit(","))
    return pairs.select("a_id", "b_id", (F.size(F.array_except(a, b)) == 0).alias("is_subset"), (at >= 0).alias("is_subsequence"), spelt(b).contains(spelt(a)).alias("is_substring"))


def line_dissimilarity(pairs: DataFrame, v: DataFrame, km: float = 0.05) -> DataFrame:
    """GEO-21. Mean distance of the vertices of a, moved to b's start, from b, over b's length; doubled for vertices beyond ``km``."""
    e = line_ends(v)
    met = pairs.join(e.select(F.col("line_id").alias("a_id"), F.col("x1").alias("ax"), F.col("y1").alias("ay")), "a_id").join(e.select(F.col("line_id").alias("b_id"), F.col("x1").alias("bx"), F.col("y1").alias("by")), "b_id")
    points = met.join(v.withColumnRenamed("line_id", "a_id"), "a_id").select(F.struct("a_id", "b_id", "pt_idx").alias("point_id"), F.col("b_id").alias("line_id"), (F.col("x") - F.col("ax") + F.col("bx")).alias("px"), (F.col("y") - F.col("ay") + F.col("by")).alias("py"))
    n = nearest_on_line(points, v).select("point_id.*", F.when(F.col("dist_km") > km, F.col("dist_km") * 2).otherwise(F.col("dist_km")).alias("d"))
    return n.groupBy("a_id", "b_id").agg(F.avg("d").alias("d")).join(line_lengths(v).select(F.col("line_id").alias("b_id"), "length_km"), "b_id").select("a_id", "b_id", F.try_divide("d", "length_km").alias("dissimilarity"))
