"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strandweave.plans.cut import cut, release


def _with_minimum(edges: DataFrame, lowest) -> DataFrame:
    """Each edge (u, v) with the minimum m of u's neighbours. The minimum is aggregated map-side and
    joined back, so a node with very many edges never has to sit in one task."""
    least = edges.groupBy("u").agg(lowest.alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_minimum(both, F.least(F.min("v"), F.col("u")))
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_minimum(down, F.min("v"))
    return (
        linked.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v")
        .where("u <> v")
        .distinct()
    )


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node with an edge to another; component is its smallest reachable node.

    Edges are undirected, may repeat or be loops; rows with a null end are no edges. Empty input gives no
    rows. Each round is one pair of star steps, written to the shared folder; the loop ends when a round
    leaves the edges unchanged (compared by count and xor of row hashes).
    """
    state = cut(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = tuple(state.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if mark == seen or not mark[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        wide = cut(_large_star(state), "large")
        narrow = cut(_small_star(wide), "small")
        release(state, wide)
        state = narrow
