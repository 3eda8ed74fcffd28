"""Embedding near-deduplication by sorted projection passes.

Exact copies are collapsed first. Each pass draws its own random hashes and concatenates ``HASHES`` of them to a
key: a hash is the number of the random direction, of ``DIRECTIONS``, with the largest projection, and its sign.
All vectors are sorted lexicographically by key and the global order is cut into cells of ``window`` rows; each
cell is compared with itself and the ``overlap`` rows after it. Pairs are verified by cosine in double precision;
a cell hands on a spanning forest of them. The union of all passes gives the components. Within a component, and
nowhere else, links are then counted exactly, block against block, so that a large group of near copies loses
none of its links to a window's bound; only counts leave a block, never pairs. A component of n distinct vectors
takes n x n / 2 cosines for that and meets n / ``block`` copies of each vector in the shuffle.

The number of passes follows the number of vectors. Two vectors at cosine 0.9 share a hash with probability 0.5
(measured, for 16 to 256 dimensions); to be about ``window`` rows apart among N they must share the bits that
split N rows to that, and the last hash counts whole. Among a million rows they met in a pass with probability
0.29 (measured), 0.875 a bit. Passes are as many as give two such vectors the probability ``recall`` of meeting in
one at least; those closer meet more often.

The sort is global but never in one task: Spark's range partitioning orders the rows, and a row's rank is its
place in its partition plus the sizes of the partitions before it.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing: each is a
component of its own. Vectors of different lengths never link. Equal vectors under different ids are linked
(cosine 1). A component is named by an id, so a row with a null id links with nothing either, has no component
and is not kept; a repeated id gives a row each. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strandweave.operators.components import connected_components
from strandweave.plans.cut import cut, release

THRESHOLD = 0.9
#: Random directions of a hash, which has two values for each, and hashes of a key.
DIRECTIONS, HASHES = 32, 10
#: Probability that vectors at cosine 0.9 agree in a bit of their keys, and the fewest passes.
AGREE, LEAST = 0.875, 6


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1)[:, None]  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def passes_for(rows: int, window: int, overlap: int, recall: float) -> int:
    """Passes that let a pair at the threshold meet with probability ``recall`` among so many rows."""
    reach = window / 2 + overlap  # ranks apart at which rows are still compared, on average
    met = AGREE ** math.log2(max(2.0, rows / reach))
    return max(LEAST, math.ceil(math.log(1 - recall) / math.log1p(-met)))


def _keys(first: int, last: int, seed: int):
    """Adds to (vid, n, embedding) the keys of passes ``first`` to ``last``, first hash most significant."""
    width = (2 * DIRECTIONS - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            keys = np.zeros((len(vectors), last - first), np.int64)
            lengths = np.array([len(v) for v in vectors])
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                unit = _unit([vectors[i] for i in at])
                for p in range(first, last):
                    if (p, n) not in planes:
                        planes[p, n] = np.random.default_rng([seed, p, n]).standard_normal((n, HASHES * DIRECTIONS))
                    along = (unit @ planes[p, n]).reshape(len(at), HASHES, DIRECTIONS)
                    best = np.abs(along).argmax(axis=2)
                    signs = np.take_along_axis(along, best[:, :, None], axis=2)[:, :, 0] > 0
                    values = (2 * best + signs).astype(np.int64)
                    keys[at, p - first] = (values << (width * np.arange(HASHES - 1, -1, -1, dtype=np.int64))).sum(axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, last - first, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["vid", "n", "keys"])

    return run


def _forest(near: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a boolean matrix with more columns than rows or as many; the rows are the first columns."""
    n, width = near.shape
    fresh, out = np.ones(width, bool), []
    for start in range(n):
        if not fresh[start]:
            continue
        fresh[start], todo = False, [start]
        while todo:
            i = todo.pop()
            found = np.flatnonzero((near[i] if i < n else np.concatenate((near[:, i], np.zeros(width - n, bool)))) & fresh)
            fresh[found] = False
            out += [(int(ids[i]), int(ids[j])) for j in found]
            todo += found.tolist()
    return out


def _cell_links(threshold: float):
    """Links between the rows of a cell, and between them and the next cell's."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for _, part in pdf.groupby(["pass", "n"]):
            part = part.sort_values(["next", "vid"])
            own = int((part["next"] == 0).sum())
            if own and len(part) > 1:
                unit = _unit(part["embedding"])
                out += _forest(unit[:own] @ unit.T >= threshold, part["vid"].to_numpy())
        return pd.DataFrame(out, columns=["src", "dst"], dtype="int64")

    return run


def _block_counts(threshold: float):
    """Copies linked to each row of a pair of blocks (i, j) of one component."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby("n"):
            unit, weight, side = _unit(part["embedding"]), part["copies"].to_numpy(), part["side"].to_numpy()
            first = side == 0
            vid = part["vid"].to_numpy()
            if pdf["i"].iloc[0] == pdf["j"].iloc[0]:
                near = unit @ unit.T >= threshold
                np.fill_diagonal(near, False)
                out.append(pd.DataFrame({"vid": vid, "n": near @ weight}))
            else:
                near = unit[first] @ unit[~first].T >= threshold
                out += [pd.DataFrame({"vid": vid[first], "n": near @ weight[~first]}), pd.DataFrame({"vid": vid[~first], "n": weight[first] @ near})]
        return pd.concat(out).astype("int64")

    return run


def _ranked(keyed: DataFrame, partitions: int) -> DataFrame:
    """Adds ``rank`` from 0 in the order of (pass, n, key, vid), over all rows."""
    order = ["pass", "n", "key", "vid"]
    placed = cut(keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "placed")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).count()
    # a row for each partition of the sort, so their number is bounded by it and not by the data
    before = sizes.select("part", (F.expr("sum(count) OVER (ORDER BY part)") - F.col("count")).alias("before"))
    return placed.join(F.broadcast(before), part == before["part"]).select("pass", "n", "vid", (F.col("before") + within).alias("rank"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = 0.995,
    passes: int | None = None,
    window: int = 2048,
    overlap: int = 512,
    at_once: int = 2,
    block: int = 1024,
    seed: int = 11,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest reachable id), kept.

    ``passes`` sorted orders, by default as many as ``recall`` asks for; ``at_once`` of them a job (each shuffles
    the vectors once, and ``overlap`` of ``window`` rows twice); ``block`` rows a side when the links within a
    component are counted.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(vector_col).alias("v")).schema["v"].dataType
    kept_type = "array<float>" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kept_type).alias("embedding"))
    sound = F.coalesce(F.expr("vec_id IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)"), F.lit(False))
    tagged = rows.select("vec_id", F.when(sound, F.col("embedding")).alias("embedding")).select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"), F.hash(F.reverse("embedding")).alias("h2"))
    # hashes of 96 bits stand for a vector where rows only have to find their class again
    classes = cut(
        tagged.where("embedding IS NOT NULL").groupBy("h1", "h2").agg(F.min("vec_id").alias("vid"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding")).withColumn("n", F.size("embedding")),
        "classes",
    )
    if passes is None:
        passes = passes_for(classes.count(), window, overlap, recall)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for first in range(0, passes, at_once):
        last = min(passes, first + at_once)
        keyed = classes.select("vid", "n", "embedding").mapInArrow(_keys(first, last, seed), "vid long, n int, keys array<long>")
        ranked = _ranked(keyed.select("vid", "n", F.posexplode("keys").alias("pass", "key")), parts)
        cell, behind = F.expr(f"rank div {window}"), F.expr(f"rank % {window} < {overlap}")
        own, earlier = F.struct(cell.alias("cell"), F.lit(0).alias("next")), F.struct((cell - 1).alias("cell"), F.lit(1).alias("next"))
        sides = F.when(behind, F.array(own, earlier)).otherwise(F.array(own))
        dealt = ranked.select("pass", "n", "vid", F.explode(sides).alias("s")).select("pass", "n", "vid", "s.*")
        near = dealt.join(classes.select("vid", "embedding"), "vid")
        links = cut(near.groupBy("cell").applyInPandas(_cell_links(threshold), "src long, dst long").distinct(), "near")
        found = links if found is None else found.unionByName(links)
    linked = cut(connected_components(found).select(F.col("node").alias("vid"), "component"), "linked")

    blocks = linked.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = linked.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), (F.col("own") > o).cast("int").alias("side")))
    dealt = own.select("component", "vid", F.explode(pairs).alias("p")).join(classes.select("vid", "n", "copies", "embedding"), "vid").select("component", "p.*", "vid", "n", "copies", "embedding")
    counts = dealt.groupBy("component", "i", "j").applyInPandas(_block_counts(threshold), "vid long, n long").groupBy("vid").agg(F.sum("n").alias("others"))

    judged = cut(
        classes.select("h1", "h2", "vid", "copies")
        .join(linked, "vid", "left")
        .join(counts, "vid", "left")
        .select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vid").alias("component_id")),
        "judged",
    )
    release(linked, classes)
    good = tagged.where("embedding IS NOT NULL").select("vec_id", "h1", "h2").join(judged, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = tagged.where("embedding IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
