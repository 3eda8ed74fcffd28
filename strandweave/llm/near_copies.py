"""Near copies by Jaccard similarity of word shingles: SimHash with covering hashes finds candidates, exact sets decide.

A text's set holds the 64-bit hashes of its distinct shingles. Equal sets collapse first. Each set has a wide SimHash
fingerprint; two sets of similarity J differ in each of its bits with a probability that falls with J (0.1515 at 0.8), and
coverings of words of those bits bring such pairs together (:mod:`strandweave.llm.simhash`). At J = 0.8 at most three
pairs in a million meet in no word or differ in more bits than are looked for, fewer above. In small sets majorities tie
more often: a bit differs with up to 0.161 in sets of 12 to 15 (six in a million at 190,000 texts) and with 0.1875 in
those of four and five, the smallest that can be similar without being equal (two in ten thousand). Every candidate pair
is then decided by the exact similarity of the two sets, so no pair below the threshold links.

Not all pairs of a bucket are decided: those of a tree over each group of neighbours, which joins a large group in as
many decisions as it has members. Groups whose members are then in different components give their members to an exact
join by their sets' rarest shingles (:func:`meeting_pairs`), which finds every further pair at the threshold. Texts of
which (1 - t) / (1 + t) or more (a ninth at 0.8) is theirs alone meet nobody there, however alike the rest is. Texts with
less of their own that stay below the threshold because they lack different parts still meet pairwise. None is cut.

Nulls, empty texts: a null text is an empty one; texts without words have the empty set and are copies of each
other. Rows with a null id are left alone. Repeated rows stay repeated. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from strandweave.llm.simhash import LONGS, close_groups, shingle_chunks, similarity_rate, wide_fingerprint, within
from strandweave.operators.components import connected_components
from strandweave.plans.cut import cut, release

THRESHOLD = 0.8
SEED = 42
#: Sets below this size differ in a bit with up to 0.1875 at the threshold: their whole fingerprints aren't looked at.
SMALL = 64


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    chunks = list(shingle_chunks(text, shingle))
    return np.unique(np.concatenate(chunks).reshape(-1).view("<u8")) if chunks else np.empty(0, "<u8")


def set_hash(hashes: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def sketches(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp, n, bits): the hash and size of each whole text's set, and its wide fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
            columns = [pa.array([set_hash(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([np.frombuffer(wide_fingerprint(s), np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "fp", "n", "bits"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long, n long, bits array<long>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(fp, shingles) of the texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                s = shingle_set(text.as_py(), shingle)
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(s)], pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], names=["fp", "shingles"])

    return docs.mapInArrow(run, "fp long, shingles array<long>")


def sets_of(fps: DataFrame, owners: DataFrame, docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(fp, shingles) of the set hashes in ``fps``, from the texts of their owners. An id on several texts gives their sets too."""
    ids = cut(owners.join(fps, "fp").select(F.col("owner").alias("__owner")).distinct(), "needed")
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).join(ids, F.col("__id") == F.col("__owner"), "left_semi").select("__text")
    sets = cut(_sets(texts, shingle).dropDuplicates(["fp"]), "sets")
    release(ids)
    return sets


def alike_pairs(pairs: DataFrame, owners: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) of set hashes whose sizes and whole fingerprints allow the threshold."""
    proposed = cut(pairs, "proposed")
    of = lambda name: owners.select(F.col("fp").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    sizes = F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-6  # a pair's sizes bound its similarity
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    found = cut(proposed.join(of("a"), "a").join(of("b"), "b").where(sizes & ((F.least("n_a", "n_b") < SMALL) | (apart <= within(64 * LONGS, similarity_rate(threshold))))).select("a", "b"), "pairs")
    release(proposed)
    return found


def meeting_pairs(sets: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of ``members`` (fp, group) of different groups: all that reach the threshold, and those that meet as these must.

    Two sets at the threshold t share t of the larger one at least, so with all sets in one order the first shingle they
    share is at place (1 - t) * n or before in both, and enough of both follows it. Shingles that few members hold come
    first: sets alike by what all of them share, and below the threshold by what each has alone, do not meet.
    """
    shingles = sets.join(members, "fp").select("fp", "group", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    held = shingles.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    of_set = Window.partitionBy("fp")
    # shingles of one member alone stand before all others, whatever they are
    at = F.col("n") - F.count("*").over(of_set) + F.row_number().over(of_set.orderBy("holders", "shingle")) - 1
    ordered = shingles.join(held, "shingle").select("shingle", "fp", "group", "n", at.alias("at"))
    first = cut(ordered.where(F.col("at") <= (1 - threshold) * F.col("n") + 1e-6), "first")

    parts = first.groupBy("shingle", "group").agg(F.count("*").alias("members"))
    # members outside the largest group meet all that are not in theirs
    split = parts.groupBy("shingle").agg(F.max_by("group", F.struct("members", "group")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    open_ = cut(first.join(split, "shingle"), "open")
    small = open_.where("group <> main").select("shingle", F.col("fp").alias("a"), F.col("group").alias("group_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    large = open_.select("shingle", F.col("fp").alias("b"), F.col("group").alias("group_b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), "main")
    apart = (F.col("group_a") != F.col("group_b")) & ((F.col("group_b") == F.col("main")) | (F.col("a") < F.col("b")))
    enough = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= threshold / (1 + threshold) * (F.col("n_a") + F.col("n_b")) - 1e-6
    found = cut(small.join(large, "shingle").where(apart & enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "meeting")
    release(first, open_)
    return found


def similar_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) of set hashes whose sets reach the threshold."""
    side = lambda name: sets.select(F.col("fp").alias(name), F.col("shingles").alias(f"set_{name}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.size("set_a").alias("na"), F.size("set_b").alias("nb"), common.alias("both"))
    return cut(near.where(F.col("both") / (F.col("na") + F.col("nb") - F.col("both")) >= threshold).select("a", "b"), "similar")


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id (smallest doc_id reachable over pairs at ``threshold`` or more)."""
    rows = cut(sketches(docs, shingle, id_col, text_col), "sketches")
    owners = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.any_value("n").alias("n"), F.any_value("bits").alias("bits")), "owners")
    near = cut(close_groups(owners.where("n > 0"), similarity_rate(threshold)), "near")

    pairs = alike_pairs(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), owners, threshold)
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), owners, docs, shingle, id_col, text_col)
    links = similar_pairs(pairs, sets, threshold)
    linked = cut(connected_components(links, "a", "b"), "linked")
    release(pairs, sets)
    members = near.select("grp", F.explode(F.array("a", "b")).alias("fp")).distinct()
    placed = cut(members.join(linked, members["fp"] == linked["node"], "left").select("grp", "fp", F.coalesce("component", "fp").alias("group")), "placed")
    mixed = placed.groupBy("grp").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least <> most")
    apart = cut(placed.join(mixed, "grp", "left_semi").select("fp", "group").distinct(), "apart")
    sets = sets_of(apart.select("fp"), owners, docs, shingle, id_col, text_col)
    pairs = meeting_pairs(sets, apart, threshold)
    more = similar_pairs(pairs, sets, threshold)
    release(near, placed, apart, pairs, sets)

    final = connected_components(links.unionByName(more), "a", "b")
    rooted = owners.select("fp", "owner").join(final, F.col("fp") == F.col("node"), "left").select("fp", "owner", F.coalesce("component", "fp").alias("root"))
    named = cut(rooted.join(rooted.groupBy("root").agg(F.min("owner").alias("component_id")), "root").select("fp", "component_id"), "named")
    return rows.select("doc_id", "fp").join(named, "fp").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but those whose group holds a smaller id. Repeated rows of the smallest id all stay."""
    judged = near_copies(docs.where(F.col(id_col).isNotNull()), threshold, shingle, id_col, text_col)
    gone = judged.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"] == gone["__gone"], "left_anti")
