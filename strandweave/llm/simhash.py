"""SimHash near-deduplication by covering locality-sensitive hashing.

A fingerprint is 64 bits wide. For radius r every bit position gets a random vector of r + 1 bits, and each
of the 2^(r+1) - 1 nonzero vectors v makes one table, whose mask hides the positions whose vector is
orthogonal to v. The at most r positions where two close fingerprints differ span a space of dimension r at
most, so some v is orthogonal to all of them and hides them, and the two agree on the rest: every pair within
the radius meets in at least one table, with certainty.

Only distinct fingerprints enter the tables (copies share one), each bucket is streamed through one task in
sorted order, and what leaves it is a spanning forest of its links, not its pairs. A bucket larger than
``BUCKET`` is not compared in place: its members go to a further round, keyed by the bucket and a second,
independent covering, which again misses no pair; each round halves the free bits, so rounds are few.

Nulls, empty texts: a null text is an empty one; texts without words have fingerprint zero and are linked
like any other. Rows with a null id take part and take the component of their fingerprint. Repeated rows
stay repeated. An empty table gives an empty result. Columns besides the id and the text are ignored.

Wide fingerprints (512 bits, the first 64 as above) are for rules by the similarity of shingle sets, whose pairs differ
in a share of the bits and not in a few: :func:`close_groups` proposes pairs, the caller decides. Words of ``width``
positions are drawn from the bits, and each has a covering of radius 2: its positions are dealt to the seven nonzero
vectors of three bits, and each of seven masks hides the three vectors orthogonal to one. ``width`` follows the number
of fingerprints, the number of words the chance that a pair that differs in each bit with probability ``rate`` meets in
none of them (``MISS``). A bucket is compared whole, however large.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from strandweave.operators.components import connected_components
from strandweave.plans.cut import cut, release

SEED = 42
#: Members of one bucket that a task compares with each other.
BUCKET = 4096
#: Shingle hashes that are turned into bit counts at a time, whatever a text's length.
CHUNK = 1 << 16

#: Longs of a wide fingerprint, and those that travel with a key.
LONGS, CARRIED = 8, 3
#: Shares of the pairs at a given rate that no word's covering brings together, or that differ in more bits than ``within``.
MISS, BEYOND = 2e-6, 5e-7
#: Least positions of a word, and members of its average bucket from which it has more.
WIDTH, MEMBERS = 14, 4096
#: Members up to which a bucket's rows with a neighbour are found by tiles first, and a tile's rows and columns.
TILED, TILE = 8192, (64, 4096)


def shingle_chunks(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles in order, a row of 8 bytes each, ``CHUNK`` at a time; none without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > shingle:
        starts, ends = starts[: len(tokens) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        yield np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8).reshape(-1, 8)


def text_fingerprint(text: str | None, shingle: int) -> bytes:
    """The 8 bytes, most significant first: bit b is set if it is set in over half the shingles' hashes."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_chunks(text, shingle):
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return np.packbits(2 * counts > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the signed long with each whole text's fingerprint bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = b"".join(text_fingerprint(t.as_py(), shingle) for t in batch.column(1))
            values = np.frombuffer(packed, ">i8").astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int, seed: int) -> list[int]:
    """The masks of one covering as signed longs."""
    draw = random.Random(seed)
    vectors = [draw.randrange(1 << (radius + 1)) for _ in range(64)]
    masks = []
    for v in range(1, 1 << (radius + 1)):
        m = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _forest(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among unsigned ``values``: a search that compares each with all not yet reached."""
    rest = values
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                yield from ((int(x), int(y)) for y in found)
                reached.extend(found)
                rest = rest[~near]


def _bucket_links(radius: int, most: int):
    """Links within runs of equal keys, from rows sorted by key; rows of longer runs than ``most`` come back
    with kind 1. Holds one run at a time."""
    schema = pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64())])

    def emit(kind: int, a, b) -> pa.RecordBatch:
        a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b)], schema=schema)

    def links(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(at, len(keys)))
        width = np.repeat(size, size)
        small = width <= 8
        for d in range(1, 8):
            i = np.flatnonzero((keys[:-d] == keys[d:]) & small[:-d])
            if not len(i):
                break
            i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= radius]
            if len(i):
                yield emit(0, fps[i].view(np.int64), fps[i + d].view(np.int64))
        for s, n in zip(at[size > 8], size[size > 8], strict=True):
            if n > most:
                yield emit(1, keys[s : s + n], fps[s : s + n].view(np.int64))
            elif found := list(_forest(fps[s : s + n], radius)):
                yield emit(0, *np.array(found, np.uint64).view(np.int64).T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f, heavy = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate((held_k, batch.column(0).to_numpy()))
            fps = np.concatenate((held_f, batch.column(1).to_numpy().view(np.uint64)))
            if heavy is not None:
                n = int(np.searchsorted(keys, heavy, side="right"))
                if n:
                    yield emit(1, keys[:n], fps[:n].view(np.int64))
                keys, fps = keys[n:], fps[n:]
                if len(keys):
                    heavy = None
            if not len(keys):
                held_k, held_f = keys, fps
                continue
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            if last:
                yield from links(keys[:last], fps[:last])
            held_k, held_f = keys[last:], fps[last:]
            if len(held_k) > most:
                heavy = held_k[0]
                yield emit(1, held_k, held_f.view(np.int64))
                held_k, held_f = held_k[:0], held_f[:0]
        if len(held_k):
            yield from links(held_k, held_f)

    return run


def fingerprint_links(fps: DataFrame, radius: int = 4, bucket: int = BUCKET, seed: int = 7) -> DataFrame:
    """(src, dst) between distinct fingerprints (column fp) that connects all pairs within ``radius`` bits."""
    spark = fps.sparkSession
    members, found, level = fps.select(F.lit(0).cast("long").alias("upper"), "fp"), None, 0
    while True:
        masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius, seed + level)])
        keyed = members.select("upper", "fp", F.explode(masks).alias("m")).select(F.xxhash64("upper", "m", F.col("fp").bitwiseAND(F.col("m"))).alias("key"), "fp")
        runs = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_bucket_links(radius, bucket), "kind byte, a long, b long")
        step = cut(runs.distinct(), "links")
        links = step.where("kind = 0").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        found = links if found is None else found.unionByName(links)
        deferred = step.where("kind = 1").select(F.col("a").alias("upper"), F.col("b").alias("fp"))
        if level >= 6 or deferred.isEmpty():
            if level >= 6 and not deferred.isEmpty():
                raise RuntimeError("buckets of one fingerprint pattern did not shrink")
            return found.distinct()
        members, level = deferred, level + 1


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links), kept (it is its own component)."""
    rows = cut(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    owners = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("owner")), "owners")
    linked = connected_components(fingerprint_links(owners.select("fp"), radius, bucket))
    rooted = owners.join(linked, owners["fp"] == linked["node"], "left").select("fp", "owner", F.coalesce("component", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("owner").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(cut(named, "named"), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def one_of_each(docs: DataFrame, radius: int = 6, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but those whose group holds a smaller id. Repeated rows of the smallest id all stay."""
    judged = near_duplicates(docs.where(F.col(id_col).isNotNull()), radius, shingle, id_col, text_col)
    gone = judged.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"] == gone["__gone"], "left_anti")


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """The 8 * ``LONGS`` bytes of a set of shingle hashes: the first 8 as :func:`text_fingerprint`, the others from the hashes
    mixed with a number each."""
    counts = np.zeros(64 * LONGS, np.int64)
    for at in range(0, len(hashes), 255):  # counts of a part fit in a byte
        x = hashes[at : at + 255, None] + np.arange(LONGS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        y = x[:, 1:]
        y = (y ^ (y >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        y = (y ^ (y >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x[:, 1:] = y ^ (y >> np.uint64(31))
        counts += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def similarity_rate(threshold: float) -> float:
    """The probability that two sets of equal size and of Jaccard similarity ``threshold`` differ in a bit: the angle between them."""
    return math.acos(2 * threshold / (1 + threshold)) / math.pi


def _binomial(n: int, p: float) -> list[float]:
    return [math.comb(n, x) * p**x * (1 - p) ** (n - x) for x in range(n + 1)]


def within(bits: int, rate: float) -> int:
    """The distance in ``bits`` bits that pairs of this rate exceed with a probability of ``BEYOND`` at most."""
    beyond, d, shares = 0.0, bits, _binomial(bits, rate)
    while beyond + shares[d] <= BEYOND:
        beyond, d = beyond + shares[d], d - 1
    return d


def word_masks(width: int) -> list[list[int]]:
    """For each of seven masks the places of a word that it shows: those whose vector is not orthogonal to it."""
    return [[i for i in range(width) if ((1 + i % 7) & v).bit_count() % 2] for v in range(1, 8)]


def met(width: int, differing: int) -> float:
    """The chance that some mask hides all of ``differing`` places of a word, wherever they are."""
    if not differing:
        return 1.0
    hidden = [width - len(shown) for shown in word_masks(width)]
    dealt = [len(range(i, width, 7)) for i in range(7)]
    # places of one vector are hidden by three masks, those of two vectors by one
    ways = sum(math.comb(h, differing) for h in hidden) - 2 * sum(math.comb(n, differing) for n in dealt)
    return ways / math.comb(width, differing)


def word_plan(n: int, rate: float) -> tuple[int, int]:
    """(width, words) for ``n`` fingerprints."""
    width = max(WIDTH, round(7 / 4 * math.log2(max(n, 1) / MEMBERS)) if n > MEMBERS else 0)
    bits, by_places = 64 * LONGS, [met(width, x) for x in range(width + 1)]
    lost = []
    for d in range(bits + 1):
        found = sum(math.comb(d, x) * math.comb(bits - d, width - x) * by_places[x] for x in range(width + 1) if x <= d and width - x <= bits - d)
        lost.append(max(0.0, 1 - found / math.comb(bits, width)))
    shares, words = _binomial(bits, rate), 1
    while sum(s * m**words for s, m in zip(shares, lost, strict=True)) > MISS:
        words += 1
    return width, words


def word_keys(longs: np.ndarray, width: int, words: int, seed: int = 7) -> np.ndarray:
    """The keys of wide fingerprints (rows of ``LONGS``), seven a word; a key says which mask it is of."""
    draw, bits = np.random.default_rng(seed), 64 * LONGS
    weights = np.zeros((bits, 7 * words))
    for w in range(words):
        places = draw.permutation(bits)[:width]
        for m, shown in enumerate(word_masks(width)):
            weights[places[shown], 7 * w + m] = 2.0 ** np.arange(len(shown))  # sums are whole numbers below 2^53
    values = np.unpackbits(np.ascontiguousarray(longs).view(np.uint8), axis=1).astype(np.float64) @ weights
    return (np.arange(7 * words, dtype=np.int64) << width) + values.astype(np.int64)


def _dealt(width: int, words: int, step: int = 2048):
    """(key, fp, the first ``CARRIED`` longs) for every key of rows (fp, bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                longs = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, LONGS)
                keys = word_keys(longs, width, words)
                columns = [part.column(0).to_numpy(zero_copy_only=False), *longs.T[:CARRIED]]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *[pa.array(np.repeat(c, keys.shape[1])) for c in columns]], names=["key", "fp", *[f"b{i}" for i in range(CARRIED)]])

    return run


def _with_neighbours(longs: np.ndarray, radius: int) -> np.ndarray:
    """Which columns of ``longs`` have another within ``radius`` bits."""
    n = longs.shape[1]
    found, (high, wide) = np.zeros(n, bool), TILE
    for i in range(0, n, high):
        for j in range(i, n, wide):
            near = np.bitwise_count(longs[:, i : i + high, None] ^ longs[:, None, j : j + wide]).sum(axis=0, dtype=np.uint8) <= radius
            if i == j:
                np.fill_diagonal(near, False)
            found[i : i + high] |= near.any(axis=1)
            found[j : j + wide] |= near.any(axis=0)
    return found


def _wide_forest(ids: np.ndarray, longs: np.ndarray, radius: int) -> list[np.ndarray]:
    """Rows (root, reached from, reached): a spanning forest of the columns of ``longs`` within ``radius`` bits of each other."""
    if len(ids) <= TILED:
        kept = _with_neighbours(longs, radius)
        ids, longs = ids[kept], longs[:, kept]
    out, rest, left = [], np.arange(len(ids)), longs
    while len(rest) > 1:
        root, reached, rest, left = rest[0], [rest[0]], rest[1:], left[:, 1:]
        while reached and len(rest):
            x = reached.pop()
            near = np.bitwise_count(left ^ longs[:, x, None]).sum(axis=0, dtype=np.uint8) <= radius
            if near.any():
                found = rest[near]
                out.append(np.stack([np.full(len(found), ids[root]), np.full(len(found), ids[x]), ids[found]], axis=1))
                reached.extend(found)
                rest, left = rest[~near], left[:, ~near]
    return out


def _bucket_groups(radius: int):
    """(key, root, a, b) of the forest of each run of equal keys, from rows sorted by key. Holds one run at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def finished() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held) if len(held) > 1 else held[0]
            at = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
            for s, e in zip(at, np.append(at[1:], len(rows)), strict=True):
                if e - s > 1 and (found := _wide_forest(rows[s:e, 1], np.ascontiguousarray(rows[s:e, 2:].T).view(np.uint64), radius)):
                    edges = np.concatenate(found)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(edges), rows[s, 0])), *[pa.array(np.ascontiguousarray(c)) for c in edges.T]], names=["key", "root", "a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            if not len(rows):
                continue
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0], side="left"))
            if held and (last or held[0][-1, 0] != rows[-1, 0]):
                held.append(rows[:last])
                yield from finished()
                held = []
            elif last:
                held = [rows[:last]]
                yield from finished()
                held = []
            held.append(rows[last:])
        if held:
            yield from finished()

    return run


def close_groups(fps: DataFrame, rate: float) -> DataFrame:
    """(grp, a, b): of each bucket of wide fingerprints (fp, bits: ``LONGS`` longs) the groups that hang together by neighbours,
    as the edges of a tree. Fingerprints that differ in each bit with probability ``rate`` or less are neighbours in some
    bucket but for the shares ``MISS`` and ``BEYOND``."""
    keyed = fps.select("fp", "bits").mapInArrow(_dealt(*word_plan(fps.count(), rate)), "key long, fp long, " + ", ".join(f"b{i} long" for i in range(CARRIED)))
    runs = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_bucket_groups(within(64 * CARRIED, rate)), "key long, root long, a long, b long")
    return runs.select(F.xxhash64("key", "root").alias("grp"), "a", "b")
