"""Cross-tokenizer alignment: which tokens of two tokenizers end at the same bytes of a text.

Every text is first tokenised in full by both: a space and the text by A, the text by B, which adds the space
itself. Tokens stand for bytes; where the bytes of both sides are those of the text, the offsets at which a token of A and
one of B end together cut the tokens into groups, and the two tokens that end there are linked.

Work is done by windows. An anchor is a shared end before a token that begins with a space on both sides, checked by
its byte offset; anchors cut a document into windows of token ids, about a word each. A window's alignment depends on its
ids alone, so it is remembered by them: each distinct window is aligned once a block of texts, or once a worker while
it is remembered.

A block (about ``chars`` characters of text, or one longer text) is stored as one row: its distinct windows with their links as
numbers of id pairs, each document's windows by number, and how often each id pair is linked. The counts of the corpus
are sums over blocks, so a pair that stands in every text is one row a block; each block's pairs then meet
their corpus counts in a join, and documents get their sums block by block. No table of pairs is broadcast.

A null or empty text has no tokens, nor has one whose bytes a tokenizer does not give back: zeros and an empty
hash. Repeated rows each count; null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strandweave.llm import public_ids
from strandweave.llm.sentencepiece import ship
from strandweave.plans.cut import cut, release

A_MODEL, B_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Windows that a worker remembers; the memory is cleared when it holds so many.
REMEMBER = 250_000
CHARS = 1 << 20
BLOCK = "block long, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, hashes array<string>, doc_ends binary, windows binary, links binary, link_ends binary, pairs array<bigint>, counts array<bigint>"


class Aligner:
    """Two tokenizers, and the alignments of the windows met so far."""

    def __init__(self, a: public_ids.PublicIds, b: public_ids.PublicIds):
        self.models = a, b
        self.sizes = [np.array([len(x) for x in m.bytes_of], np.int64) for m in self.models]
        self.spaced = [np.array([x[:1] == b" " for x in m.bytes_of]) for m in self.models]
        #: Each id as it is spelt inside and at the end of its side of a group.
        self.spelt = [np.array([[f"{i}," for i in range(len(m.bytes_of))], [f"{i}{end}" for i in range(len(m.bytes_of))]], object) for m, end in zip(self.models, "|;", strict=True)]
        self.known: dict[tuple[bytes, bytes], tuple[str, bytes]] = {}

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Both sides' ids, if both give the text's bytes back."""
        if not text:
            return None
        raw, out = (" " + text).encode(), []
        for m in self.models:
            ids = m.encode(text if m.adds_space else " " + text)
            if not m.lossless and b"".join(map(m.bytes_of.__getitem__, ids.tolist())) != raw:
                return None
            out.append(ids)
        return out[0], out[1]

    def windows(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[tuple[bytes, bytes]], np.ndarray, np.ndarray]:
        """The distinct windows of texts that follow each other, as packed ids; the number of each window in order; and the
        windows up to each text's end."""
        ids = [np.concatenate([d[side] for d in docs]) for side in (0, 1)]
        starts = []
        for x, sizes in zip(ids, self.sizes, strict=True):
            ends = np.cumsum(sizes[x])
            starts.append(ends - sizes[x])
        heads = np.cumsum([0, *[int(self.sizes[0][d[0]].sum()) for d in docs]])
        anchors = np.intersect1d(*[s[m[x]] for s, m, x in zip(starts, self.spaced, ids, strict=True)], assume_unique=True)
        anchors = np.union1d(anchors, heads[:-1])
        cuts = [np.append(np.searchsorted(s, anchors), len(x)) for x, s in zip(ids, starts, strict=True)]
        first, order = _distinct(ids, cuts)
        packed = [x.tobytes() for x in ids]
        spans = [[(4 * c[at]).tolist() for at in (first, first + 1)] for c in cuts]
        found = [[p[i:j] for i, j in zip(*s, strict=True)] for p, s in zip(packed, spans, strict=True)]
        return list(zip(*found, strict=True)), order, np.append(np.searchsorted(anchors, heads[1:-1]), len(anchors))

    def align(self, windows: list[tuple[bytes, bytes]]) -> list[tuple[str, bytes]]:
        """Of each window its groups, spelt with ``;`` after each, and its links as packed pairs (A's id in the upper 32 bits)."""
        sides = [np.frombuffer(b"".join([w[side] for w in windows]), np.uint32) for side in (0, 1)]
        ends = [np.cumsum(sizes[x]) for x, sizes in zip(sides, self.sizes, strict=True)]
        _, *last = np.intersect1d(*ends, assume_unique=True, return_indices=True)
        pairs = (sides[0][last[0]].astype(np.int64) << 32 | sides[1][last[1]]).tobytes()
        # a group's tokens of A, then those of B: each stands after the other side's of the groups before it
        parts = np.empty(len(sides[0]) + len(sides[1]), object)
        for side, x in enumerate(sides):
            ending = np.zeros(len(x), np.int64)
            ending[last[side]] = 1
            group = np.cumsum(ending) - ending
            before = np.append(0, last[1 - side] + 1)[group + side]
            parts[np.arange(len(x)) + before] = self.spelt[side][ending, x]
        parts = parts.tolist()
        through = np.cumsum([[len(a), len(b)] for a, b in windows], axis=0) // 4
        cuts, links = through.sum(axis=1).tolist(), (8 * np.searchsorted(last[0], through[:, 0])).tolist()
        return [("".join(parts[i:j]), pairs[k:n]) for i, j, k, n in zip([0, *cuts], cuts, [0, *links], links)]

    def alignments(self, windows: list[tuple[bytes, bytes]]) -> list[tuple[str, bytes]]:
        """As :meth:`align`, of distinct windows; known ones are looked up."""
        fresh = [w for w in windows if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBER:
            self.known.clear()
            fresh = windows
        found = dict(zip(fresh, self.align(fresh), strict=True)) if fresh else {}
        out = [found[w] if w in found else self.known[w] for w in windows]
        self.known.update(found if len(found) <= REMEMBER else {})
        return out

    def block(self, number: int, doc_ids: list[int | None], docs: list[tuple[np.ndarray, np.ndarray] | None]) -> pa.RecordBatch:
        """The row of a block of texts."""
        some = [d for d in docs if d is not None]
        local, order, ends = self.windows(some) if some else ([], *(np.empty(0, np.int64),) * 2)
        aligned = self.alignments(local)
        texts, codes = [t for t, _ in aligned], np.frombuffer(b"".join(p for _, p in aligned), np.int64)
        n_links = np.array([len(p) // 8 for _, p in aligned], np.int64)
        pairs, links = np.unique(codes, return_inverse=True)
        times = np.repeat(np.bincount(order, minlength=len(local)), n_links)
        counts = np.bincount(links, weights=times, minlength=len(pairs)).astype(np.int64)
        before = np.append(0, np.cumsum(n_links[order]))
        hashes, n_groups, doc_ends, at, i = [], [], [], 0, 0
        for d in docs:
            end = int(ends[i]) if d is not None else at
            i += d is not None
            n_groups.append(int(before[end] - before[at]))
            hashes.append(hashlib.sha256("".join(map(texts.__getitem__, order[at:end].tolist()))[:-1].encode()).hexdigest() if d is not None else "")
            doc_ends.append(end)
            at = end
        n_a, n_b = ([0 if d is None else len(d[side]) for d in docs] for side in (0, 1))
        columns = [number, doc_ids, n_a, n_b, n_groups, hashes, np.array(doc_ends, np.int64).tobytes(), _narrow(order, len(local)), _narrow(links, len(pairs)), np.cumsum(n_links).tobytes(), pairs, counts]
        return pa.RecordBatch.from_pylist([dict(zip(ROW.names, columns, strict=True))], schema=ROW)


def _distinct(ids: list[np.ndarray], cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first of each kind of window, and each window's kind: by a hash of its ids, compared with the first id by id."""
    n = len(cuts[0]) - 1
    hashes, inside = np.zeros(n, np.uint64), []
    for x, c in zip(ids, cuts, strict=True):
        sizes = np.diff(c)
        place = np.arange(len(x)) - np.repeat(c[:-1], sizes)
        inside.append((sizes, place))
        power = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
        mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        hashes = hashes * np.uint64(0xC2B2AE3D27D4EB4F) + np.add.reduceat(mixed * power[place], c[:-1]) + sizes.astype(np.uint64)
    _, first, order = np.unique(hashes, return_index=True, return_inverse=True)
    alike = first[order]
    for x, c, (sizes, place) in zip(ids, cuts, inside, strict=True):
        same = np.array_equal(sizes, sizes[alike]) and np.array_equal(x, x[np.repeat(c[:-1][alike], sizes) + place])
        if not same:  # two windows of one hash: told apart one by one
            kinds: dict[tuple, int] = {}
            order = np.array([kinds.setdefault(tuple(bytes(y[d[i] : d[i + 1]]) for y, d in zip(ids, cuts, strict=True)), len(kinds)) for i in range(n)])
            return np.unique(order, return_index=True)[1], order
    return first, order


def _narrow(numbers: np.ndarray, below: int) -> bytes:
    return numbers.astype(np.uint16 if below <= 1 << 16 else np.uint32).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32)


_LONGS = pa.list_(pa.int64())
ROW = pa.schema([("block", pa.int64()), ("doc_ids", _LONGS), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS), ("hashes", pa.list_(pa.string())), ("doc_ends", pa.binary()), ("windows", pa.binary()), ("links", pa.binary()), ("link_ends", pa.binary()), ("pairs", _LONGS), ("counts", _LONGS)])


def blocks(docs: DataFrame, a_model: str = A_MODEL, b_model: str = B_MODEL, chars: int = CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a block of texts: documents, windows, links, and the block's id pairs with their numbers of links."""
    names = [ship(docs.sparkSession, path) for path in (a_model, b_model)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Aligner(*[public_ids.load(n) for n in names])
        number = TaskContext.get().partitionId() << 33
        ids, docs, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                ids.append(doc)
                docs.append(own.tokens(text))
                held += len(text or "") + 64
                if held >= chars:
                    yield own.block(number, ids, docs)
                    ids, docs, held, number = [], [], 0, number + 1
        if ids:
            yield own.block(number, ids, docs)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCK)


def pair_counts(stored: DataFrame) -> DataFrame:
    """pair, n (links of the corpus that hold it), best (no pair with the same B id has more)."""
    each = stored.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    totals = cut(each.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pairs")
    most = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the sums over their links, from blocks with their pairs' counts."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {n: batch.column(i)[row] for i, n in enumerate(batch.schema.names)}
            raw = lambda name, kind: np.frombuffer(one[name].as_py(), kind)
            said = one["said"].values
            doc_ids = one["doc_ids"].values
            best, count = np.zeros(len(doc_ids), np.int64), np.zeros(len(doc_ids), np.int64)
            if said is not None and len(said):
                by_pair = np.argsort(said.field("pair").to_numpy(zero_copy_only=False))
                link_ends, doc_ends = raw("link_ends", np.int64), raw("doc_ends", np.int64)
                links, windows = _wide(one["links"].as_py(), link_ends[-1]), _wide(one["windows"].as_py(), doc_ends[-1])
                for out, name in ((best, "best"), (count, "n")):
                    values = said.field(name).to_numpy(zero_copy_only=False).astype(np.int64)[by_pair]
                    a_window = np.diff(np.append(0, np.cumsum(values[links]))[np.append(0, link_ends)])
                    out += np.diff(np.append(0, np.cumsum(a_window[windows]))[np.append(0, doc_ends)])
            groups = one["n_groups"].values
            yield pa.RecordBatch.from_arrays([doc_ids, one["n_a"].values, one["n_b"].values, groups, groups, pa.array(best), pa.array(count), one["hashes"].values], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def aligned_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row a document."""
    stored = cut(blocks(docs, **options), "blocks")
    asked = stored.select("block", F.explode("pairs").alias("pair"))
    said = asked.join(pair_counts(stored), "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("said"))
    met = stored.drop("pairs", "counts").join(said, "block", "left")
    return met.mapInArrow(_sums, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def token_pairs(docs: DataFrame, **options) -> DataFrame:
    """a_id, b_id, n, best: every pair of ids that ends together somewhere, with its links in the corpus."""
    stored = cut(blocks(docs, **options), "blocks")
    pairs = pair_counts(stored)
    out = cut(pairs.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b_id"), "n", "best"), "token_pairs")
    release(stored)
    return out
