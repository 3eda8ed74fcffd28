"""Best-fit packing of documents into sequences, by hierarchical residual packing.

A document is its ids and one closing id. Only a document longer than a sequence is cut: into whole sequences, with
what is over as its first piece. Pieces are dealt evenly over tasks without regard to their order in the table, so
that each task sees the corpus's mixture of lengths, and packed level by level:

* a task takes ``block`` pieces at a time, longest first, each into the open bin with the least room that holds it
  (or a new one). The bins left underfull are items of its next block;
* after a block any two open bins are more than a sequence together unless one is under half full, and best fit
  leaves at most one such. Only that one can still move, and the others can take it only if they have the room: so
  each task hands up its least filled bin and the ``fan`` others with the most room, and all other bins are
  emitted as they are;
* the bins that ``fan`` tasks hand up are items of one task of the next level, until one task holds them all.

So a level reads at most ``fan + 1`` bins a task below it, whatever the number of pieces. A bin is a row with its
pieces; the tokens themselves stay where they were counted, and only lengths are shuffled.

A null or empty text is its closing id alone. Repeated rows are packed as often as they stand; null ids are kept;
an empty table gives an empty result; columns besides the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strandweave.llm import public_ids
from strandweave.llm.sentencepiece import ship
from strandweave.plans.cut import cut, release

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())])
PLACED = pa.struct([*PIECE, ("offset", pa.int64())])
BIN = "sequence_id long, open boolean, used int, pieces array<struct<doc_id:bigint,piece:int,start:bigint,length:int,ids_crc32:bigint,offset:bigint>>"


def pieces(docs: DataFrame, size: int = 2048, closing: int = 0, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every document."""
    name = ship(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = public_ids.load(name)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(model.encode(text.as_py() or ""), np.uint32(closing)).astype("<u4")
                first = len(ids) % size or size
                cuts = [0, *range(min(first, len(ids)), len(ids) + 1, size)]
                rows += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                if len(rows) >= 10_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length int, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECE, strict=True)], names=[f.name for f in PIECE])


def _best_fit(items: list[tuple[int, list]], size: int) -> list[tuple[int, list]]:
    """Items (length, pieces), longest first, each into the bin with the least room that holds it."""
    bins: list[list] = []
    rooms: list[int] = []  # the rooms that occur, in order
    having: dict[int, list[int]] = {}  # the bins with each room
    for length, held in sorted(items, key=lambda x: -x[0]):
        at = bisect_left(rooms, length)
        if at == len(rooms):
            number, room = len(bins), size
            bins.append([0, []])
        else:
            room = rooms[at]
            number = having[room].pop()
            if not having[room]:
                del having[room], rooms[at]
        into = bins[number]
        into[0] += length
        into[1] += held
        left = room - length
        if left:
            if left not in having:
                having[left] = []
                insort(rooms, left)
            having[left].append(number)
    return [(used, held) for used, held in bins]


def _split(bins: list[tuple[int, list]], size: int, fan: int) -> tuple[list, list]:
    """Bins that nothing more goes into, and the ones handed up: the least filled and those with the most room."""
    bins.sort(key=lambda x: x[0])
    n = sum(used < size for used, _ in bins[: fan + 1])
    return bins[n:], bins[:n]


def _packer(size: int, fan: int, block: int, level: int):
    """Packs a task's rows: pieces, or bins handed up. A bin's number holds its level, task and place."""

    def rows(bins: list[tuple[int, list]], still: bool, at: int) -> pa.RecordBatch:
        flat = [(*p, place) for _, ps in bins for p, place in zip(ps, accumulate((p[3] for p in ps), initial=0))]
        fields = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*flat), PLACED, strict=True)], fields=list(PLACED)) if flat else pa.array([], PLACED)
        held = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(ps) for _, ps in bins]]), pa.int32()), fields)
        return pa.RecordBatch.from_arrays([pa.array(range(at, at + len(bins)), pa.int64()), pa.array([still] * len(bins)), pa.array([used for used, _ in bins], pa.int32()), held], names=["sequence_id", "open", "used", "pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[tuple[int, list]] = []
        items: list[tuple[int, list]] = []

        number = level << 57 | TaskContext.get().partitionId() << 33

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal left, items, number
            done, left = _split(_best_fit(left + items, size), size, fan)
            items = []
            for at in range(0, len(done), 5000):
                yield rows(done[at : at + 5000], False, number)
                number += 5000

        for batch in batches:
            if level:
                items += [(used, [tuple(p.values())[:-1] for p in ps]) for used, ps in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            else:
                items += [(p[3], [p]) for p in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            if len(items) >= block:
                yield from settle()
        yield from settle()
        if left:
            yield rows(left, True, number)

    return run


def pack(found: DataFrame, size: int = 2048, block: int = 16_384, fan: int = 16) -> DataFrame:
    """The columns of :func:`pieces`, sequence_id and offset. A task of the first level gets up to sixteen blocks."""
    stored = cut(found, "pieces")
    n = stored.count()
    tasks = max(1, -(-n // (16 * block)), min(-(-n // block), int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    levels = [cut(stored.repartition(tasks).mapInArrow(_packer(size, fan, block, 0), BIN), "bins")]
    release(stored)
    while tasks > 1:
        tasks = -(-tasks // fan)
        levels.append(cut(levels[-1].where("open").repartition(tasks).mapInArrow(_packer(size, fan, block, len(levels)), BIN), "bins"))
    closed = [(step if step is levels[-1] else step.where("NOT open")).select("sequence_id", F.explode("pieces").alias("p")) for step in levels]
    return reduce(DataFrame.unionByName, closed).select("p.doc_id", "p.piece", "p.start", F.col("p.length").cast("long").alias("length"), "p.ids_crc32", "sequence_id", "p.offset")


def packed_documents(docs: DataFrame, size: int = 2048, **options) -> DataFrame:
    """Every piece of ``docs`` with its sequence and its place there."""
    return pack(pieces(docs, size), size, **options)
