"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The pieces of a model file are laid out as a double-array trie over UTF-8 bytes: from state s, byte b leads to
``base[s] + b`` if ``check`` there names s. A text is normalised to whitespace markers (a marker before it, one
for each space), and the segmentation with the highest sum of log scores is found by dynamic programming.
A character that no piece covers costs ``UNKNOWN`` below the worst piece and becomes its UTF-8 byte pieces, so
decoding returns every text unchanged: byte pieces become bytes, markers become spaces, and a literal marker
in a text travels as bytes.

No piece holds a marker after another character, so words are independent: each word is segmented once per
task and remembered, all new words of a batch in step with each other as arrays (trie steps and the dynamic
programme run over all words at once). A word of more than ``LONG`` bytes, as in a script without spaces, has a
table of its own: the trie runs over a stretch of its positions at once, and the programme over the pieces found.
The memory is cleared when it reaches ``REMEMBER`` words, long words are not kept in it, and texts are taken some
words at a time, so a task's memory does not grow with its input but with its longest word (16 bytes a byte).

Equal sums go to the longer last piece. A null text has null ids and decodes to null; an empty one has none.
Ids, repeated rows and other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MARK = "▁"
UNKNOWN = 10.0
REMEMBER = 150_000
#: Stands for a marker that is part of a text; no word is empty.
LITERAL = ""
WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Rows of a batch that are Python objects at a time.
ROWS = 1000
#: Words are handled in slices of about this many characters; a slice ends where a word does.
SLICE = 1 << 21
BORDER = re.compile("(?<! ) ")
#: Bytes from which a word has its own table, and positions that the trie runs over at a time there.
LONG, STRETCH = 256, 1 << 14
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class Trie:
    """Pieces as a double array; ``leaf`` holds the piece that ends in a state, or -1."""

    def __init__(self, pieces: list[bytes]):
        tree: list[dict[int, int]] = [{}]
        ends = [-1]
        for number, piece in enumerate(pieces):
            at = 0
            for b in piece:
                if b not in tree[at]:
                    tree[at][b] = len(tree)
                    tree.append({})
                    ends.append(-1)
                at = tree[at][b]
            if piece and ends[at] < 0:
                ends[at] = number
        room = 2 * len(tree) + 1024
        base, check, leaf, used = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32), bytearray(room)
        used[0] = 1
        place, hole, top = [0] * len(tree), 1, 0
        for node in range(len(tree)):  # children have higher numbers than their parent
            state = place[node]
            leaf[state] = ends[node]
            if not tree[node]:
                continue
            branch = sorted(tree[node])
            while used[hole]:
                hole += 1
            # one child fills the first hole; several try a few places there, then go beyond all others
            start, tries = max(1, hole - branch[0]), 0
            while tries < 32 and any(used[start + b] for b in branch):
                start, tries = start + 1, tries + 1
            if tries == 32:
                start = max(1, top + 1 - branch[0])
            top = max(top, start + branch[-1])
            if top + 512 >= room:
                base, check, leaf = np.append(base, np.zeros(room, np.int32)), np.append(check, np.full(room, -1, np.int32)), np.append(leaf, np.full(room, -1, np.int32))
                used.extend(bytes(room))
                room *= 2
            base[state] = start
            for b in branch:
                used[start + b] = 1
                check[start + b] = state
                place[tree[node][b]] = start + b
        self.base, self.check, self.leaf = (np.append(x, np.full(512, -1, np.int32)) for x in (base, check, leaf))
        self.longest = max(map(len, pieces), default=0)


class Decoder:
    """The text of each id of a serialised model."""

    def __init__(self, raw: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte_ids = [-1] * 256
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        if min(self.byte_ids) < 0:
            raise ValueError("the model has no byte pieces to fall back to")
        self.usual = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.given = np.array([sp.get_score(i) for i in self.usual])
        self.text_of = [b""] * size
        for i in self.usual:
            self.text_of[i] = self.pieces[i].replace(MARK, " ").encode()
        for n, b in enumerate(self.byte_ids):
            self.text_of[b] = bytes([n])

    def decode(self, ids) -> str:
        """The text of ids; control pieces are skipped, the marker before the text is dropped."""
        raw = b"".join(map(self.text_of.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class Model(Decoder):
    """Pieces with log scores, read from a serialised model.

    A unigram model's scores are used as they are. A merge model has ranks instead of scores; a piece of rank
    r gets log(1 / (r + 1)), the log probability of rank r under Zipf's law up to a constant.
    """

    def __init__(self, raw: bytes):
        super().__init__(raw)
        given = self.given
        ranked = len(given) > 1 and given.min() <= -(len(given) - 1) and np.array_equal(given, np.round(given))
        self.scores = -np.log1p(-given) if ranked else given
        self.ids = np.array(self.usual, np.int32)
        self.trie = Trie([self.pieces[i].encode() for i in self.usual])
        self.unknown = float(self.scores.min()) - UNKNOWN
        self.literal = np.array([self.byte_ids[b] for b in MARK.encode()], np.int32).tobytes()
        self.known: dict[str, bytes] = {LITERAL: self.literal}

    def segment(self, words: list[bytes]) -> list[bytes]:
        """The best ids (packed) of each word, its bytes already normalised; all words advance together."""
        trie, n = self.trie, len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        width, offset = int(lengths.max()), np.concatenate(([0], np.cumsum(lengths)))
        flat = np.frombuffer(b"".join(words) + bytes(trie.longest + 8), np.uint8).astype(np.int32)
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0.0
        back = np.zeros((width + 1, n), np.int32)  # the length of the last piece in bytes
        which = np.full((width + 1, n), -1, np.int32)  # and its number, -1 for a character by its bytes
        order = np.argsort(-lengths, kind="stable")  # the words still running are a prefix of these
        running = np.searchsorted(-lengths[order], -np.arange(width + 1), side="left")
        for at in range(width):
            rows = order[: running[at]]
            rows = rows[best[at, rows] > -np.inf]
            if not len(rows):
                continue
            first = flat[offset[rows] + at]
            step = np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))
            self._better(best, back, which, rows, at, np.minimum(step, lengths[rows] - at), np.full(len(rows), -1, np.int32), best[at, rows] + self.unknown)
            state, live, depth = np.zeros(len(rows), np.int64), rows, 0
            while len(live) and depth < trie.longest:
                ahead = at + depth < lengths[live]
                live, state = live[ahead], state[ahead]
                if not len(live):
                    break
                following = trie.base[state].astype(np.int64) + flat[offset[live] + at + depth]
                good = (trie.base[state] > 0) & (trie.check[following] == state)
                live, state = live[good], following[good]
                depth += 1
                piece = trie.leaf[state]
                ends = piece >= 0
                if ends.any():
                    whose = live[ends]
                    self._better(best, back, which, whose, at, np.full(len(whose), depth), piece[ends], best[at, whose] + self.scores[piece[ends]])
        # back through all words at once; the ids of a word fill its row from the right
        steps: list[np.ndarray] = []
        left, count, spelt = lengths.copy(), np.zeros(n, np.int64), np.zeros(n, bool)
        live = np.flatnonzero(left)
        while len(live):
            piece = which[left[live], live]
            spelt[live[piece < 0]] = True
            row = np.zeros(n, np.int32)
            row[live] = self.ids[piece]
            steps.append(row)
            count[live] += 1
            left[live] -= back[left[live], live]
            live = live[left[live] > 0]
        packed, stride = np.stack(steps[::-1], axis=1).tobytes(), 4 * len(steps)
        out = [packed[w * stride - 4 * c : w * stride] for w, c in zip(range(1, n + 1), count.tolist(), strict=True)]
        for w in np.flatnonzero(spelt):  # words with characters that go by their bytes
            at, ids = int(lengths[w]), []
            while at:
                size, piece = int(back[at, w]), int(which[at, w])
                ids[:0] = [int(self.ids[piece])] if piece >= 0 else [self.byte_ids[b] for b in words[w][at - size : at]]
                at -= size
            out[w] = np.array(ids, np.int32).tobytes()
        return out

    def segment_long(self, word: bytes) -> bytes:
        """The best ids (packed) of one long word."""
        trie, n = self.trie, len(word)
        flat = np.frombuffer(word + bytes(trie.longest + 8), np.uint8).astype(np.int64)
        best, back, which = array("d", [-np.inf]) * (n + 1), array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for first in range(0, n, STRETCH):
            at = np.arange(first, min(n, first + STRETCH))
            lead = flat[at]
            at, lead = at[lead & 0xC0 != 0x80], lead[lead & 0xC0 != 0x80]
            sizes = np.minimum(np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))), n - at)
            found = [(at, sizes, np.full(len(at), -1), np.full(len(at), self.unknown))]
            live, state = at, np.zeros(len(at), np.int64)
            for depth in range(trie.longest):
                ahead = live + depth < n
                live, state = live[ahead], state[ahead]
                following = trie.base[state] + flat[live + depth]
                good = (trie.base[state] > 0) & (trie.check[following] == state)
                live, state = live[good], following[good]
                piece = trie.leaf[state]
                ends = piece >= 0
                found.append((live[ends], np.full(int(ends.sum()), depth + 1), piece[ends], self.scores[piece[ends]]))
            starts, sizes, pieces, scores = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(starts, kind="stable")
            for s, size, piece, score in zip(starts[order].tolist(), sizes[order].tolist(), pieces[order].tolist(), scores[order].tolist(), strict=True):
                total, end = best[s] + score, s + size
                if total > best[end] or (total == best[end] and size > back[end] and total > -np.inf):
                    best[end], back[end], which[end] = total, size, piece
        ids, at = array("i"), n
        while at:
            size, piece = back[at], which[at]
            ids.extend([int(self.ids[piece])] if piece >= 0 else [self.byte_ids[b] for b in reversed(word[at - size : at])])
            at -= size
        return np.array(ids, np.int32)[::-1].tobytes()

    @staticmethod
    def _better(best, back, which, rows, at, size, piece, score) -> None:
        end = at + size
        gain = (score > best[end, rows]) | ((score == best[end, rows]) & (size > back[end, rows]))
        r, e = rows[gain], end[gain]
        best[e, r], back[e, r], which[e, r] = score[gain], size[gain], piece[gain]

    def _learn(self, fresh: list[str]) -> None:
        """Segment new words, those of like length together so that the arrays stay small."""
        fresh.sort(key=len)
        at = 0
        while at < len(fresh):
            room = max(1, (1 << 20) // (4 * len(fresh[at]) + 64))
            part = fresh[at : at + room]
            while len(part) > 1 and len(part[-1]) > 2 * len(part[0]) + 8:
                part = part[: max(1, len(part) // 2)]
            self.known.update(zip(part, self.segment([w.encode("utf-8", "surrogatepass") for w in part]), strict=True))
            at += len(part)

    def _words(self, text: str) -> Iterator[list[str]]:
        """The words of a text, a slice at a time; a literal marker comes alone, as its bytes' stand-in."""
        for i, piece in enumerate(re.split(f"({MARK})", text) if MARK in text else (text,)):
            if i % 2:
                yield [LITERAL]
                continue
            lead = MARK if i == 0 and text else ""
            at = 0
            while True:
                border = BORDER.search(piece, at + SLICE)
                end = border.start() if border else len(piece)
                found = WORDS.findall(lead + piece[at:end].replace(" ", MARK))
                if found:
                    yield found
                if end == len(piece):
                    break
                at, lead = end, ""

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Each text's ids. New words are learnt from about a slice of text at a time."""
        out: list[np.ndarray | None] = [None] * len(texts)
        held: list[tuple[int, list[str]]] = []
        ids: dict[int, list[bytes]] = {}
        chars = 0

        def settle() -> None:
            fresh = set().union(*[found for _, found in held]).difference(self.known)
            if len(self.known) + len(fresh) > REMEMBER:
                self.known = {LITERAL: self.literal}
                fresh = set().union(*[found for _, found in held]) - {LITERAL}
            raw = {w: w.encode("utf-8", "surrogatepass") for w in fresh if len(w) > LONG // 4}
            long = {w: self.segment_long(b) for w, b in raw.items() if len(b) > LONG}
            if len(fresh) > len(long):
                self._learn([w for w in fresh if w not in long])
            for i, found in held:
                ids[i].append(b"".join([self.known[w] if w in self.known else long[w] for w in found] if long else map(self.known.__getitem__, found)))
            held.clear()

        for i, text in enumerate(texts):
            if text is None:
                continue
            ids[i] = []
            for found in self._words(text):
                held.append((i, found))
                chars += len(text) if len(text) < SLICE else SLICE
                if chars >= SLICE:
                    settle()
                    chars = 0
        settle()
        for i, parts in ids.items():
            out[i] = np.frombuffer(b"".join(parts), np.int32)
        return out


def load(name: str, kind: type = Model):
    """The model shipped with the job under ``name``; a worker process reads it once for all its tasks."""
    held = sys.__dict__.setdefault("_strandweave_models", {})
    key = SparkFiles.get(name), kind.__name__
    if key not in held:
        with open(key[0], "rb") as f:
            held[key] = kind(f.read())
    return held[key]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def ship(spark: SparkSession, path: str = MODEL) -> str:
    """Send the model file to all executors; returns its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, path: str = MODEL, text_col: str = "text", out_col: str = "ids", same_col: str | None = None) -> DataFrame:
    """``docs`` with ``out_col``: the text's ids as array<int>; ``same_col``: whether decoding them gives the text again."""
    name = ship(docs.sparkSession, path)
    added = [c for c in (same_col, out_col) if c]
    others = [c for c in docs.columns if c not in added]
    schema = docs.select(*[docs[f"`{c}`"] for c in others]).schema
    if same_col:
        schema = schema.add(same_col, T.BooleanType())
    schema = schema.add(out_col, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(name)
        for batch in _parts(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            ids = model.encode(texts)
            more = [pa.array(ids, pa.list_(pa.int32()))]
            if same_col:
                more.insert(0, pa.array([i is None or model.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*others, *added])

    return docs.select(*[docs[f"`{c}`"] for c in others]).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str = MODEL, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``out_col``: the ids' text."""
    name = ship(rows.sparkSession, path)
    others = [c for c in rows.columns if c != out_col]
    schema = rows.select(*[rows[f"`{c}`"] for c in others]).schema.add(out_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = load(name, Decoder)
        for batch in _parts(batches):
            at = batch.schema.get_field_index(ids_col)
            lists = batch.column(at)
            flat, ends, null = lists.values.to_numpy(), lists.offsets.to_numpy(), lists.is_null().to_pylist()
            texts = [None if null[i] else decoder.decode(flat[ends[i] : ends[i + 1]].tolist()) for i in range(len(null))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*others, out_col])

    return rows.select(*[rows[f"`{c}`"] for c in others]).mapInArrow(run, schema)
