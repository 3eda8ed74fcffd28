"""Packing against brute force: every token once, no sequence too long, as few as the lengths allow."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strandweave.llm import packing, public_ids


@pytest.fixture(scope="module")
def own():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(packing.VOCABULARY)


def placed(rows, size):
    """The pieces by sequence; asserts that they stand there without gaps."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for held in by.values():
        at = 0
        for r in sorted(held, key=lambda r: (r.offset, r.length)):
            assert r.offset == at
            at += r.length
        assert at <= size
    return by


def test_every_token_is_packed_once(spark, own):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["tale", "of", "Ünïts", "日本", "\n", "x1"]) for _ in range(rng.choice([1, 3, 40, 300]))) for _ in range(120)]
    texts += [None, "", " ", "word " * 900, texts[0], texts[0], "y" * 700]
    docs = spark.createDataFrame([(i if i != 5 else None, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, sequence_id string")
    size = 128
    got = packing.packed_documents(docs, size, block=20, fan=2).collect()
    by = placed(got, size)
    of = defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
    assert len(of) == len(texts)
    total = 0
    for i, t in enumerate(texts):
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        mine = sorted(of[i if i != 5 else None], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine])[:-1])
        assert sum(r.length for r in mine) == len(ids) and all(r.length == size for r in mine[1:])
        assert len(mine) == 1 or len(ids) > size
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert sum(r.length for r in got) == total
    assert len(by) <= len(packing._best_fit([(r.length, []) for r in got], size)) + 3


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")] * 50, "doc_id long, text string")
    got = packing.packed_documents(docs, 16).collect()
    assert len(got) == 50 and len(placed(got, 16)) == -(-50 // (16 // 3))
    assert packing.packed_documents(docs.limit(0)).collect() == []


def test_residual_bins_meet_over_levels(spark):
    """Long and short pieces that lie in different tasks' blocks still share sequences where only a few are short."""
    rows = [(i, 0, 0, 11, 0) for i in range(300)] + [(1000 + i, 0, 0, 5, 0) for i in range(12)]
    found = spark.createDataFrame(rows, "doc_id long, piece int, start long, length int, ids_crc32 long")
    got = packing.pack(found, 16, block=30, fan=4).collect()
    assert len(got) == len(rows) and len(placed(got, 16)) == 300


def test_hot_lengths_need_no_more_than_best_fit(spark):
    rng = random.Random(8)
    lengths = [rng.choice([2048, 700, 683, 1100, rng.randint(1, 2048), rng.randint(1, 300)]) for _ in range(3000)]
    found = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length int, ids_crc32 long")
    n = len(placed(packing.pack(found, block=200, fan=4).collect(), 2048))
    alone = len(packing._best_fit([(x, []) for x in lengths], 2048))
    assert n <= 1.02 * alone


def test_ids_equal_the_library_over_a_whole_table(own):
    import pyarrow.parquet as pq

    tokens = public_ids.PublicIds(packing.VOCABULARY)
    assert tokens.run.__name__ == "encode_ordinary"
    odd = ["", " ", "  a", "a  b \n c\n", "\n a", "a  b x", "▁a ▁ b", "x" * 3000, "don't  'll  ", "a\t b", "\x1c a \x1c", "é ñ  z", "\U0001f600 ́"]
    for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist() + odd:
        assert tokens.encode(t).tolist() == own.encode(t, add_special_tokens=False).ids
    own.encode_special_tokens = True
    assert tokens.encode("a <|endoftext|> b").tolist() == own.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert [b"".join(tokens.bytes_of[i] for i in tokens.encode(t)) for t in odd] == [t.encode() for t in odd]


def test_slices_give_the_same_ids(monkeypatch):
    text = " ".join(random.Random(1).choice(["one", " two", "three\n", "fo ur", "", "\t"]) for _ in range(4000))
    for path in (packing.VOCABULARY, "/opt/tokenizers/piece_bpe_32k.model"):
        tokens = public_ids.PublicIds(path)
        whole = tokens.encode(text).tolist()
        monkeypatch.setattr(public_ids, "SLICE", 50)
        assert tokens.encode(text).tolist() == whole
        monkeypatch.undo()


def test_other_vocabularies_go_to_their_own_library(tmp_path):
    spec = json.load(open(packing.VOCABULARY))
    spec["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "other.json").write_text(json.dumps(spec))
    assert public_ids.PublicIds(str(tmp_path / "other.json")).encode("A b").tolist() == public_ids.PublicIds(packing.VOCABULARY).encode("a b").tolist()
