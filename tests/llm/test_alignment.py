"""Alignment of two tokenizers against the definition, token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandweave.llm import alignment


@pytest.fixture(scope="module")
def own():
    tokenizers, sentencepiece = pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    a = tokenizers.Tokenizer.from_file(alignment.A_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.B_MODEL)


def byte_table():
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    table, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def brute(texts, own):
    a, b = own
    table, docs = byte_table(), []
    for text in texts:
        docs.append(None)
        if not text:
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            continue
        ends = []
        for raw in (raw_a, raw_b):
            at, of = 0, []
            for x in raw:
                at += len(x)
                of.append(at)
            ends.append(of)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for p in both:
            m, n = ends[0].index(p) + 1, ends[1].index(p) + 1
            groups.append(",".join(map(str, ids_a[i:m])) + "|" + ",".join(map(str, ids_b[j:n])))
            links.append((ids_a[m - 1], ids_b[n - 1]))
            i, j = m, n
        docs[-1] = (len(ids_a), len(ids_b), groups, links)
    count = Counter(l for d in docs if d for l in d[3])
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            sha = hashlib.sha256(";".join(d[2]).encode()).hexdigest()
            out.append((d[0], d[1], len(d[2]), len(d[3]), sum(count[l] == most[l[1]] for l in d[3]), sum(count[l] for l in d[3]), sha))
    return out, count, most


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}


def test_equals_brute_force(spark, own, monkeypatch):
    rng = random.Random(2)
    some = ["The", "tokenizer's", "naïve", "日本語", "don't", "x1y2", "\n", "  ", "supercalifragilistic", "1234567", "\t", "😀!", "<s>", "<|endoftext|>", "a-b_c", "..."]
    texts = [" ".join(rng.choice(some) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    texts += [None, "", " ", "\n", "a", "  lead", "trail  ", "▁ marked ▁", "é", "x" * 400, texts[0], texts[0], "word " * 300, "\x00 nul"]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, block string")
    expected, count, most = brute(texts, own)
    monkeypatch.setattr(alignment, "REMEMBER", 50)
    for chars in (1, 300, 1 << 21):
        assert rows(alignment.aligned_documents(docs, chars=chars)) == dict(enumerate(expected))
    got = {(r.a_id, r.b_id): (r.n, r.best) for r in alignment.token_pairs(docs).collect()}
    assert got == {k: (n, n == most[k[1]]) for k, n in count.items()}


def test_whole_table_equals_brute_force(spark, own):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = docs.select("doc_id", "text").collect()
    expected, _, _ = brute([r.text for r in held], own)
    assert rows(alignment.aligned_documents(docs)) == {r.doc_id: x for r, x in zip(held, expected, strict=True)}


def test_missing_ids_repeated_rows_and_empty_tables(spark, own):
    docs = spark.createDataFrame([(None, "one two"), (3, "one two"), (3, "one two"), (4, None)], "doc_id long, text string")
    expected, _, _ = brute(["one two"] * 3 + [None], own)
    got = sorted((tuple(r) for r in alignment.aligned_documents(docs).collect()), key=str)
    assert [r[0] for r in got] == [3, 3, 4, None]
    assert all(r[1:4] == expected[0][:3] and r[6] == expected[0][5] for r in got if r[0] != 4)
    assert alignment.aligned_documents(docs.limit(0)).collect() == []


def test_windows_are_cut_at_shared_anchors_only():
    from strandweave.llm.public_ids import PublicIds

    own = alignment.Aligner(PublicIds(alignment.A_MODEL), PublicIds(alignment.B_MODEL))
    docs = [own.tokens("one two  three\nfour don't"), own.tokens("one five")]
    kinds, order, ends = own.windows(docs)
    assert ends.tolist()[-1] == len(order) and len(set(kinds)) == len(kinds)
    spelt = []
    for a, b in (kinds[i] for i in order):
        sides = [b"".join(m.bytes_of[i] for i in np.frombuffer(x, np.uint32)) for m, x in zip(own.models, (a, b), strict=True)]
        assert sides[0] == sides[1] and sides[0][:1] == b" "
        spelt.append(sides[0])
    assert b"".join(spelt) == b" one two  three\nfour don't one five" and len(spelt) >= 5


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 3, 400).astype(np.uint32) for _ in range(2)]
    cuts = [np.arange(0, 401, 2), np.arange(0, 401, 2)]
    kind = lambda i: (bytes(ids[0][2 * i : 2 * i + 2]), bytes(ids[1][2 * i : 2 * i + 2]))
    for reduced in (False, True):
        if reduced:
            class Colliding:
                reduceat = staticmethod(lambda x, at: np.zeros(len(at), np.uint64))

            monkeypatch.setattr(alignment.np, "add", Colliding)
        first, order = alignment._distinct(ids, cuts)
        assert [kind(i) for i in range(200)] == [kind(first[k]) for k in order]
        assert len({kind(i) for i in first}) == len(first)
