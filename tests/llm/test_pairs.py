"""Embedding and SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from strandweave.llm import embedding_dedup, simhash


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    vectors = [b + 0.05 * rng.standard_normal(16) for b in base for _ in range(int(rng.integers(1, 6)))]
    vectors += [base[0] + 0.02 * rng.standard_normal(16) for _ in range(60)]
    vectors += [vectors[3], vectors[3], vectors[3] * 4]
    rows = [(i, [float(x) for x in v], "clash") for i, v in enumerate(vectors)]
    unit = np.stack(vectors)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    comp = union(len(rows), np.argwhere(near).tolist())
    odd = [(1000, None, ""), (1001, [0.0] * 16, ""), (1002, [1.0, None], ""), (1003, [float("nan")] * 16, ""), (1004, [], ""), (1005, [float("inf")] * 16, "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, component_id string")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, passes=8, window=16, block=20).collect()}
    assert len(got) == len(rows) + len(odd)
    for i in range(len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (int(near[i].sum()) - 1, comp[i], comp[i] == i)
    for o in odd:
        assert (got[o[0]].n_links, got[o[0]].component_id) == (0, o[0])


def test_embeddings_with_repeated_and_missing_ids(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v), (5, v), (7, [2.0, 4.0, 6.01]), (None, v), (None, None)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), passes=2).collect()), key=str)
    assert got == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (None, 0, None, False), (None, 0, None, False)]


def test_passes_follow_the_number_of_vectors():
    """The pairs that random keys bring together among rows of two sizes, against the stated recall."""
    assert embedding_dedup.passes_for(10, 2048, 512, 0.995) == embedding_dedup.LEAST
    some = [embedding_dedup.passes_for(10**k, 2048, 512, 0.995) for k in (5, 6, 7, 8)]
    assert some == sorted(some) and some[0] < some[-1]


def test_embeddings_of_an_empty_table(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), passes=2).isEmpty()


def fingerprint(text, shingle):
    tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
    tokens = [t for t in tokens if t]
    if not tokens:
        return 0
    parts = [" ".join(tokens[i : i + shingle]) for i in range(max(1, len(tokens) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_covering_masks_meet_for_every_pair_in_the_radius():
    draw = random.Random(1)
    for radius in (1, 3, 4, 6):
        masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(radius, 7)]
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(300):
            x, flips = draw.getrandbits(64), draw.sample(range(64), radius)
            y = x ^ sum(1 << f for f in flips)
            assert any(x & m == y & m for m in masks)


@pytest.mark.parametrize("bucket", [4096, 3])
def test_simhash_equals_brute_force(spark, bucket):
    """A small bucket sends nearly everything through further rounds."""
    draw = random.Random(2)
    vocabulary = [f"Wörd{i}" for i in range(200)]
    texts = []
    for _ in range(25):
        base = [draw.choice(vocabulary) for _ in range(draw.randrange(1, 300))]
        for _ in range(draw.randrange(1, 6)):
            copy = list(base)
            copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", " \t", texts[0], texts[0].upper(), "one", "Ä"]
    fps = [fingerprint(t.replace("\t", " ") if t else t, 4) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    comp = union(len(texts), pairs)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    got = {r.doc_id: r for r in simhash.near_duplicates(df, bucket=bucket).collect()}
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == comp


def test_simhash_of_very_long_and_repeated_rows(spark):
    text = "a b c d e " * 60_000
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text + "f")], "doc_id long, text string")
    got = simhash.near_duplicates(rows).collect()
    assert len(got) == 4 and {r.component_id for r in got} == {1}
    assert simhash.one_of_each(rows).count() == 3  # both rows of id 1, and the one without an id
    assert simhash.near_duplicates(rows.limit(0)).isEmpty()


def test_wide_fingerprints_begin_with_the_fingerprint():
    from strandweave.llm import near_copies

    for text in ("one", "a b c d e f g h i", " ".join(f"w{i}" for i in range(700))):
        wide = simhash.wide_fingerprint(near_copies.shingle_set(text, 5))
        assert len(wide) == 8 * simhash.LONGS and wide[:8] == simhash.text_fingerprint(text, 5)


def test_masks_of_a_word_hide_any_two_places():
    from itertools import combinations

    for width in (14, 20):
        masks = [set(m) for m in simhash.word_masks(width)]
        for n in range(5):
            hidden = [any(not m & set(d) for m in masks) for d in combinations(range(width), n)]
            assert np.isclose(np.mean(hidden), simhash.met(width, n)) and (n > 2 or all(hidden))


@pytest.mark.parametrize("n", [1, 11_000_000])
def test_sets_at_four_fifths_share_a_word_key(n):
    rng, pairs = np.random.default_rng(3), []
    for size in (10, 30, 300):  # 8 of 10 and so on are common
        for _ in range(400):
            h = rng.integers(0, 1 << 64, size, np.uint64)
            a, b = h[: size * 9 // 10], np.concatenate([h[: size * 8 // 10], h[size * 9 // 10 :]])
            pairs.append([np.frombuffer(simhash.wide_fingerprint(x), np.int64) for x in (a, b)])
    x, y = np.array(pairs).transpose(1, 0, 2)
    rate = simhash.similarity_rate(0.8)
    plan = simhash.word_plan(n, rate)
    assert (simhash.word_keys(x, *plan) == simhash.word_keys(y, *plan)).any(axis=1).all()
    for longs in (simhash.CARRIED, simhash.LONGS):
        assert np.bitwise_count((x ^ y)[:, :longs].view(np.uint64)).sum(axis=1).max() <= simhash.within(64 * longs, rate)


@pytest.mark.parametrize("tiled", [8192, 10])
def test_bucket_groups_hang_together_as_by_brute_force(monkeypatch, tiled):
    """Runs of equal keys that end inside a batch, at its end and after several, by tiles and without."""
    import pyarrow as pa

    monkeypatch.setattr(simhash, "TILED", tiled)
    monkeypatch.setattr(simhash, "TILE", (8, 32))
    rng, rows = np.random.default_rng(4), []
    for key, size in enumerate((1, 300, 49, 2, 60, 1)):
        base = rng.integers(0, 1 << 64, (9, 3), np.uint64)
        for _ in range(size):
            flip = np.packbits(rng.random((3, 64)) < 0.14, axis=1).view(np.uint64)[:, 0]
            rows.append([key, len(rows), *(base[rng.integers(9)] ^ flip).view(np.int64)])
    table = np.array(rows, np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in table[at : at + 50].T], names=list("abcde")) for at in range(0, len(table), 50)]
    out = list(simhash._bucket_groups(50)(iter(batches)))
    got = [(r["a"], r["b"]) for b in out for r in b.to_pylist()]
    bits = table[:, 2:].view(np.uint64)
    near = (table[:, :1] == table[:, 0]) & (np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2) <= 50)
    assert got and all(near[a, b] for a, b in got)
    assert union(len(rows), got) == union(len(rows), np.argwhere(near).tolist())
    assert len(got) == len(rows) - len(set(union(len(rows), got)))  # a tree
