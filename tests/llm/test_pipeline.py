"""The corpus pipeline end to end, and each stage's own promise on the documents it gets."""

import os

import pytest

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_stages_keep_columns_and_only_remove(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        rows = out.collect()
        left = {r.doc_id for r in rows}
        assert left and left <= ids and len(left) == len(rows)
        docs, ids = spark.createDataFrame(rows, out.schema), left
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").isEmpty()


def test_copies_leave_one_document(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(2, text, "en", "a", 1), (1, text, "en", "a", 1), (3, text.replace("word7 ", "Word7 "), "en", "b", 1), (4, " ".join(f"other{i}" for i in range(60)), "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == {1, 4}


def test_near_copies_are_the_pairs_at_jaccard_of_four_fifths(spark):
    """Every pair of 300 words with 3 to 9 of them replaced, against brute force on the sets."""
    import random

    from strandweave.llm import near_copies

    draw, texts = random.Random(5), []
    for _ in range(30):
        base = [f"w{draw.randrange(10_000)}" for _ in range(300)]
        for changes in (0, 3, 5, 6, 7, 9):
            copy = list(base)
            for i in draw.sample(range(5, 295), changes):
                copy[i] = f"x{draw.randrange(10_000)}"
            texts.append(" ".join(copy))
    texts += [None, "", texts[0], "few words"]
    shingles = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(shingles):
        for j, b in enumerate(shingles[:i]):
            if (not a and not b) or len(a & b) / len(a | b) >= 0.8:
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    assert [got[i] for i in range(len(texts))] == root
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == set(root)


def test_texts_alike_but_below_the_threshold_are_not_compared_pairwise(spark, monkeypatch):
    """200 texts of one base, two by two at a similarity of about 0.6, and near copies of ten of them."""
    import random

    from strandweave.llm import near_copies

    draw, base = random.Random(6), [f"w{i}" for i in range(200)]

    def changed(words: list[str], changes: int) -> list[str]:
        copy = list(words)
        for i in draw.sample(range(5, 195, 5), changes):
            copy[i] = f"x{draw.randrange(10**9)}"
        return copy

    texts = [changed(base, 5) for _ in range(200)]
    texts += [changed(t, 1) for t in texts[::20]]
    shingles = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(shingles):
        for j, b in enumerate(shingles[:i]):
            if len(a & b) / len(a | b) >= 0.8:
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    real, made = near_copies.cut, []

    def counted(df, name="cut"):
        out = real(df, name)
        if out.columns == ["a", "b"]:
            made.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "cut", counted)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    assert [got[i] for i in range(len(texts))] == root
    assert 150 < len(set(root)) <= 200  # most stay apart
    assert sum(made[2:]) < 10 * len(texts)  # after those of the trees


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_rare_shingles_bring_all_similar_sets_of_different_groups_together(spark, threshold):
    """Sets of odd sizes with common and rare shingles, against brute force."""
    import random

    from strandweave.llm import near_copies

    draw, sets = random.Random(7), []
    for _ in range(12):
        base = [int(20 * draw.random() ** 3) if draw.random() < 0.3 else draw.randrange(10**6) for _ in range(draw.randrange(1, 40))]
        for _ in range(6):
            sets.append(sorted({x for x in base if draw.random() < 0.95} | {draw.randrange(10**6) for _ in range(draw.randrange(3))} or {0}))
    groups = [draw.randrange(40) for _ in sets]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "fp long, shingles array<long>")
    members = spark.createDataFrame(list(enumerate(groups)), "fp long, group long")
    met = {(r.a, r.b) for r in near_copies.meeting_pairs(rows, members, threshold).collect()}
    alike = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if groups[i] != groups[j] and len(set(a) & set(b)) / len(set(a) | set(b)) >= threshold}
    assert alike and alike <= met and all(i < j and groups[i] != groups[j] for i, j in met)
