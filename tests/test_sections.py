"""Boundary cases and invariants of sections and assignment."""

import random

from strandweave.operators import assign, sections

SECTION = "ref_id long, edge_id long, is_forward int, section_start double, section_end double"
CLAIM = "path_id long, path_edge_idx int, edge_id long, is_forward int, match_idx int, ref_id long, section_start double, section_end double"


def test_touching_sections_do_not_dispute(spark):
    rows = [(1, 0, 1, 1, 0, 1, 0.0, 0.4), (2, 0, 2, 1, 0, 1, 0.4, 0.9)]
    assert assign.find_disputes(spark.createDataFrame(rows, CLAIM)).isEmpty()


def test_nested_claim_is_one_dispute_of_two(spark):
    rows = [(1, 0, 1, 1, 0, 1, 0.0, 0.9), (2, 0, 2, 1, 0, 1, 0.2, 0.3)]
    assert assign.find_disputes(spark.createDataFrame(rows, CLAIM)).count() == 2


def test_short_claim_loses(spark):
    rows = [(1, 0, 1, 1, 0, 1, 0.0, 0.9), (2, 0, 2, 1, 0, 1, 0.2, 0.25)]
    assert [r.path_id for r in assign.rule_epsilon(spark.createDataFrame(rows, CLAIM)).collect()] == [1]


def test_single_edge_path_has_no_trimmability(spark):
    chosen = spark.createDataFrame([(1, 0, 1, 1, 0, 1, 0.0, 0.9)], CLAIM)
    last = spark.createDataFrame([(1, 0)], "path_id long, last_idx int")
    row = assign.trimmability(chosen, last).first()
    assert row.start_trimmable is None and row.end_trimmable is None


def test_gap_is_closed_unless_strict(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.0, 0.1), (1, 1, 1, 0.5, 0.6)], SECTION)
    assert sections.consolidate_sections(df).count() == 1
    assert sections.consolidate_sections(df, strict=True).count() == 2


def test_partitions_tile_the_reference(spark):
    draw = random.Random(5)
    refs = spark.createDataFrame([(i, 0.9) for i in range(20)], "ref_id long, length_km double")
    rows = []
    for i in range(200):
        a = round(draw.random() * 0.95, 5)
        rows.append((draw.randrange(20), i, 1, a, round(a + draw.random() * 0.2, 5)))
    rows += [(1, 999, 1, 0.3, 0.30005)]
    parts = sections.partition_sections(refs, spark.createDataFrame(rows, SECTION)).orderBy("ref_id", "part_start").collect()
    for ref in range(20):
        own = [(p.part_start, p.part_end) for p in parts if p.ref_id == ref]
        assert own[0][0] == 0 and own[-1][1] == 0.9
        assert all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
        assert all(b - a > 0.00009 for a, b in own)


def test_binned_join_equals_plain_join(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(3), i, 1, a, a + draw.random() * 0.3 + 0.001) for i in range(150) for a in [draw.random()]]
    df = spark.createDataFrame(rows, SECTION)
    want = sum(1 for a in rows for b in rows if a[0] == b[0] and a[3] < b[4] and b[3] < a[4])
    assert sections.binned_overlap_join(df, df, 0.1).count() == want


def test_settle_is_idempotent_and_only_removes(spark):
    draw = random.Random(3)
    rows = []
    for i in range(60):
        a = round(draw.random(), 3)
        rows.append((i % 12, 0, i % 15, 1, i, draw.randrange(6), a, round(a + 0.1, 3)))
    claims = spark.createDataFrame(rows, CLAIM)
    run = assign.Disputes(claims)
    run.settle()
    once = run.state()
    left, awards = {tuple(r) for r in once.claims.collect()}, [tuple(r) for r in once.awards.collect()]
    assert left <= {tuple(r) for r in claims.select(*once.claims.columns).collect()} and len(left) == run.n
    run.settle()
    twice = run.state()
    assert {tuple(r) for r in twice.claims.collect()} == left and sorted(map(tuple, twice.awards.collect())) == sorted(awards)
    keys = [(r[0], r[3]) for r in awards]
    assert len(keys) == len(set(keys))


def test_rules_judge_only_disputes_that_changed(spark):
    rows = [(p, 0, p, 1, 0, ref, 0.0, 0.5) for ref in range(4) for p in (10 * ref, 10 * ref + 1)]
    run, met = assign.Disputes(spark.createDataFrame(rows, CLAIM)), []

    def drop(*paths):
        def rule(claims):
            met.append(sorted({r.ref_id for r in claims.collect()}))
            return claims.where(~claims.path_id.isin(list(paths)))

        return rule

    run.judge("a", drop(1, 11))  # two disputes are left with one party, and settled
    run.judge("a", drop(99))
    run.judge("a", drop(99))
    run.judge("b", drop(20))
    run.judge("a", drop(99))
    assert met == [[0, 1, 2, 3], [], [2, 3], []] and run.n == 2
    assert sorted(r.ref_id for r in run.state().awards.collect()) == [0, 1, 2]


def test_sweep_over_a_hot_reference_equals_plain_order(spark):
    """A third of all points on one reference: neighbours and numbers as in one order, no task with more than a bin."""
    draw = random.Random(7)
    points = sorted({(1 if i % 3 == 0 else draw.randrange(2, 40), round(draw.random() * 30, 4)) for i in range(3000)})
    df = spark.createDataFrame(points, "ref_id long, at double")
    got = {(r.ref_id, r.at): (r["__prev"], r["__next"], r["__number"], r["__total"]) for r in sections.sweep(df, ["ref_id"], "at").collect()}
    for ref in {r for r, _ in points}:
        own = [at for r, at in points if r == ref]
        for i, at in enumerate(own):
            assert got[ref, at] == (own[i - 1] if i else None, own[i + 1] if i + 1 < len(own) else None, i, len(own))
    assert df.withColumn("bin", sections.F.floor(df.at / sections.BIN_KM)).groupBy("ref_id", "bin").count().agg({"count": "max"}).first()[0] < 40


def test_strict_consolidation_equals_plain_unions(spark):
    draw = random.Random(11)
    rows = [(1, i % 4, 1, a, a + draw.choice([0.02, 0.3, 1.5])) for i in range(300) for a in [round(draw.random() * 40, 4)]]
    got = sorted((r.edge_id, round(r.section_start, 6), round(r.section_end, 6)) for r in sections._islands(spark.createDataFrame(rows, SECTION), ["ref_id", "edge_id", "is_forward"], 1e-5).collect())
    want = []
    for edge in range(4):
        union = []
        for _, _, _, a, b in sorted(r for r in rows if r[1] == edge):
            if union and a - union[-1][1] <= 1e-5:
                union[-1][1] = max(union[-1][1], b)
            else:
                union.append([a, b])
        want += [(edge, round(a, 6), round(b, 6)) for a, b in union]
    assert got == sorted(want)
