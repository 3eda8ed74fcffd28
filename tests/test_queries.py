"""Every registered query that has SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from strandweave.plans import oracles, queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    found = duck.execute(oracles.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(tuple(plain(row[i]) for i in order) for row in found.fetchall())
    assert sorted(tuple(map(plain, row)) for row in df.select(*columns).collect()) == want


@pytest.fixture(scope="module")
def far_towns(spark, tmp_path_factory):
    """Parts whose towns lie at latitudes named 93 and 130, as those of tables sixty times sf0.1 do."""
    folder = tmp_path_factory.mktemp("far")
    parts = spark.createDataFrame([(k, k % 50) for first in (959_760, 1_620_000) for k in range(first, first + 720)], "p_partkey long, p_size int")
    parts.coalesce(1).write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("name", ["base_map_anomalies", "best_chains", "cospatial_chords", "loaded_paths", "match_edges"])
def test_query_equals_sql_beyond_a_pole(spark, far_towns, name):
    df = queries.queries()[name](spark, str(far_towns))
    with duckdb.connect() as con:
        con.execute(f"create view part as select * from '{far_towns}/part.parquet/*.parquet'")
        found = con.execute(oracles.oracle_sql()[name])
        names = [d[0] for d in found.description]
        want = sorted(tuple(map(plain, row)) for row in found.fetchall())
    assert sorted(tuple(map(plain, row)) for row in df.select(*names).collect()) == want and want


def test_chains_with_plans_made_at_run_time(spark):
    """Large tables' joins are sorted ones, and their plans change as stages end."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for c, v in zip(before, ("true", "-1", "16")):
        spark.conf.set(c, v)
    try:
        assert queries.queries()["best_chains"](spark, DATA).count() > 0
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
