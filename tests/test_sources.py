"""Readers and sinks on small files."""

import gzip
import json

from pyspark.sql import functions as F, types as T

from strandweave.operators import projections
from strandweave.sources import readers, sinks


def test_typed_csv(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(" A ,B,Unknown\n 1 , x ,9\n,inf,9\nz, ,9\n")
    rows = readers.read_csv_typed(spark, str(tmp_path / "a.csv.gz"), T.StructType.fromDDL("a int, b string, c double")).collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (None, "inf", None), (None, None, None)]


def test_gtfs_feeds_of_two_agencies(spark, tmp_path):
    for agency, head, row in (("one", "trip_id,service_id,route_id", "t1,s1,r1"), ("two", "route_id,trip_id", "r2,t2")):
        (tmp_path / agency).mkdir()
        (tmp_path / agency / "trips.txt").write_text(f"{head}\n{row}\n")
        (tmp_path / agency / "notes.txt").write_text("x\n")
    feeds = readers.read_gtfs_feeds(spark, str(tmp_path))
    assert set(feeds) == {"trips"}
    rows = {(r.agency, r.trip_id, r.route_id, r.service_id) for r in feeds["trips"].collect()}
    assert rows == {("one", "t1", "r1", "s1"), ("two", "t2", "r2", None)}
    assert readers.read_gtfs(spark, str(tmp_path / "one"))["trips"].first().service_id == "s1"


def test_features(spark, tmp_path):
    lines = [{"type": "Feature", "id": "a", "properties": {"tmc": "a"}, "geometry": {"type": "LineString", "coordinates": [[0, 1], [1, 1]]}}, {"type": "Feature", "properties": {"tmc": "b"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 1], [1, 1]], [[2, 2], [3, 3]]]}}]
    (tmp_path / "f.ndjson").write_text("\n".join(map(json.dumps, lines)))
    rows = {r.id: len(r.parts) for r in readers.read_features(spark, str(tmp_path / "f.ndjson")).collect()}
    assert rows == {"a": 1, "b": 2}


def test_ndjson_hint(spark):
    df = spark.createDataFrame([(1, 8), (2, 0)], "segment_id long, road_class int")
    got = {r.id: json.loads(r.line)["tippecanoe"] for r in sinks.segments_to_ndjson(df).collect()}
    assert got == {1: {"layer": "paths", "minzoom": 14}, 2: {"layer": "major"}}


def test_collection_round_trip(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (1, '{"a":2}')], "g int, feature string")
    back = sinks.from_feature_collection(sinks.to_feature_collection(df, "g"))
    assert sorted(r.feature for r in back.collect()) == ['{"a":1}', '{"a":2}']


def test_a_box_reads_few_files(spark, tmp_path):
    """A box of a tenth of each side opens few of 40 files and gives what a filter gives; a third of all rows in one place
    are several files; rows without a place lie in no box; a box beside everything gives nothing."""
    from strandweave.sources import layout

    grid = spark.range(2700).selectExpr("id", "-74 + (id % 60) / 100 AS x", "40 + floor(id / 60) / 100 AS y")
    rows = grid.unionByName(spark.range(2700, 4000).selectExpr("id", "-73.805D AS x", "40.205D AS y")).selectExpr("id", "x AS min_x", "y AS min_y", "x + 0.004 AS max_x", "y + 0.004 AS max_y")
    rows = rows.withColumn("place_key", projections.geoprox_key(F.col("min_x"), F.col("min_y"))).unionByName(spark.createDataFrame([(4000, None, None, None, None, None)], "id long, min_x double, min_y double, max_x double, max_y double, place_key long"))
    path = str(tmp_path / "by-place")
    layout.write_by_place(rows, path, "id", rows_a_file=100)
    files = spark.read.parquet(f"{path}/files")
    assert 35 <= files.count() <= 41 and files.agg(F.max("n_rows")).first()[0] < 400 and files.agg(F.sum("n_rows")).first()[0] == 4001
    box = (-73.60, 40.10, -73.54, 40.145)
    got = layout.read_box(spark, path, box)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in rows.where(layout.meets(box)).collect()) and got.count() > 20
    assert len(got.inputFiles()) <= 6
    assert layout.read_box(spark, path, (-73.81, 40.20, -73.80, 40.21)).count() >= 1300
    assert layout.read_box(spark, path, (10.0, 10.0, 11.0, 11.0)).count() == 0


def test_lines_of_queries_are_compressed(spark, tmp_path, monkeypatch):
    """What a query writes to read it again takes a tenth of the lines' bytes."""
    from strandweave.plans import exchange

    lines = spark.range(5000).selectExpr("""concat('{"id":"', id, '","properties":{"part_start":0.5,"part_end":0.75,"tmc":{"edge_id":', id, '}}}') AS line""")
    monkeypatch.setattr(exchange, "folder", lambda t, name: str(tmp_path / name))

    class Given:
        _spark = spark

    got = exchange.read_lines(Given, lines, "lines", "id string, properties struct<tmc:struct<edge_id:bigint>>")
    assert {(r.f.id, r.f.properties.tmc.edge_id) for r in got.collect()} == {(str(i), i) for i in range(5000)}
    size = sum(p.stat().st_size for p in (tmp_path / "lines").iterdir())
    assert size < sum(len(r.line) for r in lines.collect()) / 10
