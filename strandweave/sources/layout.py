"""Tables laid out by place: files of near rows with a table of the files' boxes, so that a box reads few of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandweave.operators.geometry import line_ends
from strandweave.operators.projections import geoprox_key

BOX = ("min_x", "min_y", "max_x", "max_y")


def line_boxes(v: DataFrame) -> DataFrame:
    """PRJ-10. (line_id, min_x, min_y, max_x, max_y, place_key): the box of each line and the lesser key of its two ends."""
    boxes = v.groupBy("line_id").agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"))
    keys = line_ends(v).select("line_id", F.least(geoprox_key(F.col("x1"), F.col("y1")), geoprox_key(F.col("x2"), F.col("y2"))).alias("place_key"))
    return boxes.join(keys, "line_id")


def write_by_place(rows: DataFrame, path: str, id_: str, rows_a_file: int = 1_000_000) -> None:
    """PRJ-10, SRT-1. Writes rows with a box and a place_key under ``path``: ``rows`` in files of about ``rows_a_file`` near rows,
    each sorted by key, and ``files`` with the box of each file.

    Files are ranges of (place_key, id), so many rows in one place are several files. Rows without a box lie in no
    box; they are kept in the first file.
    """
    files = max(1, -(-rows.count() // rows_a_file))
    rows.repartitionByRange(files, "place_key", id_).sortWithinPartitions("place_key", id_).write.parquet(f"{path}/rows")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")
    stored.groupBy(F.input_file_name().alias("file")).agg(*[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX], F.count("*").alias("n_rows")).write.parquet(f"{path}/files")


def meets(box: tuple[float, float, float, float]):
    """Whether a row's box meets the asked one, edges included."""
    x0, y0, x1, y1 = box
    return (F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0)


def read_box(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """SRC-7, PRJ-10. The rows of :func:`write_by_place` whose boxes meet ``box``. Only files whose own box does are opened; their
    names alone come to the driver, which lists the files of any scan. Within them the row groups are pruned by the
    same filter."""
    stored = spark.read.parquet(f"{path}/rows")
    names = [r.file for r in spark.read.parquet(f"{path}/files").where(meets(box)).select("file").collect()]
    return (spark.read.schema(stored.schema).parquet(*names) if names else stored.limit(0)).where(meets(box))
