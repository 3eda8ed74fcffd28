"""Column helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: A term is a run of letters, digits and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def terms(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """While it lasts, Arrow batches to Python close at ``size`` bytes, whatever the session sets: a task holds one on both
    sides, twice over while it grows. For steps that are written at once; the plan is not changed."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)
