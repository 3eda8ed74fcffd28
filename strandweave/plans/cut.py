"""Cutting lineage with tables in the shared checkpoint folder.

Iterative operators write their state as Parquet below ``spark.checkpoint.dir`` and read it again: the
files outlive any executor, unlike cached or locally checkpointed blocks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names. Where none is set, one of our own, but only if all tasks run in this process: on
    a cluster executors would not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="spark-strandweave-")
    return _OWN[app]


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and return it read back, with a plan that starts at the files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the files of superseded :func:`cut` tables."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            jvm, jsc = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


class Log:
    """Tables that rows are only added to. Of eight tables of one level one of the next is made, so a row is written again as
    often as the number of tables has digits. ``view``: which of a table's rows and columns are the log's."""

    def __init__(self, *tables: DataFrame, view: Callable[[DataFrame], DataFrame] = lambda t: t):
        self.levels: list[list[DataFrame]] = [list(tables)]
        self.view = view

    def rows(self) -> DataFrame | None:
        every = [self.view(t) for level in self.levels for t in level]
        return reduce(DataFrame.unionByName, every) if every else None

    def add(self, table: DataFrame) -> None:
        """What was added before may be moved now; ``table`` itself stays until the next call."""
        for i, level in enumerate(self.levels):
            if len(level) < 8:
                break
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(cut(reduce(DataFrame.unionByName, map(self.view, level)), "log"))
            release(*level)
            self.levels[i] = []
        self.levels[0].append(table)
