"""Tables that cut lineage, kept in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"
_live: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local one is made on a local master (tests); on a
    cluster that is an error, for executors would each write to a disk of their own."""
    where = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="rillstone-")
        spark.conf.set(_SETTING, where)
    return where.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for path, spark in list(_live.items()):
        try:
            _remove(spark, path)
        except Exception:
            if path.startswith("file://") and os.path.isdir(path[7:]):
                import shutil

                shutil.rmtree(path[7:], ignore_errors=True)


atexit.register(_clean)


class Workspace:
    """Written tables of one operator's run. `cut` writes a table and reads it back; `drop` frees one that is superseded.

    A lost executor costs nothing that was cut: the files are in the shared folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/rillstone/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        _live[self.root] = spark

    def cut(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._rill_path = path
        return out

    def counted(self, df: DataFrame, **aggregates: Column) -> tuple[DataFrame, dict]:
        """cut, and aggregates over the rows that are written, counted on the way: no second job."""
        seen = Observation()
        out = self.cut(df.observe(seen, *[a.alias(k) for k, a in aggregates.items()]))
        return out, seen.get

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            path = getattr(t, "_rill_path", None)
            if path:
                _remove(self.spark, path)
