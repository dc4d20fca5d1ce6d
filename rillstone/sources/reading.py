"""Batches of a file that can't be read: which they are, when to give up, and the table without them.

A batch is a row group of a parquet file or a record batch of an Arrow file. Tasks decode batch by batch; a batch that
fails is a finding, not the end of the job.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.sources.arrow_ipc import _filesystem, _plain, batch_rows

#: Failures in a row, and in all, after which a table is given up.
IN_A_ROW, IN_ALL = 3, 10


def _sizes(path: str, kind: str) -> list[int]:
    fs, p = _filesystem(path)
    with fs.open_input_file(p) as f:
        if kind == "arrow":
            return batch_rows(f, f.size())
        import pyarrow.parquet as pq

        meta = pq.ParquetFile(f).metadata
        return [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]


def _batch(path: str, kind: str, number: int, columns: list[str] | None = None) -> pa.Table:
    fs, p = _filesystem(path)
    with fs.open_input_file(p) as f:
        if kind == "arrow":
            t = pa.Table.from_batches([pa.ipc.open_file(f).get_batch(number)])
            t.validate(full=True)
            return t.select(columns) if columns else t
        import pyarrow.parquet as pq

        return pq.ParquetFile(f).read_row_group(number, columns=columns)


def listing(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """path, batch, first (row of the file), n_rows, from the footer; some batches to a partition."""
    sizes = pd.Series(_sizes(path, kind), dtype="int64")
    rows = pd.DataFrame({"batch": range(len(sizes)), "first": sizes.cumsum().shift(fill_value=0).astype("int64"), "n_rows": sizes})
    rows.insert(0, "path", path)
    return spark.createDataFrame(rows.astype({"path": "str"}), "path string, batch int, first long, n_rows long").repartition(max(1, min(len(rows), 2000)), "batch")


def unreadable(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """batch, problem of the batches that can't be decoded."""

    def run(frames):
        for pdf in frames:
            bad = []
            for b in pdf["batch"]:
                try:
                    _batch(path, kind, int(b))
                except (OSError, ValueError, pa.ArrowException) as e:
                    bad.append((b, str(e)[:200]))
            yield pd.DataFrame(bad, columns=["batch", "problem"]).astype({"batch": "int32", "problem": "str"})

    return listing(spark, path, kind).select("batch").mapInPandas(run, "batch int, problem string")


def findings(bad: DataFrame, artifact: str) -> tuple[list[tuple], bool]:
    """(diagnostics up to the point where reading is given up, whether it is): the third failure in a row or the tenth in
    all. Of the failures at most IN_ALL come to the driver."""
    run = F.col("batch") - F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("batch"))  # failures only, few by nature
    streak = bad.withColumn("run", run).withColumn("nth", F.row_number().over(Window.partitionBy("run").orderBy("batch")))
    rows = streak.orderBy("batch").limit(IN_ALL).collect()
    out, stop = [], False
    for k, r in enumerate(rows, 1):
        out.append((f"{artifact}.batch_read", "ERROR", "Schema", artifact, f"batch {r.batch} can't be read: {r.problem}"))
        if r.nth >= IN_A_ROW or k >= IN_ALL:
            out.append((f"{artifact}.batch_read_aborted", "ERROR", "Schema", artifact, f"reading given up after {k} failures"))
            stop = True
            break
    return out, stop


def without(spark: SparkSession, path: str, kind: str, bad: DataFrame, schema: StructType) -> DataFrame:
    """The table of the readable batches, with _row, the record's place in the file."""
    names = [f.name for f in schema.fields if f.name != "_row"]

    def run(batches):
        for batch in batches:
            for number, first in zip(batch["batch"].to_pylist(), batch["first"].to_pylist()):
                t = _batch(path, kind, number, names)
                for b in t.to_batches(max_chunksize=65_536):
                    cols = [_plain(b[c]) for c in names]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(range(first, first + b.num_rows), pa.int64())], [*names, "_row"])
                    first += b.num_rows

    good = listing(spark, path, kind).join(F.broadcast(bad.select("batch").limit(IN_ALL)), "batch", "left_anti")
    out = StructType([f for f in schema.fields if f.name != "_row"]).add("_row", "long")
    return good.select("batch", "first").mapInArrow(run, out)
