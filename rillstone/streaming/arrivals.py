"""Structured Streaming over folders into which basins' files arrive.

Row-local checks need no state: each micro-batch is checked by the same operators as a whole table and appended to a
diagnostics table. References are checked against the parents known when a batch arrives, so a reference whose parent
comes later is reported once, as late arrivals are in the batch operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def follow(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files of a folder as a stream, with the file's path as `source_file`."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder).withColumn("source_file", F.col("_metadata.file_path"))


def check_arrivals(stream: DataFrame, check: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs check (table to diagnostics) on each micro-batch; results go to target/batch=N, which a repeat overwrites."""

    def one(batch: DataFrame, number: int) -> None:
        check(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def counts_by_window(stream: DataFrame, time: str, width: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Rows per window of arrival and feed; windows close when the watermark has passed them."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("window"), "feed").agg(F.count(F.lit(1)).alias("n_rows"))
