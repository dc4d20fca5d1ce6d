"""References to records that are unknown, withdrawn or not yet there.

Method: parent keys are compressed to runs of contiguous integers. A run has its start, its end and one slot per key
for the times that matter (first load, first withdrawal), so a run of 1,000 keys is one row. Runs end at block borders
(BLOCK keys), which makes each block whole in itself: a reference is matched as of the preceding run start within its
block, and lies beyond the run's end if the parent does not exist.

References are first collapsed to distinct (field, record, key, month) with the first and last time, map-side, so a
key that a third of the rows name and that is its own record becomes a few rows. A block that more than HOT of them
still name is joined in parts of some HOT each: its compact runs are repeated, never the references.

Defined results: null and 0 keys are no references; a null time is after nothing and before nothing; a withdrawal
without time never took effect, but its key is known; repeated rows give one result row. Negative keys are ordinary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.storage import Workspace

#: Keys to a block, a power of two. A block's runs hold at most so many slots.
BLOCK = 256
#: References of a block that are joined in one part.
HOT = 100_000


def _block(key: Column) -> Column:
    return F.shiftright(key.cast("long"), BLOCK.bit_length() - 1)


def parent_runs(loads: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """block, runs: array of (run_start, run_end, loaded[], withdrawn[]) by run_start.

    loads: key, at - rows of the parent table; withdrawals: key, at. Times are kept as microseconds.
    """
    micros = F.unix_micros(F.col("at").cast("timestamp"))
    a = loads.where("key is not null").select("key", micros.alias("l"), F.lit(None).cast("long").alias("w"), F.lit(True).alias("present"))
    b = withdrawals.where("key is not null").select("key", F.lit(None).cast("long").alias("l"), micros.alias("w"), F.lit(False).alias("present"))
    keys = a.unionByName(b).groupBy("key").agg(F.min("l").alias("l"), F.min("w").alias("w"), F.max("present").alias("present"))
    keys = keys.withColumn("block", _block(F.col("key")))
    in_block = Window.partitionBy("block").orderBy("key")
    starts = keys.withColumn("gap", F.col("key") - F.row_number().over(in_block))
    runs = starts.groupBy("block", "gap").agg(
        F.min("key").alias("run_start"),
        F.max("key").alias("run_end"),
        F.sort_array(F.collect_list(F.struct("key", "l", "w", "present"))).alias("slots"),
    )
    run = F.struct("run_start", "run_end", F.col("slots.l").alias("loaded"), F.col("slots.w").alias("withdrawn"), F.col("slots.present").alias("present"))
    return runs.groupBy("block").agg(F.sort_array(F.collect_list(run)).alias("runs"))


def orphans(refs: DataFrame, runs: DataFrame) -> DataFrame:
    """ref_field, loaded_month, record_id, ref_id, kind (deleted, missing, late); distinct rows.

    refs: ref_field, record_id, ref_id, at.
    """
    at = F.col("at").cast("timestamp")
    seen = (
        refs.where("ref_id is not null and ref_id <> 0")
        .groupBy("ref_field", "record_id", "ref_id", F.date_format(at, "yyyy-MM").alias("loaded_month"))
        .agg(F.min(F.unix_micros(at)).alias("first_at"), F.max(F.unix_micros(at)).alias("last_at"))
        .withColumn("block", _block(F.col("ref_id")))
    )
    seen = Workspace(refs.sparkSession, "references").cut(seen)
    hot = seen.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / HOT).cast("int").alias("parts")).where("parts > 1")
    hot = F.broadcast(hot)  # at most one row for each HOT references
    seen = seen.join(hot, "block", "left").withColumn("salt", F.pmod(F.xxhash64("record_id", "ref_field"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    spread = runs.join(hot, "block", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    j = seen.join(spread, ["block", "salt"], "left")
    # as of: the last run that starts at or before the key
    n_before = F.size(F.filter(F.col("runs"), lambda r: r["run_start"] <= F.col("ref_id")))
    run = F.when(n_before > 0, F.element_at("runs", F.when(n_before > 0, n_before).otherwise(1)))
    j = j.withColumn("run", run)
    inside = F.coalesce(F.col("ref_id") <= F.col("run.run_end"), F.lit(False))
    slot = (F.col("ref_id") - F.col("run.run_start")).cast("int") + 1
    pick = lambda f: F.when(inside, F.element_at(F.col(f"run.{f}"), F.when(inside, slot).otherwise(1)))
    j = j.select("ref_field", "loaded_month", "record_id", "ref_id", "first_at", "last_at", pick("loaded").alias("l"), pick("withdrawn").alias("w"), inside.alias("known"))
    kinds = F.array(
        F.when(F.col("w") <= F.col("last_at"), "deleted"),
        F.when(~F.col("known"), "missing"),
        F.when((F.col("first_at") < F.col("l")) & (F.col("w").isNull() | (F.col("first_at") < F.col("w"))), "late"),
    )
    return j.select("ref_field", "loaded_month", "record_id", "ref_id", F.explode(F.array_compact(kinds)).alias("kind"))


def orphan_report(found: DataFrame) -> DataFrame:
    """References per table field, month and kind."""
    return found.groupBy("ref_field", "loaded_month", "kind").agg(F.count(F.lit(1)).alias("n_refs"), F.countDistinct("ref_id").alias("n_keys"))
