"""Per-key results where a few keys hold most rows.

Method: map-side combining. Every aggregate is algebraic (count, min, max, sum), so each partition keeps a bounded hash
table of key states that spills, and only partial states are shuffled: a key with a third of all rows arrives as one
row from each map task. Distinct members are taken in two such steps, first by (key, member), then by key.

Defined results: a null key is a key of its own in the row counts; null members and 0 are no members; repeated rows
count as often as they come, in distinct members once; empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy(df: DataFrame, key: str, share: float) -> DataFrame:
    """key, n, n_total: the keys with at least `share` of all rows of df."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n_total")).scalar()
    return counts.withColumn("n_total", total).where((F.col("n") >= F.col("n_total") * share) & F.col("key").isNotNull())


def members(df: DataFrame, key: str, array: str) -> DataFrame:
    """key, member, n: distinct members of the array by key, with how often each came."""
    flat = df.select(F.col(key).alias("key"), F.explode(array).alias("member"))
    return flat.where("member is not null and member <> 0").groupBy("key", "member").agg(F.count(F.lit(1)).alias("n"))


def key_summary(df: DataFrame, key: str, array: str) -> DataFrame:
    """Per key: n_rows, n_entries, n_distinct, min_member, max_member; keys without members have zeros and nulls."""
    real = F.filter(F.col(array), lambda x: x.isNotNull() & (x != 0))
    rows = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.coalesce(F.size(real), F.lit(0))).cast("long").alias("n_entries"))
    distinct = members(df, key, array).groupBy("key").agg(F.count(F.lit(1)).alias("n_distinct"), F.min("member").alias("min_member"), F.max("member").alias("max_member"))
    r, d = rows.alias("r"), distinct.alias("d")
    return r.join(d, F.col("r.key").eqNullSafe(F.col("d.key")), "left").select("r.key", "r.n_rows", "r.n_entries", F.coalesce("d.n_distinct", F.lit(0)).alias("n_distinct"), "d.min_member", "d.max_member")
