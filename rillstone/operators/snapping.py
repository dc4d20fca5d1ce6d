"""Outlets: which snap feature or atom an outlet belongs to, and the watershed above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.functions.sphere import RADIUS_M


def metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance, by haversine."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def within(outlets: DataFrame, snap: DataFrame, radius_m: float) -> DataFrame:
    """outlet_id, id, weight, is_mainstem, distance: snap features (id, lon, lat, ...) near outlets (outlet_id, lon, lat).

    Cells of latitude as high as the radius, and of longitude as wide at the cell's latitude; outlets are listed in the
    neighbouring cells, features in one, and the exact distance decides.
    """
    deg = radius_m / 111_194.9
    rows = lambda lat: F.floor((lat + 90) / deg).cast("long")

    def per(row: Column) -> Column:  # cells around the globe in a row
        poleward = F.greatest(F.abs(row * deg - 90), F.abs((row + 1) * deg - 90))
        return F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(F.least(poleward + deg, F.lit(90.0)))) / (deg * 1.01))).cast("long")

    col = lambda lon, row: F.pmod(F.floor((lon + 180) / 360 * per(row)), per(row)).cast("long")
    o = outlets.select("outlet_id", F.col("lon").alias("olon"), F.col("lat").alias("olat"))
    o = o.withColumn("row", F.explode(F.array(*[rows(F.col("olat")) + k for k in (-1, 0, 1)])))
    o = o.withColumn("col", F.explode(F.array_distinct(F.array(*[F.pmod(col(F.col("olon"), F.col("row")) + k, per(F.col("row"))) for k in (-1, 0, 1)]))))
    s = snap.withColumn("row", rows(F.col("lat"))).withColumn("col", col(F.col("lon"), F.col("row")))
    d = metres(F.col("olon"), F.col("olat"), F.col("lon"), F.col("lat"))
    return o.join(s, ["row", "col"]).withColumn("distance", d).where(F.col("distance") <= radius_m).select("outlet_id", "id", "weight", "is_mainstem", "distance")


def cascade(candidates: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """One feature per outlet: largest weight (within the tolerance), then mainstem, then nearest, then smallest id."""
    top = candidates.groupBy("outlet_id").agg(F.max("weight").alias("top"))
    near = candidates.join(top, "outlet_id").where(F.col("weight") >= F.col("top") - tolerance)
    best = near.groupBy("outlet_id").agg(F.min(F.struct((~F.coalesce("is_mainstem", F.lit(False))).alias("t"), "distance", "id")).alias("b"))
    return best.select("outlet_id", F.col("b.id").alias("id"))


def nearest(candidates: DataFrame, mainstem_first: bool = False) -> DataFrame:
    """One feature per outlet: nearest, or nearest of the mainstem if there is one."""
    keys = [F.when(F.lit(mainstem_first), ~F.coalesce("is_mainstem", F.lit(False))).alias("t"), "distance", "id"]
    return candidates.groupBy("outlet_id").agg(F.min(F.struct(*keys)).alias("b")).select("outlet_id", F.col("b.id").alias("id"))


def ranked(candidates: DataFrame, most: int) -> DataFrame:
    """The first features of each outlet by weight, mainstem, distance and id, for inspection."""
    w = Window.partitionBy("outlet_id").orderBy(F.desc("weight"), F.desc(F.coalesce("is_mainstem", F.lit(False))), "distance", "id")
    return candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def one_area(catchments: DataFrame) -> DataFrame:
    """id, a: one valid area of each atom, the largest; atoms without one are left out."""
    return catchments.where("area_km2 >= 0 and area_km2 < float('inf')").groupBy("id").agg(F.max(F.col("area_km2").cast("double")).alias("a"))


def summary(upstream: DataFrame, catchments: DataFrame) -> DataFrame:
    """query_id, n_atoms, area_km2: the watershed of each outlet atom; upstream: query_id, id; one area per atom."""
    return upstream.join(one_area(catchments), "id", "left").groupBy("query_id").agg(F.count(F.lit(1)).alias("n_atoms"), F.sum(F.coalesce("a", F.lit(0.0)).cast("decimal(28,6)")).alias("area_km2"))
