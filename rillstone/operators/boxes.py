"""Bounding boxes: joins by grid cells, padding, clamping, and order along a Hilbert curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.sources.schemas import BOX

#: Levels of grids, each with cells of 2^level degrees: from some 27 metres to more than the globe.
FINEST, COARSEST = -12, 10
#: Coordinates beyond this are no place; boxes and points that have one take no part in joins.
BEYOND = 500.0


def _level(w: Column, h: Column) -> Column:
    """The level whose cells are about as large as the box, so that it meets one to four of them, whatever its size."""
    longest = F.greatest(w, h, F.lit(2.0**FINEST))
    return F.least(F.ceil(F.log2(longest)), F.lit(COARSEST)).cast("int")


def _levels(df: DataFrame, column: str) -> list[int]:
    """The levels that boxes have: at most COARSEST - FINEST + 1 numbers. Points and boxes are listed on these only."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _cells(minx: Column, miny: Column, maxx: Column, maxy: Column, level: Column) -> Column:
    s = F.pow(F.lit(2.0), level)
    span = lambda a, b: F.sequence(F.floor(a / s).cast("long"), F.floor(b / s).cast("long"))
    return F.flatten(F.transform(span(minx, maxx), lambda x: F.transform(span(miny, maxy), lambda y: F.struct(level.alias("level"), x.alias("cx"), y.alias("cy")))))


def _good(df: DataFrame) -> DataFrame:
    ok = F.lit(True)
    for c in BOX:
        v = F.col(c).cast("double")
        ok = ok & F.coalesce(~F.isnan(v) & (F.abs(v) <= BEYOND), F.lit(False))
    return df.where(ok).where("bbox_minx <= bbox_maxx and bbox_miny <= bbox_maxy")


def _boxes(df: DataFrame, key: str, prefix: str) -> DataFrame:
    b = _good(df).select(F.col(key).alias(f"{prefix}key"), *[F.col(c).cast("double").alias(prefix + c[5:]) for c in BOX])
    return b.withColumn(f"{prefix}level", _level(F.col(prefix + "maxx") - F.col(prefix + "minx"), F.col(prefix + "maxy") - F.col(prefix + "miny")))


def containing(points: DataFrame, boxes: DataFrame, key: str = "id") -> DataFrame:
    """point_key, box_key: points (key, x, y) in boxes, borders included. Equi-join on the cells of each box's own level."""
    b = _boxes(boxes, key, "b_")
    b = b.withColumn("c", F.explode(_cells(F.col("b_minx"), F.col("b_miny"), F.col("b_maxx"), F.col("b_maxy"), F.col("b_level"))))
    p = points.select(F.col(key).alias("point_key"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where(~F.isnan("x") & ~F.isnan("y") & (F.abs("x") <= BEYOND) & (F.abs("y") <= BEYOND))
    p = p.withColumn("level", F.explode(F.array(*[F.lit(k) for k in _levels(b, "b_level")]).cast("array<int>")))
    s = F.pow(F.lit(2.0), F.col("level"))
    p = p.select("point_key", "x", "y", F.struct("level", F.floor(F.col("x") / s).cast("long").alias("cx"), F.floor(F.col("y") / s).cast("long").alias("cy")).alias("c"))
    return p.join(b, "c").where("x between b_minx and b_maxx and y between b_miny and b_maxy").select("point_key", F.col("b_key").alias("box_key"))


def intersecting(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """a_key, b_key: boxes that overlap or touch. Each pair is met on the coarser box's level, in the first common cell."""
    x, y = _boxes(a, key, "a_"), _boxes(b, key, "b_")

    levels = {"a_": _levels(y, "b_level"), "b_": _levels(x, "a_level")}  # of the other side

    def listed(df: DataFrame, p: str, own: bool) -> DataFrame:
        """On its own level, or on those of the other side that are not finer: boxes as large are met there."""
        coarser = F.filter(F.array(*[F.lit(k) for k in levels[p]]).cast("array<int>"), lambda k: k >= F.col(f"{p}level"))
        up = df.withColumn("lv", F.explode(F.array(F.col(f"{p}level")) if own else coarser))
        return up.withColumn("c", F.explode(_cells(F.col(p + "minx"), F.col(p + "miny"), F.col(p + "maxx"), F.col(p + "maxy"), F.col("lv")))).drop("lv")

    s = F.pow(F.lit(2.0), F.col("c.level"))
    touch = (F.col("a_minx") <= F.col("b_maxx")) & (F.col("b_minx") <= F.col("a_maxx")) & (F.col("a_miny") <= F.col("b_maxy")) & (F.col("b_miny") <= F.col("a_maxy"))
    first = (F.col("c.cx") == F.floor(F.greatest("a_minx", "b_minx") / s)) & (F.col("c.cy") == F.floor(F.greatest("a_miny", "b_miny") / s))
    coarse_a = listed(x, "a_", True).join(listed(y, "b_", False), "c")
    coarse_b = listed(x, "a_", False).join(listed(y, "b_", True), "c").where("a_level < b_level")
    return coarse_a.unionByName(coarse_b).where(touch & first).select("a_key", "b_key")


def outward(c: str, pad: float = 1e-4) -> Column:
    """A side of the box, moved outward."""
    return F.col(c).cast("double") + (-pad if "min" in c else pad)


def clamped(c: str, low: float, high: float) -> Column:
    return F.least(F.greatest(F.col(c).cast("double"), F.lit(low)), F.lit(high))


def inflated(lo: str, hi: str, pad: float = 1e-4) -> tuple[Column, Column]:
    """Both ends of an axis, moved apart where they are equal or in the wrong order."""
    a, b = F.col(lo).cast("double"), F.col(hi).cast("double")
    flat = a >= b
    return F.when(flat, a - pad).otherwise(a), F.when(flat, b + pad).otherwise(b)


def hilbert(x: Column, y: Column, level: int = 16) -> Column:
    """Distance along the Hilbert curve of whole coordinates from 0 to 2^level - 1."""

    def step(acc: Column, i: Column) -> Column:
        one = F.lit(1).cast("long")
        bit = lambda v: F.floor(v / F.pow(F.lit(2), i)).cast("long") % 2
        rx, ry = bit(acc["x"]), bit(acc["y"])
        side = F.pow(F.lit(2), i).cast("long")
        d = acc["d"] + side * side * F.when(rx == 1, 3 - ry).otherwise(ry)
        mx, my = acc["x"] % side, acc["y"] % side
        fx = F.when((ry == 0) & (rx == 1), side - one - mx).otherwise(mx)
        fy = F.when((ry == 0) & (rx == 1), side - one - my).otherwise(my)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    return F.aggregate(F.sequence(F.lit(level - 1), F.lit(0), F.lit(-1)), start, step)["d"]


def on_grid(v: Column, low: float, high: float, level: int = 16) -> Column:
    """A coordinate as a whole number from 0 to 2^level - 1 within [low, high]."""
    n = (1 << level) - 1
    return F.least(F.greatest(F.floor((v.cast("double") - low) / (high - low) * n), F.lit(0)), F.lit(n)).cast("long")


def world_order(df: DataFrame, level: int = 16) -> DataFrame:
    """Adds h: the Hilbert key of the box centre over the whole globe. Order by (h, basin, row) to merge basins."""
    cx, cy = (F.col("bbox_minx").cast("double") + F.col("bbox_maxx")) / 2, (F.col("bbox_miny").cast("double") + F.col("bbox_maxy")) / 2
    return df.withColumn("h", hilbert(on_grid(cx, -180, 180, level), on_grid(cy, -90, 90, level), level))
