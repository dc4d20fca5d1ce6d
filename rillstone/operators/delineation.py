"""From outlets to watersheds: snap or locate, go upstream, fetch the shapes, dissolve them.

Shapes are dissolved edge by edge over the cluster: an edge that two regions share, once in each direction, cancels in an
aggregate, so no watershed's shapes meet in one task; only its boundary is put together in one, as it is one value.

Defined results: outlets without finite coordinates or id are left out; repeated ids count once (the lesser place); an
outlet with neither a snap feature in reach nor a region around it has a null atom. Atoms without a readable shape add
nothing to the boundary. Regions that overlap are counted in n_overlaps and their boundary is left null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.functions import dissolve as rings_of
from rillstone.functions import wkb
from rillstone.operators import hierarchy, network, snapping, spatial
from rillstone.storage import Workspace

_EDGE = "key long, ax double, ay double, bx double, by double"


def _directed(batches):
    """Edges of all rings, outer ones counter-clockwise and holes clockwise, so that neighbours run against each other."""
    for b in batches:
        row, count, xy, outer = wkb.all_rings(b["geometry"], outer=True)
        if not len(row):
            continue
        ends = np.cumsum(count)
        first = ends - count
        after = np.arange(len(xy)) + 1
        after[ends - 1] = first  # rings close
        n = xy[after]
        turn = np.add.reduceat(xy[:, 0] * n[:, 1] - n[:, 0] * xy[:, 1], first)
        flip = np.repeat((turn > 0) != outer, count)[:, None]
        start, stop = np.where(flip, n, xy), np.where(flip, xy, n)
        real = (start != stop).any(axis=1)
        key = b["key"].take(pa.array(np.repeat(row, count)[real]))
        yield pa.RecordBatch.from_arrays([key, *(pa.array(v[real] + 0.0) for v in (start[:, 0], start[:, 1], stop[:, 0], stop[:, 1]))], ["key", "ax", "ay", "bx", "by"])


def boundary(parts: DataFrame) -> DataFrame:
    """key, ax, ay, bx, by, n: the directed edges of the union's boundary; n above 1 where regions overlap. parts: key,
    geometry.

    Edges along a parallel or meridian also cancel where they share only a part: on each such line the regions on either
    side are counted from end to end. Others cancel as a whole.
    """
    e = parts.select(F.col("key").cast("long").alias("key"), "geometry").where("key is not null and length(geometry) >= 9").mapInArrow(_directed, _EDGE)
    flat, upright = F.col("ay") == F.col("by"), F.col("ax") == F.col("bx")
    # along lines: where an edge begins its direction is added, where it ends it is taken off
    along = e.where(flat | upright).select("key", flat.alias("flat"), F.when(flat, F.col("ay")).otherwise(F.col("ax")).alias("c"), F.when(flat, F.col("ax")).otherwise(F.col("ay")).alias("s"), F.when(flat, F.col("bx")).otherwise(F.col("by")).alias("t"))
    way = F.when(F.col("t") > F.col("s"), 1).otherwise(-1)
    events = along.select("key", "flat", "c", F.explode(F.array(F.struct(F.least("s", "t").alias("at"), way.alias("d")), F.struct(F.greatest("s", "t").alias("at"), (-way).alias("d")))).alias("e"))
    steps = events.groupBy("key", "flat", "c", F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    on_line = Window.partitionBy("key", "flat", "c").orderBy("at")
    runs = steps.select("key", "flat", "c", "at", F.sum("d").over(on_line).alias("n"), F.lead("at").over(on_line).alias("end")).where("n <> 0")
    s, t = F.when(F.col("n") > 0, F.col("at")).otherwise(F.col("end")), F.when(F.col("n") > 0, F.col("end")).otherwise(F.col("at"))
    pick = lambda a, b: F.when(F.col("flat"), a).otherwise(b)
    lines = runs.select("key", pick(s, F.col("c")).alias("ax"), pick(F.col("c"), s).alias("ay"), pick(t, F.col("c")).alias("bx"), pick(F.col("c"), t).alias("by"), F.abs("n").alias("n"))
    low, high = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    up = low < high
    slant = e.where(~flat & ~upright).select("key", F.when(up, low).otherwise(high).alias("p"), F.when(up, high).otherwise(low).alias("q"), F.when(up, 1).otherwise(-1).alias("d"))
    slant = slant.groupBy("key", "p", "q").agg(F.sum("d").alias("n")).where("n <> 0")
    a, b = F.when(F.col("n") > 0, F.col("p")).otherwise(F.col("q")), F.when(F.col("n") > 0, F.col("q")).otherwise(F.col("p"))
    return lines.unionByName(slant.select("key", a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"), F.abs("n").alias("n")))


def _stitched(pdf: pd.DataFrame) -> pd.DataFrame:
    key = pdf["key"].iloc[0]
    if (pdf["n"] > 1).any():
        return pd.DataFrame([(key, None, None)], columns=["key", "geometry", "n_rings"])
    edges = sorted(zip(pdf["ax"], pdf["ay"], pdf["bx"], pdf["by"]))
    try:
        rings = rings_of.stitch([((a, b), (c, d)) for a, b, c, d in edges])
    except rings_of.Unsupported:
        return pd.DataFrame([(key, None, None)], columns=["key", "geometry", "n_rings"])
    closed = [np.vstack([r, r[:1]]) for r in rings]
    outer = [[r] for r in closed if rings_of.signed_area(r[:-1]) > 0]
    for hole in (r for r in closed if rings_of.signed_area(r[:-1]) <= 0):
        inside = [o for o in outer if wkb.Edges([[o[0]]]).contain(np.zeros(1, int), hole[:-1, 0].mean(keepdims=True), hole[:-1, 1].mean(keepdims=True))[0]]
        (min(inside, key=lambda o: abs(rings_of.signed_area(o[0]))) if inside else outer[0]).append(hole)
    return pd.DataFrame([(key, wkb.multipolygon(outer) if len(outer) != 1 else wkb.polygon(outer[0]), len(rings))], columns=["key", "geometry", "n_rings"])


def dissolve(parts: DataFrame, space: Workspace | None = None) -> DataFrame:
    """key, geometry, n_rings, n_overlaps, area_km2: the union of each key's polygons (key, geometry). The area is summed
    from the boundary on the equal-area sphere, without putting it together."""
    space = space or Workspace(parts.sparkSession, "dissolve")
    edges = space.cut(boundary(parts))
    sin = lambda c: F.sin(F.radians(c))
    piece = (F.radians("ax") * sin("by") - F.radians("bx") * sin("ay")) * F.col("n") / 2
    area = edges.groupBy("key").agg((F.abs(F.sum(piece)) * (rings_of.AUTHALIC_M / 1000) ** 2).alias("area_km2"), F.count_if(F.col("n") > 1).alias("n_overlaps"))
    shape = edges.groupBy("key").applyInPandas(_stitched, "key long, geometry binary, n_rings int")
    return shape.join(area, "key").select("key", "geometry", "n_rings", "n_overlaps", "area_km2")


def _as_wkb(batches):
    for b in batches:
        g = [wkb.point(x, y) for x, y in zip(b["lon"].to_pylist(), b["lat"].to_pylist())]
        yield pa.RecordBatch.from_arrays([b["outlet_id"], pa.array(g, pa.binary())], ["id", "geometry"])


def locate(outlets: DataFrame, snap: DataFrame, catchments: DataFrame, atoms: DataFrame, radius_m: float) -> DataFrame:
    """outlet_id, atom_id, how: the atom of the best snap feature in reach (weight, mainstem, distance, id) that names a known
    atom, else the least atom whose shape holds the outlet, else null.

    outlets: outlet_id, lon, lat. snap: id, catchment_id, weight, is_mainstem, lon, lat. atoms: id.
    """
    places = outlets.where("outlet_id is not null and not isnan(lon) and not isnan(lat) and abs(lon) <= 360 and abs(lat) <= 90").groupBy("outlet_id").agg(F.min(F.struct("lon", "lat")).alias("p")).select("outlet_id", "p.lon", "p.lat")
    of = snap.where("id is not null").groupBy("id").agg(F.min("catchment_id").alias("atom_id")).join(atoms.select(F.col("id").alias("atom_id")), "atom_id", "left_semi")
    usable = snap.where("weight is not null and not isnan(weight) and abs(weight) < float('inf')").join(of.select("id"), "id", "left_semi")
    snapped = snapping.cascade(snapping.within(places, usable, radius_m)).join(of, "id").select("outlet_id", "atom_id", F.lit("snap").alias("how"))
    snapped = Workspace(outlets.sparkSession, "snapped").cut(snapped)
    rest = places.join(snapped, "outlet_id", "left_anti").mapInArrow(_as_wkb, "id long, geometry binary")
    held = spatial.near_and_inside(rest, catchments.select("id", "geometry"), 1.0).where("kind = 'inside'").join(atoms.select(F.col("id").alias("key_b")), "key_b", "left_semi")
    held = held.groupBy(F.col("key_a").alias("outlet_id")).agg(F.min("key_b").alias("atom_id")).withColumn("how", F.lit("inside"))
    return places.select("outlet_id").join(snapped.unionByName(held), "outlet_id", "left")


def delineate(outlets: DataFrame, snap: DataFrame, catchments: DataFrame, h: hierarchy.Hierarchy, radius_m: float = 2000.0, refined: DataFrame | None = None) -> DataFrame:
    """outlet_id, atom_id, how, n_atoms, geometry, n_rings, n_overlaps, area_km2.

    catchments: id, geometry; of an atom's shapes one is taken. refined (outlet_id, geometry; see rasters.refine) stands for
    the part of the outlet's own atom that drains to it.
    """
    space = Workspace(outlets.sparkSession, "delineate")
    at = space.cut(locate(outlets, snap, catchments, h.atoms, radius_m))
    above = space.cut(network.upstream(h, at.where("atom_id is not null").select(F.col("atom_id").alias("id"))))
    per = above.groupBy(F.col("query_id").alias("atom_id")).agg(F.count(F.lit(1)).alias("n_atoms"))
    shapes = catchments.where("geometry is not null").groupBy("id").agg(F.max("geometry").alias("geometry"))
    wanted = at.where("atom_id is not null").select("outlet_id", "atom_id")
    if refined is None:
        done = dissolve(above.join(shapes, "id").select(F.col("query_id").alias("key"), "geometry"), space).withColumnRenamed("key", "atom_id")
        by = "atom_id"  # outlets of one atom share its watershed
    else:
        mine = wanted.join(above.withColumnRenamed("query_id", "atom_id"), "atom_id").join(refined.select("outlet_id", F.col("geometry").alias("own")), "outlet_id", "left").join(shapes, "id", "left")
        shape = F.when((F.col("id") == F.col("atom_id")) & F.col("own").isNotNull(), F.col("own")).otherwise(F.col("geometry"))
        done = dissolve(mine.select(F.col("outlet_id").alias("key"), shape.alias("geometry")), space).withColumnRenamed("key", "outlet_id")
        by = "outlet_id"
    return at.join(per, "atom_id", "left").join(done, by, "left").select("outlet_id", "atom_id", "how", "n_atoms", "geometry", "n_rings", "n_overlaps", "area_km2")
