"""Points near other points, and the region that contains a point.

Method: a Voronoi partition around pivots drawn from the points themselves. Each distinct location belongs to one cell
and is repeated in each cell that could hold a point within the radius (triangle inequality); each polygon, as the ball
around its box, likewise. Within a cell a vantage-point tree with the exact great-circle metric answers all balls.

Locations are distinct before the join, so copies of one location, however many, are one point there (a place);
near_places gives pairs of places, near_and_inside makes pairs of records of them. Pivots are a sample of the locations,
as many as keep a cell at some PER_CELL of them; a cell that still gets more than CROWDED has pivots of its own drawn in
it. All points are joined. A polygon with many edges goes as bands of latitude, each with the edges that cross it and
only to the cells it may reach, so no cell gets a whole coastline.

Defined results: a location is a Point or the last vertex of a LineString; records with null, empty or unreadable
geometry, with coordinates that are not finite or beyond 90 degrees of latitude, or with a null id have no location.
Polygons that can't be read contain nothing. Repeated rows give one result; records of one id at two places are never
near each other. Planar containment in longitude and latitude, even-odd, so holes are outside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import sphere, wkb
from rillstone.storage import Workspace

#: Locations aimed at for a cell, how many make it crowded, and the most pivots sent to the workers (24 bytes each).
PER_CELL, CROWDED, MAX_PIVOTS = 3000, 30_000, 1 << 20
#: Edges of a polygon that go in one piece.
PIECE = 4096

_CELL = "cell int, what int, lon double, lat double, lo long, hi long, reach double, south double, north double, lines binary"


def _as_points(batches):
    for b in batches:
        xy = wkb.last_vertices(b["geometry"])
        ok = ~np.isnan(xy).any(axis=1)
        yield pa.RecordBatch.from_arrays([b["id"].filter(pa.array(ok)), pa.array(xy[ok, 0] + 0.0), pa.array(xy[ok, 1] + 0.0)], ["id", "lon", "lat"])


def locations(points: DataFrame, id_col: str = "id", geometry: str = "geometry") -> DataFrame:
    """id, lon, lat: the location of each record that has one."""
    p = points.select(F.col(id_col).cast("long").alias("id"), F.col(geometry).alias("geometry")).where("id is not null and length(geometry) >= 21")
    return p.mapInArrow(_as_points, "id long, lon double, lat double")


def _drawn(places: DataFrame, n: int, most: int) -> np.ndarray:
    """Some `most` of n distinct locations, by hash: the same for the same data."""
    h = F.xxhash64("lon", "lat")
    share = min(1.0, 2 * most / max(n, 1))
    some = places.where(F.pmod(h, F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy(h, "lon", "lat").limit(most).select("lon", "lat").toPandas()
    return some.to_numpy(float).reshape(-1, 2)


def _cells(space: Workspace, places: DataFrame, n: int, radius: float) -> tuple[sphere.Pivots, DataFrame]:
    """Pivots, and the cells of the places around them."""
    at = _drawn(places, n, min(MAX_PIVOTS, max(1, n // PER_CELL)))
    while True:
        pivots = sphere.Pivots(at[:, 0], at[:, 1])
        cells = space.cut(places.mapInArrow(_points_to_cells(pivots, radius), _CELL))
        crowded = {r.cell: r.n for r in cells.where("what = 0").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).collect()}  # cells, at most one row to a pivot
        if not crowded or len(at) >= MAX_PIVOTS:
            return pivots, cells
        inside = cells.where("what = 0").where(F.col("cell").isin(list(crowded)))
        total = sum(crowded.values())
        more = _drawn(inside, total, min(MAX_PIVOTS - len(at), max(len(crowded), 2 * total // PER_CELL)))
        both = np.unique(np.concatenate([at, more]), axis=0)
        if len(both) == len(at):
            return pivots, cells
        space.drop(cells)
        at = both


def _points_to_cells(pivots: sphere.Pivots, radius: float):
    def run(batches):
        for b in batches:
            t = {c: b[c].to_numpy(zero_copy_only=False) for c in ("lon", "lat", "lo", "hi")}
            i, cell, owner = pivots.assign(sphere.unit(t["lon"], t["lat"]), radius)
            empty = pa.nulls(len(i), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(np.where(owner, 0, 1), pa.int32()), pa.array(t["lon"][i]), pa.array(t["lat"][i]), pa.array(t["lo"][i]), pa.array(t["hi"][i]), empty, empty, empty, pa.nulls(len(i), pa.binary())], _CELL_NAMES)

    return run


_CELL_NAMES = [c.split()[0] for c in _CELL.split(", ")]


def _bands(ring_list: list[np.ndarray]):
    """(box, south, north, lines) of bands of latitude with some PIECE edges each. A point is in one band, and whether the
    polygon contains it is told by the band's edges alone: an edge beyond crosses no level line through the point."""
    a, b = np.concatenate(ring_list), np.concatenate([np.roll(r, -1, axis=0) for r in ring_list])
    low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
    cuts = np.unique(np.quantile((low + high) / 2, np.linspace(0, 1, -(-len(a) // PIECE) + 1)[1:-1]))
    edges = [low.min(), *cuts, np.nextafter(high.max(), np.inf)]
    for south, north in zip(edges, edges[1:]):
        k = np.flatnonzero((low < north) & (high >= south))
        if len(k):
            lines = np.stack([a[k], b[k], np.full((len(k), 2), np.nan)], axis=1).reshape(-1, 2)
            x = np.concatenate([a[k, 0], b[k, 0]])
            yield (x.min(), max(south, low.min()), x.max(), min(north, high.max())), south, north, lines


def _pieces(geometry: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """(row, ball, south, north, lines) of a column of polygons; lines are runs of vertices parted by NaN."""
    row, count, xy = wkb.all_rings(geometry)
    if not len(row):
        return np.zeros(0, int), np.zeros((0, 3)), np.zeros(0), np.zeros(0), []
    ends = np.cumsum(count)
    first = np.flatnonzero(np.diff(row, prepend=-1))  # the first ring of each row
    last = np.append(first[1:], len(row)) - 1
    lo_v, hi_v = np.concatenate([[0], ends])[first], ends[last]
    lo, hi = np.minimum.reduceat(xy, lo_v), np.maximum.reduceat(xy, lo_v)
    # rings closed, and a gap after each
    size = count + 2
    out = np.full((size.sum(), 2), np.nan)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    out[np.repeat(begin - (ends - count), count) + np.arange(len(xy))] = xy
    out[begin + count] = xy[ends - count]
    closed = np.append(begin, len(out))
    at, balls, south, north, lines = [], [], [], [], []
    for k, r in enumerate(row[first].tolist()):
        if hi_v[k] - lo_v[k] <= PIECE:
            at.append(r)
            balls.append(sphere.box_ball(*lo[k], *hi[k]))
            south.append(lo[k, 1])
            north.append(np.nextafter(hi[k, 1], np.inf))
            lines.append(out[closed[first[k]] : closed[last[k] + 1]].tobytes())
            continue
        for box, s, n, band in _bands([xy[e - c : e] for e, c in zip(ends[first[k] : last[k] + 1], count[first[k] : last[k] + 1])]):
            at.append(r)
            balls.append(sphere.box_ball(*box))
            south.append(s)
            north.append(n)
            lines.append(band.tobytes())
    return np.array(at), np.array(balls, dtype=float).reshape(-1, 3), np.array(south), np.array(north), lines


def _regions_to_cells(pivots: sphere.Pivots):
    def run(batches):
        for b in batches:
            at, q, south, north, lines = _pieces(b["geometry"])
            i, cell, _ = pivots.assign(sphere.unit(q[:, 0], q[:, 1]), q[:, 2])
            key = b["id"].take(pa.array(at[i].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(np.full(len(i), 2), pa.int32()), pa.array(q[i, 0]), pa.array(q[i, 1]), key, key, pa.array(q[i, 2]), pa.array(south[i]), pa.array(north[i]), pa.array(lines, pa.binary()).take(pa.array(i.astype(np.int64)))], _CELL_NAMES)

    return run


_OUT = "kind string, a_lon double, a_lat double, a_lo long, a_hi long, b_lon double, b_lat double, b_lo long, b_hi long"


def _in_cell(radius: float):
    names = [c.split()[0] for c in _OUT.split(", ")]

    def run(t: pa.Table) -> pa.Table:
        what, lon, lat, lo, hi = (t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("what", "lon", "lat", "lo", "hi"))
        own, pts, reg = np.flatnonzero(what == 0), np.flatnonzero(what < 2), np.flatnonzero(what == 2)
        u = sphere.unit(lon, lat)
        # near: each pair where the lesser location, by longitude and latitude, is the cell's own
        q, j = sphere.VantageTree(u[pts]).balls(u[own], radius)
        a, b = own[q], pts[j]
        less = (lon[a] < lon[b]) | ((lon[a] == lon[b]) & (lat[a] < lat[b]))
        a, b = a[less], b[less]
        parts = [[pa.array(["near"] * len(a), pa.string()), *(pa.array(x[i]) for i in (a, b) for x in (lon, lat, lo, hi))]]
        if len(reg) and len(own):
            reach, south, north = (t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("reach", "south", "north"))
            q, j = sphere.VantageTree(u[own]).balls(u[reg], reach[reg])
            y = lat[own[j]]
            on = (y >= south[reg[q]]) & (y < north[reg[q]])
            q, j = q[on], j[on]
            used, poly = np.unique(q, return_inverse=True)
            raw = [t["lines"][int(reg[k])].as_py() for k in used]
            xy = np.frombuffer(b"".join(raw), float).reshape(-1, 2)
            edges = wkb.Edges.of_lines(xy, np.array([len(x) // 16 for x in raw], np.int64))
            hit = edges.contain(poly, lon[own[j]], lat[own[j]])
            p, r = own[j[hit]], reg[q[hit]]
            parts.append([pa.array(["inside"] * len(p), pa.string()), pa.array(lon[p]), pa.array(lat[p]), pa.array(lo[p]), pa.array(hi[p]), pa.nulls(len(p), pa.float64()), pa.nulls(len(p), pa.float64()), pa.array(lo[r]), pa.array(lo[r])])
        return pa.concat_tables([pa.Table.from_arrays(x, names) for x in parts])

    return run


def _join(space: Workspace, records: DataFrame, regions: DataFrame | None, radius_m: float) -> tuple[DataFrame, DataFrame, int]:
    """(places, pairs of places and regions as _OUT, places of several ids). A place has its least and greatest id."""
    places, n = space.counted(records.groupBy("lon", "lat").agg(F.min("id").alias("lo"), F.max("id").alias("hi")), n=F.count(F.lit(1)), shared=F.count_if(F.col("lo") < F.col("hi")))
    pivots, cells = _cells(space, places, n["n"], radius_m)
    if regions is not None:
        r = regions.select(F.col("id").cast("long").alias("id"), "geometry").where("id is not null and length(geometry) >= 9")
        cells = cells.unionByName(r.mapInArrow(_regions_to_cells(pivots), _CELL))
    return places, space.cut(cells.groupBy("cell").applyInArrow(_in_cell(radius_m), _OUT)), n["shared"]


def near_places(points: DataFrame, radius_m: float = 50.0) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of the places where points are: members gives each id its place, pairs the places that are near each
    other. A place is called by its least id, longitude and latitude; ids at one place are not paired one by one.

    members: id, place_id, lon, lat. pairs: a_place, a_lon, a_lat, b_place, b_lon, b_lat, lesser location first.
    """
    space = Workspace(points.sparkSession, "places")
    records = space.cut(locations(points))
    places, found, _ = _join(space, records, None, radius_m)
    members = records.distinct().join(places.select("lon", "lat", F.col("lo").alias("place_id")), ["lon", "lat"]).select("id", "place_id", "lon", "lat")
    pairs = found.where("kind = 'near'").select(F.col("a_lo").alias("a_place"), "a_lon", "a_lat", F.col("b_lo").alias("b_place"), "b_lon", "b_lat").distinct()
    return members, pairs


def near_and_inside(points: DataFrame, regions: DataFrame | None, radius_m: float = 50.0) -> DataFrame:
    """kind, key_a, key_b: `near` pairs of ids of points, smaller first; `inside`: id of a point, id of a region.

    points, regions: id, geometry. Distinct rows. All pairs of ids, also of those at one place; near_places is the form
    for tables where many ids share places.
    """
    space = Workspace(points.sparkSession, "spatial")
    records = space.cut(locations(points))
    places, found, shared = _join(space, records, regions, radius_m)
    inside = F.col("kind") == "inside"
    pair = lambda x, y: [F.when(inside, x).otherwise(F.least(x, y)).alias("key_a"), F.when(inside, y).otherwise(F.greatest(x, y)).alias("key_b")]
    single = (F.col("a_lo") == F.col("a_hi")) & (F.col("b_lo") == F.col("b_hi"))
    out = found.where(single).select("kind", *pair(F.col("a_lo"), F.col("b_lo")))
    if shared:  # places of several ids: their ids are joined in, from the records themselves
        members = records.join(places.where("lo < hi").select("lon", "lat"), ["lon", "lat"], "left_semi").distinct()
        a = members.select(F.col("lon").alias("a_lon"), F.col("lat").alias("a_lat"), F.col("id").alias("a_id"))
        b = members.select(F.col("lon").alias("b_lon"), F.col("lat").alias("b_lat"), F.col("id").alias("b_id"))
        many = found.where(~single).join(a, ["a_lon", "a_lat"], "left").join(b, ["b_lon", "b_lat"], "left")
        many = many.select("kind", *pair(F.coalesce("a_id", "a_lo"), F.coalesce("b_id", "b_lo")))
        here = a.join(b, (F.col("a_lon") == F.col("b_lon")) & (F.col("a_lat") == F.col("b_lat")) & (F.col("a_id") < F.col("b_id"))).select(F.lit("near").alias("kind"), F.col("a_id").alias("key_a"), F.col("b_id").alias("key_b"))
        out = out.unionByName(many).unionByName(here)
    return out.where("kind = 'inside' or key_a <> key_b").distinct()
