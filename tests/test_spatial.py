import numpy as np
import pyarrow as pa

from rillstone.functions import sphere, wkb
from rillstone.operators import spatial
from rillstone.plans import drainage


def test_tree_and_cells_lose_nothing():
    rng = np.random.default_rng(1)
    lon, lat = rng.uniform(-180, 180, 3000), np.degrees(np.arcsin(rng.uniform(-1, 1, 3000)))
    lon[:500] = np.where(rng.random(500) < 0.5, 179.9, -179.9) + rng.normal(0, 0.2, 500)
    u = sphere.unit(lon, lat)
    q, j = sphere.VantageTree(u).balls(u[:400], 150_000.0)
    d = sphere.metres(u[:400, None], u[None])
    assert set(zip(q, j)) == set(zip(*np.nonzero(d <= 150_000)))
    p = sphere.Pivots(lon[::50], lat[::50], per_top=8)
    row, cell, owner = p.assign(u, 150_000.0)
    assert (np.bincount(row[owner], minlength=3000) == 1).all()
    at = {(r, c) for r, c in zip(row, cell)}
    own = dict(zip(row[owner], cell[owner]))
    assert all((b, own[a]) in at for a, b in zip(q, j))


def test_box_ball_covers():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x, y, w, h = rng.uniform(-170, 170), rng.uniform(-85, 85), rng.uniform(0, 60), rng.uniform(0, 4)
        cx, cy, r = sphere.box_ball(x, y, x + w, min(y + h, 90))
        px, py = rng.uniform(x, x + w, 50), rng.uniform(y, min(y + h, 90), 50)
        assert (sphere.metres(sphere.unit(px, py), sphere.unit(np.array(cx), np.array(cy))) <= r).all()


def test_near_and_inside(spark):
    step = 40 / 111_194.9  # forty metres of latitude
    pts = [(1, wkb.point(10.0, 50.0)), (2, wkb.linestring([(9.0, 9.0), (10.0, 50.0 + step)], ">")), (3, wkb.point(10.0, 50.0 + 2 * step)), (3, wkb.point(10.0, 50.0 + 2 * step)), (4, wkb.point(10.0, 50.0)), (4, wkb.point(-179.9999, 0.0)), (5, wkb.point(179.9999, 0.0)), (6, None), (7, b""), (8, wkb.point(np.nan, 1.0)), (None, wkb.point(10.0, 50.0)), (9, wkb.point(20.0, 20.0)[:15])]
    outer = [(9.0, 49.0), (11.0, 49.0), (11.0, 51.0), (9.0, 51.0), (9.0, 49.0)]
    hole = [(9.9, 49.9), (9.9, 50.0 + 1.5 * step), (10.1, 50.0 + 1.5 * step), (10.1, 49.9), (9.9, 49.9)]
    regions = [(100, wkb.polygon([outer, hole])), (101, wkb.polygon([outer])), (101, wkb.polygon([outer])), (102, wkb.polygon([outer])[:40]), (103, None)]
    p = spark.createDataFrame(pts, "id long, geometry binary")
    r = spark.createDataFrame(regions, "id long, geometry binary")
    got = [tuple(x) for x in spatial.near_and_inside(p, r, 50.0).collect()]
    want = {("near", 1, 2), ("near", 2, 4), ("near", 1, 4), ("near", 2, 3), ("near", 4, 5)} | {("inside", i, 101) for i in (1, 2, 3, 4)} | {("inside", 3, 100)}
    assert set(got) == want and len(got) == len(want)
    assert spatial.near_and_inside(p.limit(0), r, 50.0).count() == 0
    assert {x.kind for x in spatial.near_and_inside(p, None, 50.0).collect()} == {"near"}


def _shape(rng, kind):
    def ring(n):
        return rng.normal(0, 1, (n, 2))

    end = rng.choice(["<", ">"])
    if kind == "multi":
        polys = [wkb.polygon([ring(rng.integers(0, 6)) for _ in range(rng.integers(0, 3))]) for _ in range(rng.integers(0, 4))]
        return wkb.struct.pack("<BII", 1, wkb.MULTIPOLYGON, len(polys)) + b"".join(polys)
    if kind == "polygon":
        return wkb.polygon([ring(rng.integers(0, 7)) for _ in range(rng.integers(0, 4))])
    if kind == "deep":
        return wkb.struct.pack(end + "BII", end == "<", 1000 + wkb.POLYGON, 1) + wkb.struct.pack(end + "I", 4) + rng.normal(0, 1, 12).astype(end + "f8").tobytes()
    return wkb.linestring(ring(rng.integers(0, 4)), end) if kind == "line" else wkb.point(*ring(1)[0], end)


def test_columns_read_as_single_geometries():
    rng = np.random.default_rng(3)
    rows = []
    for kind in ["multi", "polygon", "deep", "line", "point"] * 60:
        g = _shape(rng, kind)
        cut = rng.random()
        g = g[: rng.integers(0, len(g) + 1)] if cut < 0.3 else bytes([7]) + g[1:] if cut < 0.35 else g + b"xx" if cut < 0.4 else g
        if 0.4 < cut < 0.45 and len(g) > 30:
            g = g[:-8] + wkb.struct.pack("<d", np.nan)
        rows.append(g)
    rows += [None, b"", b"\x01"]
    column = pa.array([b"front", *rows], pa.binary()).slice(1)
    assert np.array_equal(wkb.last_vertices(column), np.array([wkb.last_vertex(g) for g in rows]), equal_nan=True)
    assert wkb.readable(column).tolist() == [wkb.is_readable(g) for g in rows]
    row, count, xy = wkb.all_rings(column)
    got = {}
    for r, n, stop in zip(row.tolist(), count, np.cumsum(count)):
        got.setdefault(r, []).append(xy[stop - n : stop].tolist())
    assert got == {k: [r.tolist() for r in x] for k, x in ((k, wkb.rings(g)) for k, g in enumerate(rows)) if x}


def test_crowded_cells_and_large_polygons(spark, monkeypatch):
    """Pivots are drawn where points crowd, and polygons go in bands; nothing is lost."""
    monkeypatch.setattr(spatial, "PER_CELL", 20)
    monkeypatch.setattr(spatial, "CROWDED", 40)
    monkeypatch.setattr(spatial, "PIECE", 16)
    rng = np.random.default_rng(4)
    xy = np.concatenate([rng.normal(10, 0.002, (300, 2)), rng.uniform(9.9, 10.1, (100, 2))])
    turn = np.sort(rng.uniform(0, 2 * np.pi, 200))
    star = np.stack([10 + 0.05 * np.cos(turn) * rng.uniform(0.5, 1, 200), 10 + 0.05 * np.sin(turn) * rng.uniform(0.5, 1, 200)], axis=1)
    hole = np.stack([10 + 0.004 * np.cos(turn[::3]), 10 + 0.004 * np.sin(turn[::3])], axis=1)
    p = spark.createDataFrame([(i, wkb.point(x, y)) for i, (x, y) in enumerate(xy.tolist())], "id long, geometry binary")
    r = spark.createDataFrame([(7, wkb.polygon([star, hole])), (8, wkb.polygon([hole]))], "id long, geometry binary")
    u = sphere.unit(xy[:, 0], xy[:, 1])
    d = sphere.metres(u[:, None], u[None])
    want = {("near", int(a), int(b)) for a, b in zip(*np.nonzero(d <= 50)) if a < b}
    for key, shape in ((7, [star, hole]), (8, [hole])):
        hit = wkb.Edges([shape]).contain(np.zeros(400, int), xy[:, 0], xy[:, 1])
        want |= {("inside", int(k), key) for k in np.flatnonzero(hit)}
    got = [tuple(x) for x in spatial.near_and_inside(p, r, 50.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_places(spark):
    step = 40 / 111_194.9
    p = spark.createDataFrame([(i, wkb.point(10.0, 50.0)) for i in (5, 3, 3, 9)] + [(4, wkb.point(10.0, 50.0 + step)), (8, wkb.point(0.0, 0.0)), (1, None)], "id long, geometry binary")
    members, pairs = spatial.near_places(p)
    assert {(r.id, r.place_id) for r in members.collect()} == {(3, 3), (5, 3), (9, 3), (4, 4), (8, 8)} and members.count() == 5
    assert [(r.a_place, r.b_place) for r in pairs.collect()] == [(3, 4)]


def test_weights_count_only_in_the_cascade(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = [(50, nan, False, 0.0), (1, 3.0, False, 0.001), (2, None, True, 0.002), (3, 1.0, True, 0.003), (4, inf, False, 0.004)]
    spark.createDataFrame([(i, w, m, x, 0.0, x, 0.0) for i, w, m, x in rows], "id long, weight float, is_mainstem boolean, bbox_minx float, bbox_miny float, bbox_maxx float, bbox_maxy float").write.parquet(f"{tmp_path}/snap.parquet")
    got = {q.__name__: [tuple(r) for r in q(spark, str(tmp_path)).collect()] for q in (drainage.snap_distance_first, drainage.snap_mainstem_first, drainage.snap_cascade)}
    assert got == {"snap_distance_first": [(50, 50)], "snap_mainstem_first": [(50, 2)], "snap_cascade": [(50, 1)]}
