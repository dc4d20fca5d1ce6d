import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillstone.functions import dissolve, wkb
from rillstone.operators import boxes, compilation, delineation, network, rasters, snapping


@given(st.integers(1, 200_000))
def test_group_bounds(n):
    b = compilation.group_bounds(n)
    assert b[0][0] == 0 and b[-1][1] == n and all(x[1] == y[0] for x, y in zip(b, b[1:]))
    sizes = [y - x for x, y in b]
    assert len(b) == 1 or (min(sizes) >= 4096 and max(sizes) <= 8192 and sizes == sorted(sizes, reverse=True))


def test_hilbert_is_a_curve(spark):
    xy = spark.range(256).selectExpr("id % 16 as x", "id div 16 as y")
    rows = {r.h: (r.x, r.y) for r in xy.select("x", "y", boxes.hilbert(F.col("x"), F.col("y"), 4).alias("h")).collect()}
    assert sorted(rows) == list(range(256))
    assert all(abs(rows[i][0] - rows[i + 1][0]) + abs(rows[i][1] - rows[i + 1][1]) == 1 for i in range(255))


def test_edges_from_next_down(spark):
    df = spark.createDataFrame([(1, 0), (2, 2), (3, 1), (4, 99), (5, None)], "id long, next_down long")
    assert {r.id: r.upstream_ids for r in network.edges_from_next_down(df).collect()} == {1: [3], 2: [], 3: [], 4: [], 5: []}


def test_tree_and_segments(spark):
    box = ["0f bbox_minx", "0f bbox_miny", "1f bbox_maxx", "1f bbox_maxy", "cast('g' as binary) geometry"]
    cat = spark.range(1, 101).selectExpr("id", "1.0 area", *box)
    riv = spark.range(1, 101).selectExpr("id", "id div 2 next_down", "cast(200 - id as double) uparea", *box)
    c, g, s = compilation.from_tree(cat, riv)
    assert c.count() == g.count() == s.count() == 100 and c.where("up_area_km2 is null").count() == 0
    assert {r.id for r in s.where("is_mainstem and id > 1").collect()} == set(range(2, 101, 2))
    with pytest.raises(compilation.CompileError):
        compilation.reconcile(cat, riv.where("id > 50"))
    with pytest.raises(compilation.CompileError):
        compilation.guard_ids(cat.union(cat))
    seg = spark.range(1, 101).selectExpr("id", "case when id > 2 then concat(' ', id - 1, ',,', id - 2, ' ') end upstream_line_ids", "case when id = 1 then null else 1 end is_mainstem", "1.0 drainage_area_out", *box)
    _, g, s = compilation.from_segments(seg, cat)
    assert g.where("id = 5").first().upstream_ids == [3, 4] and g.where("id = 1").first().upstream_ids == []
    assert not s.where("id = 1").first().is_mainstem


def test_dissolve():
    sq = lambda x, y: [np.array([(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)], float)]
    ring = dissolve.dissolve([sq(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)])
    assert sorted(round(dissolve.signed_area(r)) for r in ring) == [-1, 9]
    touching = dissolve.dissolve([sq(0, 0), sq(1, 1)])
    assert sum(dissolve.signed_area(r) for r in touching) == 2
    globe = np.array([(-180, -90), (180, -90), (180, 90), (-180, 90)], float)
    assert abs(dissolve.sphere_area_km2(globe) - 510_065_600) < 1000
    with pytest.raises(dissolve.Unsupported):
        dissolve.dissolve([sq(0, 0), sq(0, 0)])


def test_raster_operators(spark):
    t = spark.createDataFrame([(0, 0, 0.0, 4.0, 1.0, 4, [1] * 8 + [247] * 7 + [0])], "tile_row int, tile_col int, x0 double, y0 double, pixel double, width int, values array<int>")
    assert rasters.window(t, (30.0, 0.0, 31.0, 1.0)).count() == 0 and rasters.window(t, (1.0, 1.0, 2.0, 2.0)).count() == 1
    d = t.withColumn("values", rasters.transcode_direction(F.col("values")))
    assert {r.value: r.n for r in rasters.histogram(d).collect()} == {1: 8, 255: 7, 0: 1}
    region = wkb.polygon([[(0, 2), (2, 2), (2, 4), (0, 4), (0, 2)]])
    m = rasters.mask(d, region, 255).first()
    assert [v for v in m["values"] if v != 255] == [1] * 4 and m.masked == 5
    layers = d.withColumn("layer", F.lit(2)).unionByName(d.withColumn("values", F.expr("transform(values, v -> case when v = 255 then 64 else 255 end)")).withColumn("layer", F.lit(1)))
    assert rasters.mosaic(layers, 255).first()["values"] == [1] * 8 + [64] * 7 + [0]
    direction = np.array([[1, 4], [64, 16]])
    assert rasters.trace(direction, 1, 0).tolist() == [[True, True], [True, True]] or rasters.trace(direction, 1, 1).sum() == 4
    line = np.full((1, 4), 1)
    assert rasters.trace(line, 0, 2).tolist() == [[True, True, True, False]]
    assert rasters.nearest_above(np.array([[0, 2000.0], [1500, 0]]), 0, 0) == (0, 1)
    w = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 1.0, 4, [1] * 4, [0.0, 0.0, 5000.0, 0.0])], "outlet_id long, row int, col int, x0 double, y0 double, pixel double, width int, direction array<int>, accumulation array<double>")
    r = rasters.refine(w).first()
    assert r.n_pixels == 3 and abs(r.area_km2 - 3 * 12363) < 30


def test_cascade_ties(spark):
    c = spark.createDataFrame([(1, 10, 5.0, False, 1.0), (1, 11, 5.0, True, 9.0), (1, 12, 4.9, True, 0.5), (2, 21, 1.0, None, 3.0), (2, 20, 1.0, False, 3.0)], "outlet_id long, id long, weight double, is_mainstem boolean, distance double")
    pick = lambda d: {r.outlet_id: r.id for r in d.collect()}
    assert pick(snapping.cascade(c)) == {1: 11, 2: 20}
    assert pick(snapping.cascade(c, tolerance=0.2)) == {1: 12, 2: 20}
    assert pick(snapping.nearest(c)) == {1: 12, 2: 20}
    assert pick(snapping.cascade(c.limit(0))) == {}


def test_within_everywhere(spark):
    rng = np.random.default_rng(5)
    lon, lat = rng.uniform(-180, 180, 400), rng.uniform(-89.9, 89.9, 400)
    rows = [(int(i), float(x), float(y), 1.0, True) for i, (x, y) in enumerate(zip(lon, lat))]
    s = spark.createDataFrame(rows, "id long, lon double, lat double, weight double, is_mainstem boolean")
    o = s.where("id < 60").selectExpr("id outlet_id", "lon", "lat")
    from rillstone.functions import sphere

    u = sphere.unit(lon, lat)
    want = {(a, b) for a, b in zip(*np.nonzero(sphere.metres(u[:60, None], u[None]) <= 900_000))}
    assert {(r.outlet_id, r.id) for r in snapping.within(o, s, 900_000.0).collect()} == want


def test_boxes_of_all_sizes(spark):
    rng = np.random.default_rng(6)

    def some(n, first):
        w = 10 ** rng.uniform(-3, 2.4, n)
        x, y = rng.uniform(-180, 150, n), rng.uniform(-90, 80, n)
        return [(first + i, float(a), float(b), float(a + c), float(b + c / 3)) for i, (a, b, c) in enumerate(zip(x, y, w))]

    a, b = some(80, 0) + [(500, None, 0.0, 1.0, 1.0), (501, float("nan"), 0.0, 1.0, 1.0)], some(80, 1000)
    f = lambda r: spark.createDataFrame(r, "id long, bbox_minx double, bbox_miny double, bbox_maxx double, bbox_maxy double")
    want = {(p[0], q[0]) for p in a[:80] for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    got = [tuple(r) for r in boxes.intersecting(f(a), f(b)).collect()]
    assert set(got) == want and len(got) == len(want)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-90, 90, (100, 2)))]
    inside = {(p, q[0]) for p, x, y in pts for q in b if q[1] <= x <= q[3] and q[2] <= y <= q[4]}
    got = [tuple(r) for r in boxes.containing(spark.createDataFrame(pts, "id long, x double, y double"), f(b)).collect()]
    assert set(got) == inside and len(got) == len(inside)


def test_compile_guards(spark):
    graph = lambda rows: spark.createDataFrame(rows, "id long, upstream_ids array<long>")
    assert compilation.guard_acyclic(graph([(1, []), (2, [1])])).count() == 2
    with pytest.raises(compilation.CompileError, match="cycle detected: 3 atoms"):
        compilation.guard_acyclic(graph([(1, [2]), (2, [1]), (3, [2]), (4, [])]))
    m = spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, None), (4, -1.0)], "id long, a double")
    with pytest.raises(compilation.CompileError, match="3 values .* first at id 2"):
        compilation.guard_measure(m, "a")
    with pytest.raises(compilation.CompileError, match="4 rows instead of 5"):
        compilation.guard_count(m, 5, "layer")


def _square(x, y, w=1.0, h=1.0, flip=False):
    r = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return r[::-1] if flip else r


def test_dissolve_over_tables(spark):
    hole = [(3.2, 3.2), (3.4, 3.2), (3.3, 3.4), (3.2, 3.2)]
    parts = [(1, wkb.polygon([_square(0, 0, 2, 2)])), (1, wkb.polygon([_square(2, 0, 1, 1, True)])), (1, wkb.polygon([_square(2, 1, 1, 1)]))]  # one long side meets two short ones
    parts += [(2, wkb.polygon([_square(x, y, flip=(x + y) % 2 > 0)])) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    parts += [(3, wkb.multipolygon([[_square(3, 3), hole], [_square(8, 8)]])), (3, wkb.polygon([_square(4, 3)])), (3, None), (3, b"bad"), (None, wkb.polygon([_square(0, 0)]))]
    parts += [(4, wkb.polygon([_square(0, 0)])), (4, wkb.polygon([_square(0.5, 0)]))]
    got = {r.key: r for r in delineation.dissolve(spark.createDataFrame(parts, "key long, geometry binary")).collect()}
    assert sorted(got) == [1, 2, 3, 4] and got[4].n_overlaps > 0 and got[4].geometry is None
    flat = {k: sum(dissolve.signed_area(r[:-1]) for r in wkb.rings(bytes(x.geometry))) for k, x in got.items() if x.geometry}
    assert flat[1] == 6.0 and got[1].n_rings == 1 and len(wkb.rings(bytes(got[1].geometry))[0]) == 5
    assert flat[2] == 8.0 and got[2].n_rings == 2 and abs(flat[3] - (3 - 0.02)) < 1e-9 and got[3].n_rings == 3
    for k, x in got.items():
        if x.geometry:
            rings = wkb.rings(bytes(x.geometry))
            assert abs(x.area_km2 - sum(np.sign(dissolve.signed_area(r[:-1])) * dissolve.sphere_area_km2(r[:-1]) for r in rings)) < 1e-6


def test_delineate(spark):
    cells = {1: (0.0, 1.0), 2: (1.0, 1.0), 3: (0.0, 0.0), 4: (9.0, 9.0)}
    catchments = spark.createDataFrame([(i, wkb.polygon([_square(*p)])) for i, p in cells.items()], "id long, geometry binary")
    graph = spark.createDataFrame([(1, []), (2, []), (3, [1, 2]), (4, [])], "id long, upstream_ids array<long>")
    snap = spark.createDataFrame([(10, 3, 5.0, True, 0.5, 0.5), (11, 1, 9.0, True, 0.501, 0.5), (12, 77, 99.0, True, 0.5, 0.5), (13, None, 99.0, True, 0.5, 0.5)], "id long, catchment_id long, weight double, is_mainstem boolean, lon double, lat double")
    outlets = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 50.0, 50.0), (4, float("nan"), 1.0), (None, 0.0, 0.0), (5, 0.4995, 0.5)], "outlet_id long, lon double, lat double")
    h = network.H.build(graph)
    got = {r.outlet_id: r for r in delineation.delineate(outlets, snap.where("id <> 11"), catchments, h, 500.0).collect()}
    assert {k: (r.atom_id, r.how, r.n_atoms) for k, r in got.items()} == {1: (3, "snap", 3), 2: (2, "inside", 1), 3: (None, None, None), 5: (3, "snap", 3)}
    assert got[1].n_rings == 1 and bytes(got[1].geometry) == bytes(got[5].geometry)
    assert delineation.delineate(outlets, snap, catchments, h, 500.0).where("outlet_id = 1").first().atom_id == 1
    own = spark.createDataFrame([(1, wkb.polygon([_square(0.0, 0.5, 1.0, 0.5)]))], "outlet_id long, geometry binary")
    fine = {r.outlet_id: r for r in delineation.delineate(outlets, snap.where("id <> 11"), catchments, h, 500.0, own).collect()}
    assert abs(sum(dissolve.signed_area(r[:-1]) for r in wkb.rings(bytes(fine[1].geometry))) - 2.5) < 1e-9 and fine[5].area_km2 == got[5].area_km2
    assert delineation.delineate(outlets.limit(0), snap, catchments, h).count() == 0
