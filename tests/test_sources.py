import sqlite3
import struct
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rillstone.functions import wkb
from rillstone.operators import compilation, rasters
from rillstone.sources import arrow_ipc, geotiff, manifests, reading, vectors


def ids(spark, path):
    return sorted(r.id for r in spark.read.format("arrow_ipc").load(path).collect())


def test_only_committed_parts_are_read(spark, tmp_path):
    """A task's first attempt that fails leaves nothing, overwriting removes the old parts and only then."""
    spark.dataSource.register(arrow_ipc.ArrowIpc)
    path = str(tmp_path / "graph")
    spark.range(10).repartition(3).write.format("arrow_ipc").mode("overwrite").save(path)
    assert ids(spark, path) == list(range(10))
    spark.range(5).repartition(2).write.format("arrow_ipc").mode("append").save(path)
    assert ids(spark, path) == sorted([*range(10), *range(5)])
    w = arrow_ipc.ArrowIpcWriter(path, spark.range(1).schema, True)

    def failing():
        yield pa.record_batch({"id": [1, 2]})
        raise OSError("lost")

    with pytest.raises(OSError):
        w.write(failing())
    assert ids(spark, path) == sorted([*range(10), *range(5)])  # nothing is gone, nothing staged is read
    again = w.write(iter([pa.record_batch({"id": [1, 2]})]))
    twin = w.write(iter([pa.record_batch({"id": [1, 2]})]))  # a speculative attempt that is not committed
    assert twin.path != again.path
    w.commit([again, None])
    assert ids(spark, path) == [1, 2] and len(list((tmp_path / "graph").iterdir())) == 1
    w = arrow_ipc.ArrowIpcWriter(path, spark.range(1).schema, True)
    w.write(iter([pa.record_batch({"id": [9]})]))
    w.abort([])
    assert ids(spark, path) == [1, 2] and len(list((tmp_path / "graph").iterdir())) == 1


def test_batch_rows_are_read_from_headers(tmp_path):
    schema = pa.schema([("id", pa.int64()), ("u", pa.list_(pa.int64()))])
    sizes = [3, 0, 700, 1]
    with pa.ipc.new_file(str(tmp_path / "a.arrow"), schema) as w:
        for n in sizes:
            w.write_batch(pa.record_batch([list(range(n)), [[1]] * n], schema=schema))
    with pa.OSFile(str(tmp_path / "a.arrow")) as f:
        assert arrow_ipc.batch_rows(f, f.size()) == sizes
    with pa.ipc.new_file(str(tmp_path / "b.arrow"), schema):
        pass
    with pa.OSFile(str(tmp_path / "b.arrow")) as f:
        assert arrow_ipc.batch_rows(f, f.size()) == []


def test_written_parquet_replaces_what_was_there(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "cast('x' as binary) geometry")
    assert compilation.write_parquet(df.repartition(5), folder, ["Point"]) == 5
    assert compilation.write_parquet(df.where("id < 10").repartition(2), folder, ["Point"], codec="none") == 2
    assert spark.read.parquet(folder).count() == 10 and len(list((tmp_path / "t").iterdir())) == 2
    bad = df.selectExpr("id", "geometry", "assert_true(id < 50) as x").drop("x").selectExpr("id", "if(id > 50, raise_error('no'), geometry) geometry")
    with pytest.raises(Exception, match="no"):
        compilation.write_parquet(bad.repartition(2), folder, ["Point"])
    assert spark.read.parquet(folder).count() == 10 and not [f for f in (tmp_path / "t").iterdir() if f.name.startswith("_staging")]


def test_unreadable_batches_are_findings(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    t = pa.table({"id": pa.array(range(120), pa.int64()), "g": pa.array([b"x" * 50 + bytes([k]) for k in range(120)])})
    pq.write_table(t, path, row_group_size=10, compression="zstd", use_dictionary=False)

    def spoil(groups):
        pq.write_table(t, path, row_group_size=10, compression="zstd", use_dictionary=False)
        meta = pq.ParquetFile(path).metadata
        raw = bytearray(open(path, "rb").read())
        for g in groups:
            c = meta.row_group(g).column(1)
            raw[c.data_page_offset : c.data_page_offset + c.total_compressed_size] = b"\xff" * c.total_compressed_size
        open(path, "wb").write(raw)
        return reading.unreadable(spark, path, "parquet")

    assert reading.findings(spoil([]), "catchments") == ([], False)
    bad = spoil([1, 5])
    found, stop = reading.findings(bad, "catchments")
    assert [f[0] for f in found] == ["catchments.batch_read"] * 2 and not stop
    from rillstone.operators.checks import with_row

    schema = with_row(spark.read.parquet(path)).schema
    rest = {(r.id, r._row) for r in reading.without(spark, path, "parquet", bad, schema).collect()}
    assert rest == {(k, k) for k in range(120) if k // 10 not in (1, 5)}
    found, stop = reading.findings(spoil([0, 2, 3, 4, 8]), "snap")
    assert [f[0] for f in found] == ["snap.batch_read"] * 4 + ["snap.batch_read_aborted"] and stop
    found, stop = reading.findings(spoil([0, 1, 3, 4, 6, 7, 9, 10]), "snap")
    assert len(found) == 8 and not stop


def test_tiles_overviews_and_ranges(spark, tmp_path):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 200, (75, 110)).astype(np.uint8)
    side = 16
    rows = [(r // side, c // side, 5.0 + c * 0.5, 9.0 - r * 0.5, 0.5, int(min(side, 110 - c)), a[r : r + side, c : c + side].ravel().tolist()) for r in range(0, 75, side) for c in range(0, 110, side)]
    t = spark.createDataFrame([x for x in rows if x[:2] != (2, 3)], "tile_row int, tile_col int, x0 double, y0 double, pixel double, width int, values array<int>").repartition(3)
    levels = [t]
    for _ in range(3):
        levels.append(rasters.overview(levels[-1], side))
    path = str(tmp_path / "a.tif")
    assert geotiff.write_cog(levels, path, 110, 75, side, 5.0, 9.0, 0.5, "uint8", 255) > 30
    assert [p.name for p in tmp_path.iterdir()] == ["a.tif"]
    want = a.copy()
    want[32:48, 48:64] = 255
    raw = open(path, "rb").read()
    got = np.zeros_like(a)
    for r, c, v in geotiff.tiles(raw):
        got[r * side : r * side + v.shape[0], c * side : c * side + v.shape[1]] = v
    assert np.array_equal(got, want)
    h = geotiff.header(raw)
    assert (h.width, h.height, h.bits, h.sample_format, h.is_tiled, h.nodata, h.crs, h.n_images) == (110, 75, 8, "uint", True, 255.0, "EPSG:4326", 4)
    assert geotiff.cog_problems(raw) == [] and (h.minx, h.maxy, h.maxx) == (5.0, 9.0, 60.0)
    spark.dataSource.register(geotiff.GeoTiff)
    some = spark.read.format("geotiff").option("bbox", "14,0.5,20,3").load(path).collect()
    assert {(r.tile_row, r.tile_col) for r in some} == {(r, c) for r in range(5) for c in range(7) if 5 + 8 * c <= 20 and 5 + 8 * (c + 1) > 14 and 9 - 8 * r >= 0.5 and 9 - 8 * (r + 1) < 3}
    assert all(r["values"] == want[r.tile_row * side :][:side, r.tile_col * side :][:, :side].ravel().tolist() for r in some)
    half = geotiff.Image(raw, 1)
    full = np.zeros((38, 55), np.uint8)
    for r in range(half.down):
        for c in range(half.across):
            v = half.tile(r, c)
            full[r * side : r * side + v.shape[0], c * side : c * side + v.shape[1]] = v
    seen = a[::2, ::2].copy()
    seen[16:24, 24:32] = 0  # no tile, no pixels
    assert np.array_equal(full, seen) and half.pixel == 1.0

    class Counting(geotiff._Held):
        read = 0

        def read_at(self, n, at):
            self.read += n
            return super().read_at(n, at)

    f = Counting(raw + b"\0" * 10_000_000)
    geotiff.header(f)
    assert f.read < 4000
    assert geotiff.cog_problems(geotiff.write_tiled(a, 5.0, 9.0, 0.5, 255, side)) == ["0 overviews instead of 3"]
    for cut in range(0, 600, 37):
        with pytest.raises(geotiff.BadTiff):
            geotiff.header(raw[:cut])


def shapefile(base, shapes, names):
    dbf = struct.pack("<BBBBIHH20x", 3, 26, 1, 1, len(shapes), 32 + 96 + 1, 1 + 9 + 12 + 8)
    for name, letter, n, dec in ((b"COMID", b"N", 9, 0), (b"uparea", b"F", 12, 3), (b"label", b"C", 8, 0)):
        dbf += struct.pack("<11sc4xBB14x", name, letter, n, dec)
    dbf += b"\r" + b"".join((b"*" if gone else b" ") + str(k).rjust(9).encode() + (f"{u:12.3f}" if u is not None else "*" * 12).encode() + text.ljust(8).encode("latin-1") for k, u, text, gone in names)
    at, shp, shx = 50, b"", b""
    for k, s in enumerate(shapes):
        shx += struct.pack(">ii", at, len(s) // 2)
        shp += struct.pack(">ii", k + 1, len(s) // 2) + s
        at += 4 + len(s) // 2
    for end, body in ((".shp", shp), (".shx", shx)):
        open(base + end, "wb").write(struct.pack(">i20xi", 9994, 50 + len(body) // 2) + struct.pack("<ii64x", 1000, 5) + body)
    open(base + ".dbf", "wb").write(dbf)


def parts(kind, lines):
    starts = np.cumsum([0, *map(len, lines[:-1])])
    xy = np.concatenate([np.asarray(x, "<f8") for x in lines])
    return struct.pack("<i32xii", kind, len(lines), len(xy)) + struct.pack(f"<{len(lines)}i", *starts) + xy.tobytes()


def test_shapefile(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors, "RECORDS", 2)
    square = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]  # clockwise
    hole = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    far = [(9, 9), (9, 10), (10, 10), (10, 9), (9, 9)]
    shapes = [parts(5, [square, hole, far]), parts(3, [[(0, 0), (1, 2)]]), struct.pack("<i", 0), struct.pack("<idd", 1, 7.5, 8.5), parts(5, [far])]
    base = str(tmp_path / "cat")
    shapefile(base, shapes, [(71, 1.5, "a", False), (72, None, "\xe9", False), (73, 2.0, "", False), (74, 3.25, "p", False), (75, 9.0, "gone", True)])
    spark.dataSource.register(vectors.Shapefile)
    got = {r.COMID: r for r in spark.read.format("shapefile").load(base + ".shp").collect()}
    assert sorted(got) == [71, 72, 73, 74] and got[71].uparea == 1.5 and got[72].uparea is None and got[72].label == "\xe9" and got[73].label is None
    r = wkb.rings(bytes(got[71].geometry))
    assert [len(x) for x in r] == [5, 5, 5] and wkb.parse(bytes(got[71].geometry))[0] == wkb.MULTIPOLYGON
    assert len(wkb.parse(bytes(got[71].geometry))[1][0][1]) == 2  # the hole went with its own polygon
    assert wkb.last_vertex(bytes(got[72].geometry)) == (1.0, 2.0) and got[73].geometry is None and wkb.last_vertex(bytes(got[74].geometry)) == (7.5, 8.5)
    open(base + ".prj", "w").write('PROJCS["UTM"]')
    with pytest.raises(Exception, match="not in longitude"):
        spark.read.format("shapefile").load(base + ".shp").count()


def test_geopackage_in_zip_in_zip(spark, tmp_path):
    con = sqlite3.connect(str(tmp_path / "x.gpkg"))
    con.execute("create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id int, z int, m int)")
    con.execute("insert into gpkg_geometry_columns values ('lines', 'geom', 'LINESTRING', 4326, 0, 0)")
    con.execute('create table lines (fid integer primary key, geom blob, "global id" integer, upstream_line_ids text, area real, ok boolean)')
    line = wkb.linestring([(1.0, 2.0), (3.0, 4.0)])
    con.executemany("insert into lines values (?, ?, ?, ?, ?, ?)", [(1, b"GP\0\x01" + struct.pack("<i", 4326) + line, 5, "1,2", 2.5, 1), (2, b"GP\0\x03" + struct.pack("<i", 4326) + b"\0" * 32 + line, 6, None, 3, 0), (7, None, 8, "", None, None)])
    con.commit()
    con.close()
    with zipfile.ZipFile(tmp_path / "inner.zip", "w") as z:
        z.write(tmp_path / "x.gpkg", "data/x.gpkg")
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.write(tmp_path / "inner.zip", "inner.zip")
    spark.dataSource.register(vectors.GeoPackage)
    got = {r.fid: r for r in spark.read.format("geopackage").load(str(tmp_path / "outer.zip")).collect()}
    assert [got[k]["global id"] for k in (1, 2, 7)] == [5, 6, 8] and bytes(got[1].geometry) == bytes(got[2].geometry) == line and got[7].geometry is None
    assert got[1].ok is True and got[2].area == 3.0 and got[7].ok is None


def test_basins(spark, tmp_path):
    for b in ("b01", "b02", "b03"):
        (tmp_path / b).mkdir()
        for f in ("catchments.parquet", "graph.arrow") + (() if b == "b03" else ("manifest.json",)):
            (tmp_path / b / f).write_text('{"format_version": "0.1", "fabric_name": "f01", "has_snap": false, "has_rasters": false}')
    found = compilation.basin_folders(str(tmp_path))
    assert [b["basin"] for b in found] == ["b01", "b02", "b03"] and found[2]["missing"] == ["manifest.json"]
    assert [b["basin"] for b in compilation.chosen(found, without=["b03"])] == ["b01", "b02"]
    for kw in ({"only": ["b09"]}, {}):
        with pytest.raises(compilation.CompileError):
            compilation.chosen(found, **kw)
    assert compilation.complete(str(tmp_path), ["b01", "b03", "b04"], "f02") == {"b01": "fabric is f01", "b03": "lacks manifest.json", "b04": "no folder"}
    assert compilation.fabric_code("basin_", 7) == "basin_07"
    r = compilation.batch_summary(spark.createDataFrame([("a", "ok", 5, 1.5), ("b", "failed", None, 2.0), ("c", "skipped", None, None)], "basin string, status string, atoms long, seconds double")).first()
    assert tuple(r) == (3, 1, 1, 1, 5, 3.5)


def test_declared_manifest():
    good = {"format_version": "0.1", "fabric_name": "a", "crs": "EPSG:4326", "has_up_area": True, "has_rasters": False, "has_snap": False, "terminal_sink_id": 0, "topology": "dag", "bbox": [0, 0, 1, 1], "atom_count": 3, "created_at": "2026-01-01T00:00:00Z", "adapter_version": "1", "own": 1}
    assert manifests.declared_problems(good) == []
    bad = good | {"has_rasters": True, "bbox": [0, 1, 2], "atom_count": 0, "topology": "loop", "fabric_name": "A", "terminal_sink_id": True, "crs": None}
    assert {f for f, _ in manifests.declared_problems(bad)} == {"flow_dir_encoding", "bbox", "atom_count", "topology", "fabric_name", "terminal_sink_id", "crs"}
    assert manifests.declared_problems([]) == [("", "is no object")]
