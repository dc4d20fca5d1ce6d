import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rillstone.functions import wkb
from rillstone.operators import diagnostics as D
from rillstone.sources import footers, geotiff
from rillstone.sources.dataset import read_manifest, validate

#: The five-atom Y of the conformance data: id, west, south, east, north, upstream ids.
TINY = [(1, 0.0, 1.0, 1.0, 2.0, []), (2, 1.0, 1.0, 2.0, 2.0, []), (3, 0.5, 0.0, 1.5, 1.0, [1, 2]), (4, 0.5, -1.0, 1.5, 0.0, [3]), (5, 0.5, -2.0, 1.5, -1.0, [4])]


def build(path, atoms=TINY, graph=None, manifest=None, rows_per_group=None, nullable=False, snap=None):
    path.mkdir(parents=True, exist_ok=True)
    box = [pa.field(f"bbox_{c}", pa.float32(), nullable) for c in ("minx", "miny", "maxx", "maxy")]
    schema = pa.schema([pa.field("id", pa.int64(), nullable), pa.field("area_km2", pa.float32(), nullable), pa.field("up_area_km2", pa.float32()), *box, pa.field("geometry", pa.binary(), nullable)])
    geo = [wkb.polygon([[(w, s), (e, s), (e, n), (w, n), (w, s)]]) for _, w, s, e, n, _ in atoms]
    cols = [[a[0] for a in atoms], [1.0] * len(atoms), [None] * len(atoms), *([a[k] for a in atoms] for k in range(1, 5)), geo]
    pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema), path / "catchments.parquet", row_group_size=rows_per_group)
    g = graph or [(a[0], a[5]) for a in atoms]
    gs = pa.schema([pa.field("id", pa.int64(), False), pa.field("upstream_ids", pa.list_(pa.field("item", pa.int64(), True)), False)])
    with pa.ipc.new_file(str(path / "graph.arrow"), gs) as w:
        for part in (g[: len(g) // 2], g[len(g) // 2 :]):
            w.write_batch(pa.record_batch([pa.array([x for x, _ in part], pa.int64()), pa.array([u for _, u in part], gs.field(1).type)], schema=gs))
    m = {"format_version": "0.1", "fabric_name": "tiny", "crs": "EPSG:4326", "has_up_area": False, "has_rasters": False, "has_snap": snap is not None, "terminal_sink_id": 0, "topology": "tree", "bbox": [-180.0, -90.0, 180.0, 90.0], "atom_count": len(atoms), "created_at": "2026-01-01T00:00:00Z", "adapter_version": "1"}
    if snap is not None:
        ss = pa.schema([pa.field("id", pa.int64(), False), pa.field("catchment_id", pa.int64(), False), pa.field("weight", pa.float32(), False), pa.field("is_mainstem", pa.bool_(), False), *[f.with_nullable(False) for f in box], pa.field("geometry", pa.binary(), False)])
        pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*snap), ss)], schema=ss), path / "snap.parquet")
    (path / "manifest.json").write_text(json.dumps(m | (manifest or {})))
    return str(path)


def found(spark, path, **kw):
    return {(r.check_id, r.severity): r.message for r in validate(spark, path, sample_pct=100, **kw).collect()}


def test_tiny_is_valid(spark, tmp_path):
    d = validate(spark, build(tmp_path / "d"), strict=True)
    assert d.collect() == []
    assert D.as_text(d).endswith("Result: VALID") and json.loads(D.as_json(d))["passed"] is True


def test_findings(spark, tmp_path):
    bad = [(1, -0.0, 1.0, 1.0, 2.0, [2]), (2, 1.0, 1.0, 1.0, 2.0, [1]), (2, 1.0, 1.0, 2.0, 2.0, []), (-4, 0.0, 0.0, 1.0, float("nan"), []), (0, 170.0, 0.0, 190.0, 1.0, [])]
    graph = [(1, [2]), (2, [1]), (3, [2, 999, None, -5]), (3, [])]
    snap = [(1, 1, 1.0, True, 0.5, 0.5, 0.5, 0.5, wkb.point(0.5, 0.5)), (1, 77, -1.0, False, 1.0, 0.0, 0.0, 0.0, wkb.polygon([[(0, 0), (1, 0), (0, 1)]])), (-3, 1, float("inf"), False, 0.0, 0.0, 0.0, 0.0, b"\x01")]
    got = found(spark, build(tmp_path / "d", bad, graph, {"crs": "EPSG:32632", "bbox": [0.0, 0.0, 100.0, 90.0], "atom_count": 9, "fabric_name": "tiny\n"}, 2, snap=snap))
    for c in ("manifest.crs", "manifest.fabric_name", "ids.catchment_negative", "ids.catchment_zero", "ids.catchment_duplicate", "ids.catchment_bbox", "ids.graph_duplicate", "ids.upstream_zero", "ids.upstream_negative", "referential.upstream_not_in_catchments", "referential.catchment_not_in_graph", "referential.graph_not_in_catchments", "graph.cycle_detected", "values.bbox_enclosure", "schema.atom_count_mismatch", "ids.snap_id", "ids.snap_duplicate", "ids.snap_weight", "ids.snap_bbox", "geometry.snap_wrong_type", "geometry.snap_too_short", "referential.snap_catchment_not_in_catchments"):
        assert (c, "ERROR") in got, c
    assert ("schema.catchments.rg_count", "WARN") in got and "EPSG:32632" in got["manifest.crs", "ERROR"]


def test_files_and_schema(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert {c for c, _ in found(spark, str(tmp_path / "empty"))} == {f"file_presence.{k}" for k in ("manifest", "catchments", "graph")}
    got = found(spark, build(tmp_path / "n", nullable=True))
    assert ("schema.wrong_nullability", "ERROR") in got and not any(c.startswith("ids.") for c, _ in got)
    p = build(tmp_path / "b")
    (tmp_path / "b" / "graph.arrow").write_bytes(b"nothing")
    (tmp_path / "b" / "catchments.parquet").write_bytes(b"nothing")
    assert {c for c, _ in found(spark, p)} == {"graph.ipc_open", "catchments.parquet_open"}


def test_manifest_stages(tmp_path):
    f = tmp_path / "m.json"
    assert read_manifest(str(f))[1][0][0] == "manifest.read"
    for text, check in (("{", "json_parse"), ("[]", "deserialize"), ('{"atom_count": -1}', "deserialize"), ('{"has_snap": 1}', "deserialize"), ('{"bbox": ["a"]}', "deserialize"), ('{"terminal_sink_id": true}', "deserialize")):
        f.write_text(text)
        assert read_manifest(str(f))[1][0][0] == f"manifest.{check}", text
    f.write_text('{"atom_count": 3, "other": 1}')
    assert read_manifest(str(f))[0]["atom_count"] == 3


@pytest.mark.parametrize("rows,sizes,want", [(100, [100], None), (12, [6, 6], "rg_count"), (4096, [4096], None), (8192, [4096, 4096], None), (4096, [2048, 2048], "rg_size"), (4596, [4096, 500], "rg_size"), (9000, [9000], "rg_size")])
def test_row_group_rules(spark, rows, sizes, want):
    from rillstone.operators import checks

    f = spark.createDataFrame([(i, n, True) for i, n in enumerate(sizes)], "row_group int, n_rows long, has_stats boolean")
    assert [r.check_id for r in checks.row_groups(f, "x").collect()] == ([f"schema.x.{want}"] if want else [])


def test_rasters(spark, tmp_path):
    p = build(tmp_path / "r", manifest={"has_rasters": True, "flow_dir_encoding": "esri", "bbox": [0.0, -2.0, 2.0, 2.0]})
    d, a = np.full((60, 60), 1, np.uint8), np.full((60, 60), 5.0, np.float32)
    (tmp_path / "r" / "flow_dir.tif").write_bytes(geotiff.write_tiled(d, -0.5, 2.5, 0.1, 255, tile=32))
    (tmp_path / "r" / "flow_acc.tif").write_bytes(geotiff.write_tiled(a, -0.5, 2.5, 0.1, -1, tile=32))
    assert found(spark, p) == {}
    (tmp_path / "r" / "flow_acc.tif").write_bytes(geotiff.write_tiled(d, 0.5, 1.5, 0.01, 7, tile=32, epsg=32632))
    got = {c for c, _ in found(spark, p)}
    assert got == {"raster.flow_acc_dtype", "raster.flow_acc_nodata", "raster.crs_mismatch", "raster.extent_not_contained"}
    assert found(spark, p, skip_rasters=True) == {}
    (tmp_path / "r" / "flow_acc.tif").write_bytes(b"II*\0")
    assert {c for c, _ in found(spark, p)} == {"raster.parse"}
    raw = geotiff.write_tiled(np.arange(70 * 50, dtype=np.float32).reshape(70, 50), 0, 0, 1, -1, tile=32)
    back = np.zeros((70, 50), np.float32)
    for r, c, t in geotiff.tiles(raw):
        back[r * 32 : r * 32 + t.shape[0], c * 32 : c * 32 + t.shape[1]] = t
    assert (back == np.arange(3500, dtype=np.float32).reshape(70, 50)).all()


def test_arrow_round_trip(spark, tmp_path):
    from rillstone.sources.arrow_ipc import ArrowIpc

    spark.dataSource.register(ArrowIpc)
    df = spark.createDataFrame([(1, [2, None]), (2, []), (3, None)], "id long, upstream_ids array<long>")
    df.write.format("arrow_ipc").mode("overwrite").save(str(tmp_path / "g"))
    back = spark.read.format("arrow_ipc").load(str(tmp_path / "g"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    file = next((tmp_path / "g").glob("*.arrow"))
    assert str(pa.ipc.open_file(str(file)).schema.field("upstream_ids").type) == "list<item: int64>"


def test_written_parquet_is_geoparquet(spark, tmp_path):
    from rillstone.operators import compilation

    df = spark.range(9000).selectExpr("id + 1 as id", "cast(id % 360 - 180 as float) bbox_minx", "cast(id % 170 - 85 as float) bbox_miny", "cast(id % 360 - 179.5 as float) bbox_maxx", "cast(id % 170 - 84.5 as float) bbox_maxy", "cast('x' as binary) geometry")
    n = compilation.write_parquet(compilation.curve_order(df).drop("h").coalesce(1), str(tmp_path / "o"), ["Polygon"], ("id", "geometry"))
    file = next((tmp_path / "o").glob("*.parquet"))
    meta = pq.ParquetFile(file).metadata
    assert n == 1 and [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [4500, 4500]
    assert footers.geo_problems(str(file)) == [] and not pq.ParquetFile(file).schema_arrow.field("id").nullable
