"""Compiling datasets: guards, curve order, row groups, tables from source layers, merging basins."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import boxes, hierarchy, network
from rillstone.sources.arrow_ipc import _filesystem, publish
from rillstone.sources.footers import geo_metadata
from rillstone.sources.manifests import read_manifest
from rillstone.sources.schemas import BOX, FILES, MANIFEST

GROUP_MIN, GROUP_MAX = 4096, 8192
#: Manifest fields that all merged basins must share.
CONSENSUS = ("format_version", "fabric_name", "crs", "topology", "terminal_sink_id", "flow_dir_encoding")


class CompileError(ValueError):
    pass


def group_bounds(n: int, least: int = GROUP_MIN, most: int = GROUP_MAX) -> list[tuple[int, int]]:
    """Row groups from start to stop: as many as have at least `least` rows each, if then none has more than `most`;
    sizes differ by one at most, larger first. Else one group."""
    if n <= 0:
        return []
    k = max(1, n // least)
    if -(-n // k) > most:
        k = 1
    small, larger = divmod(n, k)
    starts = [i * small + min(i, larger) for i in range(k + 1)]
    return list(zip(starts, starts[1:]))


def guard_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """The table itself, or an error that tells how many ids are null, not positive or repeated."""
    bad = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col(key).isNull()).alias("null"), F.count_if(F.col(key) <= 0).alias("low"), F.count_if(F.col("n") > 1).alias("again")).first()
    if bad["null"] or bad["low"] or bad["again"]:
        raise CompileError(f"ids: {bad['null']} null, {bad['low']} not positive, {bad['again']} repeated")
    return df


def reconcile(a: DataFrame, b: DataFrame, key: str = "id", least: float = 0.95) -> tuple[DataFrame, DataFrame, dict]:
    """Both tables without the keys that the other lacks, and how much that was. Below `least` of either: an error."""
    cover = coverage(a, b, key).first()
    if min(cover.share_a, cover.share_b) < least:
        raise CompileError(f"keys agree for {cover.share_a:.3f} and {cover.share_b:.3f} of the tables")
    return a.join(b.select(key), key, "left_semi"), b.join(a.select(key), key, "left_semi"), cover.asDict()


def guard_acyclic(graph: DataFrame) -> DataFrame:
    """The graph itself, or an error that tells how many atoms lie on or downstream of a cycle, with some of them."""
    left = network.blocked(hierarchy.build(graph))
    n = left.count()
    if n:
        some = ", ".join(str(r.id) for r in left.orderBy("id").limit(10).collect())
        raise CompileError(f"cycle detected: {n} atoms on or downstream of a cycle, among them {some}")
    return graph


def guard_measure(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """The table itself, or an error: values that are null, not finite or negative."""
    v = F.col(column).cast("double")
    bad = df.where(~F.coalesce(~F.isnan(v) & (v >= 0) & (v < float("inf")), F.lit(False)))
    n = bad.count()
    if n:
        raise CompileError(f"{column}: {n} values are null, not finite or negative, first at {key} {bad.agg(F.min(key)).first()[0]}")
    return df


def coverage(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """n_a, n_b, n_common, share_a, share_b over distinct keys."""
    x = a.select(key).where(F.col(key).isNotNull()).distinct().withColumn("a", F.lit(1))
    y = b.select(key).where(F.col(key).isNotNull()).distinct().withColumn("b", F.lit(1))
    n = x.join(y, key, "full_outer").agg(F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n_common"))
    share = lambda c: F.when(F.col(c) > 0, F.col("n_common") / F.col(c)).otherwise(0.0)
    return n.select("*", share("n_a").alias("share_a"), share("n_b").alias("share_b"))


def collisions(df: DataFrame, key: str = "id", basin: str = "basin") -> DataFrame:
    """key, n_basins, n_rows: keys of more than one basin."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(basin).alias("n_basins"), F.count(F.lit(1)).alias("n_rows")).where("n_basins > 1")


def consensus(manifests: DataFrame, fields: tuple[str, ...] = CONSENSUS) -> DataFrame:
    """field, n_values, agreed: how many values each field has over all basins, null being one."""
    one = manifests.agg(*[(F.countDistinct(f) + F.max(F.col(f).isNull().cast("int"))).alias(f) for f in fields])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("long").alias("n_values")) for f in fields])).alias("x")).select("x.field", "x.n_values", (F.col("x.n_values") == 1).alias("agreed"))


def envelope(manifests: DataFrame, pad: float = 1e-4) -> DataFrame:
    """minx, miny, maxx, maxy of all boxes of four numbers, moved outward and kept on the globe; and the atoms' sum."""
    b = manifests.where(F.size("bbox") == 4)
    at = lambda i: F.col("bbox")[i]
    return b.agg(
        F.greatest(F.min(at(0)) - pad, F.lit(-180.0)).alias("minx"), F.greatest(F.min(at(1)) - pad, F.lit(-90.0)).alias("miny"),
        F.least(F.max(at(2)) + pad, F.lit(180.0)).alias("maxx"), F.least(F.max(at(3)) + pad, F.lit(90.0)).alias("maxy"), F.sum("atom_count").alias("atom_count"),
    )


def curve_order(df: DataFrame, bounds: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Range-partitioned and sorted along the Hilbert curve of the box centres (over bounds, else the whole globe), by
    id where equal. Adds h."""
    x0, y0, x1, y1 = bounds or (-180.0, -90.0, 180.0, 90.0)
    cx, cy = (F.col("bbox_minx").cast("double") + F.col("bbox_maxx")) / 2, (F.col("bbox_miny").cast("double") + F.col("bbox_maxy")) / 2
    h = boxes.hilbert(boxes.on_grid(cx, x0, x1), boxes.on_grid(cy, y0, y1))
    return df.withColumn("h", h).repartitionByRange(F.col("h"), F.col("id")).sortWithinPartitions("h", "id")


def write_parquet(df: DataFrame, folder: str, types: list[str], required: tuple[str, ...] = (), codec: str = "snappy") -> int:
    """One file per partition, in its order, with balanced row groups, statistics and `geo` metadata; they replace what the
    folder held. Number of files.

    A partition is read into one task, as large as Spark's shuffle partitions are; files get the partition's number. Tasks
    write to a staging folder; the files that succeeded tasks name are published, those of other attempts are not.
    """
    names = df.columns
    meta = geo_metadata(types)
    stage = f"_staging-{uuid.uuid4().hex}"

    def run(batches):
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        batches = list(batches)
        t = pa.Table.from_batches(batches) if batches else None
        if t is None or not t.num_rows:
            return
        schema = pa.schema([pa.field(f.name, f.type, f.name not in required) for f in t.schema], metadata={b"geo": meta})
        t = pa.table([t[c].cast(schema.field(c).type) for c in names], schema=schema)
        fs, p = _filesystem(folder)
        fs.create_dir(f"{p}/{stage}", recursive=True)
        target = f"{p}/{stage}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        with fs.open_output_stream(target) as out, pq.ParquetWriter(out, schema, compression=codec) as w:
            for a, b in group_bounds(t.num_rows):
                w.write_table(t.slice(a, b - a), row_group_size=b - a)
        yield pa.RecordBatch.from_pydict({"path": [target]})

    parts: list[str] = []
    try:
        parts = [r.path for r in df.mapInArrow(run, "path string").collect()]  # names of files
    finally:
        publish(folder, stage, parts, bool(parts))
    return len(parts)


def write_manifest(path: str, fields: dict) -> None:
    doc = {"created_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), **{k: v for k, v in fields.items() if v is not None}}
    fs, p = _filesystem(path)
    with fs.open_output_stream(p) as f:
        f.write(json.dumps(doc, sort_keys=True, indent=2).encode())


def from_tree(catchments: DataFrame, rivers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(catchments, graph, snap) from a tree fabric. catchments: id, area, box, geometry; rivers: id, next_down, uparea,
    box, geometry. Catchments without a river are left out, as rivers without a catchment, up to the share reconcile
    allows; up_area_km2 is the river's. Cycles and areas that are no areas are errors."""
    guard_ids(catchments)
    c, r, _ = reconcile(catchments, rivers)
    guard_measure(r, "uparea")
    cat = c.join(r.select("id", F.col("uparea").cast("float").alias("up_area_km2")), "id").select("id", F.col("area").cast("float").alias("area_km2"), "up_area_km2", *BOX, "geometry")
    graph = guard_acyclic(network.edges_from_next_down(r))
    main = network.mainstem(r.select("id", F.col("next_down").alias("down"), F.col("uparea").alias("area")))
    lo_x, hi_x = boxes.inflated("bbox_minx", "bbox_maxx")
    lo_y, hi_y = boxes.inflated("bbox_miny", "bbox_maxy")
    box = [e.cast("float").alias(n) for n, e in zip(BOX, (lo_x, lo_y, hi_x, hi_y))]
    snap = r.join(main.select("id", "is_mainstem"), "id").select("id", F.col("id").alias("catchment_id"), F.col("uparea").cast("float").alias("weight"), "is_mainstem", *box, "geometry")
    return cat, graph, snap


def from_segments(segments: DataFrame, catchments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(catchments, graph, snap) from a fabric of segments with upstream ids in a text: id, upstream_line_ids,
    is_mainstem (1 or not), drainage_area_out, box, geometry; up_area_km2 is left null. Segments must match catchments."""
    guard_ids(segments)
    guard_ids(catchments)
    odd = coverage(catchments, segments).first()
    if not odd.share_a == odd.share_b == 1.0:
        raise CompileError(f"ids differ: {odd.n_a} catchments, {odd.n_b} segments, {odd.n_common} common")
    cat = catchments.select("id", F.col("area").cast("float").alias("area_km2"), F.lit(None).cast("float").alias("up_area_km2"), *BOX, "geometry")
    graph = segments.select("id", F.sort_array(F.array_distinct(network.csv_ids(F.col("upstream_line_ids")))).alias("upstream_ids"))
    snap = segments.select("id", F.col("id").alias("catchment_id"), F.col("drainage_area_out").cast("float").alias("weight"), F.coalesce(F.col("is_mainstem") == 1, F.lit(False)).alias("is_mainstem"), *BOX, "geometry")
    return cat, graph, snap


def merge(tables: DataFrame, basin: str = "basin") -> DataFrame:
    """Rows of all basins in one order along the globe's curve, basin and id deciding where equal. Adds h."""
    return boxes.world_order(tables).repartitionByRange(F.col("h"), F.col(basin), F.col("id")).sortWithinPartitions("h", basin, "id")


# ---- batches of basins ------------------------------------------------------------------------------------------------


def basin_folders(root: str, files: tuple[str, ...] = tuple(FILES.values()), needed: tuple[str, ...] = ("manifest.json", "catchments.parquet", "graph.arrow")) -> list[dict]:
    """basin, path, missing (of needed), has: the folders of a root, by name. One listing per folder, no data."""
    import pyarrow.fs as pafs

    fs, p = _filesystem(root)
    out = []
    for d in sorted((f for f in fs.get_file_info(pafs.FileSelector(p)) if f.type == pafs.FileType.Directory and not f.base_name.startswith(("_", "."))), key=lambda f: f.base_name):
        there = {f.base_name for f in fs.get_file_info(pafs.FileSelector(d.path))}
        out.append({"basin": d.base_name, "path": f"{root.rstrip('/')}/{d.base_name}", "missing": [x for x in needed if x not in there], "has": [x for x in files if x in there]})
    return out


def chosen(found: list[dict], only: list[str] | None = None, without: list[str] | None = None) -> list[dict]:
    """The basins of a run: all or those named, less those left out; a name that is not there and a chosen basin with missing
    files are errors."""
    names = {b["basin"] for b in found}
    unknown = sorted((set(only or ()) | set(without or ())) - names)
    if unknown:
        raise CompileError(f"no such basin: {', '.join(unknown)}")
    out = [b for b in found if (not only or b["basin"] in only) and b["basin"] not in (without or ())]
    broken = [f"{b['basin']} lacks {', '.join(b['missing'])}" for b in out if b["missing"]]
    if broken:
        raise CompileError("; ".join(broken))
    return out


def batch_summary(results: DataFrame) -> DataFrame:
    """n_basins, n_ok, n_failed, n_skipped, atoms, seconds; results: basin, status (ok, failed, skipped), atoms, seconds."""
    n = lambda s: F.count_if(F.col("status") == s)
    return results.agg(F.count(F.lit(1)).alias("n_basins"), n("ok").alias("n_ok"), n("failed").alias("n_failed"), n("skipped").alias("n_skipped"), F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("atoms"))), F.lit(0)).alias("atoms"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))


def merge_basins(found: list[dict], spark: SparkSession, target: str) -> dict:
    """Basins to one dataset: manifests must agree, ids must not collide; catchments, graph and snap in one order each, a
    manifest with the envelope and the sum of atoms. Returns the manifest."""
    from rillstone.sources.arrow_ipc import ArrowIpc

    spark.dataSource.register(ArrowIpc)
    read = {b["basin"]: read_manifest(f"{b['path']}/{FILES['manifest']}") for b in found}
    broken = [b for b, (m, _) in read.items() if m is None]
    if broken:
        raise CompileError(f"manifests can't be read: {', '.join(broken)}")
    manifests = spark.createDataFrame([tuple(m[f.name] for f in MANIFEST.fields) for m, _ in read.values()], MANIFEST)
    odd = [r.field for r in consensus(manifests, (*CONSENSUS, "has_snap", "has_up_area")).where("not agreed").collect()]
    if odd:
        raise CompileError(f"manifests differ in {', '.join(odd)}")
    tagged = lambda df, b: df.withColumn("basin", F.lit(b["basin"]))
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    cat = union([tagged(spark.read.parquet(f"{b['path']}/{FILES['catchments']}"), b) for b in found])
    clash = collisions(cat).count()
    if clash:
        raise CompileError(f"{clash} ids occur in more than one basin")
    drop = lambda df: df.drop("basin", "h")
    write_parquet(drop(merge(cat)), f"{target}/{FILES['catchments']}", ["MultiPolygon", "Polygon"], ("id", "area_km2", *BOX, "geometry"))
    graph = union([spark.read.format("arrow_ipc").load(f"{b['path']}/{FILES['graph']}") for b in found])
    graph.repartitionByRange("id").sortWithinPartitions("id").write.format("arrow_ipc").mode("overwrite").save(f"{target}/{FILES['graph']}")
    first = next(iter(read.values()))[0]
    if first["has_snap"]:
        snap = union([tagged(spark.read.parquet(f"{b['path']}/{FILES['snap']}"), b) for b in found])
        write_parquet(drop(merge(snap)), f"{target}/{FILES['snap']}", ["LineString", "Point"], ("id", "catchment_id", "weight", "is_mainstem", *BOX, "geometry"))
    e = envelope(manifests).first()
    doc = {**first, "bbox": [e.minx, e.miny, e.maxx, e.maxy], "atom_count": cat.count(), "has_rasters": False, "created_at": None, "region": None}
    write_manifest(f"{target}/{FILES['manifest']}", {k: v for k, v in doc.items() if v is not None})
    return doc


def complete(root: str, names: list[str], fabric: str | None = None) -> dict[str, str]:
    """Basin to what keeps it from being complete ("" if nothing does): its folder, its files, its manifest, its fabric."""
    there = {b["basin"]: b for b in basin_folders(root)}
    out = {}
    for n in names:
        if n not in there:
            out[n] = "no folder"
            continue
        m, found = read_manifest(f"{there[n]['path']}/{FILES['manifest']}") if not there[n]["missing"] else (None, [])
        files = [FILES[k] for k, on in (("snap", m and m["has_snap"]), ("flow_dir", m and m["has_rasters"]), ("flow_acc", m and m["has_rasters"])) if on]
        lacks = there[n]["missing"] + [x for x in files if x not in there[n]["has"]]
        problem = f"lacks {', '.join(lacks)}" if lacks else found[0][4] if found else ""
        out[n] = problem or (f"fabric is {m['fabric_name']}" if fabric and m["fabric_name"] != fabric else "")
    return out


def guard_count(df: DataFrame, expected: int, what: str) -> DataFrame:
    """The table itself, or an error where it has not as many rows as it must."""
    n = df.count()
    if n != expected:
        raise CompileError(f"{what} has {n} rows instead of {expected}")
    return df


def fabric_code(prefix: str, number: int, digits: int = 2) -> str:
    """A fabric's name with its number in a fixed width."""
    return f"{prefix}{number:0{digits}d}"


def inherit(parts: DataFrame, wholes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """parts (reaches) with columns of the whole (segment) that each belongs to, null where there is none; a whole that is
    listed more than once gives its least values, so no part is repeated."""
    one = wholes.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(c) for c in columns])
    return parts.join(one, key, "left")


def id_range(df: DataFrame, key: str = "id") -> DataFrame:
    """least, most, n_rows, n_distinct of ids."""
    return df.agg(F.min(key).alias("least"), F.max(key).alias("most"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_distinct"))
