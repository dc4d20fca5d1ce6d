"""A dataset in one folder: which files there are, its manifest, its tables, and the whole validation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import checks, hierarchy, network
from rillstone.operators import diagnostics as D
from rillstone.sources import footers, geotiff, reading
from rillstone.sources.arrow_ipc import ArrowIpc, _filesystem
from rillstone.sources.manifests import declared_problems, read_manifest
from rillstone.sources.schemas import BOX, FILES, MANIFEST, TABLES
from rillstone.storage import Workspace


@dataclass
class Dataset:
    path: str
    present: dict[str, bool]
    manifest: dict | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    rasters: DataFrame | None = None
    findings: list[tuple] = field(default_factory=list)  # of reading: (check_id, severity, category, artifact, message)


def discover(path: str) -> dict[str, bool]:
    import pyarrow.fs as pafs

    fs, p = _filesystem(path)
    return {k: fs.get_file_info(f"{p}/{name}").type != pafs.FileType.NotFound for k, name in FILES.items()}


def open_dataset(spark: SparkSession, path: str, read_through: bool = True) -> Dataset:
    """Reads what is there; a problem becomes a finding and its table is left out. Snap and rasters only where declared.
    read_through decodes every batch first: those that can't be read are findings and left out, and with too many of them
    the table is (see reading); without, such a batch ends the job that meets it."""
    spark.dataSource.register(ArrowIpc)
    ds = Dataset(path, discover(path))
    if ds.present["manifest"]:
        ds.manifest, found = read_manifest(f"{path}/{FILES['manifest']}")
        ds.findings += found
    m = ds.manifest or {}
    for t in ("catchments", "graph", *(["snap"] if m.get("has_snap") else [])):
        if not ds.present[t]:
            continue
        file = f"{path}/{FILES[t]}"
        try:
            found = footers.schema_findings(footers.arrow_schema(file, "arrow" if t == "graph" else "parquet"), TABLES[t], t)
        except Exception as e:  # pyarrow raises many kinds for a file that is none of its own
            ds.findings.append((f"{t}.{'ipc_open' if t == 'graph' else 'parquet_open'}", "ERROR", "Schema", t, str(e)[:200]))
            continue
        ds.findings += found
        if any(f[1] == "ERROR" for f in found):
            continue
        whole = spark.read.format("arrow_ipc").option("row", "true").load(file) if t == "graph" else checks.with_row(spark.read.parquet(file))
        kind = "arrow" if t == "graph" else "parquet"
        bad = Workspace(spark, "unreadable").cut(reading.unreadable(spark, file, kind)) if read_through else None
        found, given_up = reading.findings(bad, t) if read_through else ([], False)
        ds.findings += found
        if not given_up:
            ds.tables[t] = reading.without(spark, file, kind, bad, whole.schema) if found else whole
    if m.get("has_rasters"):
        files = {k: f"{path}/{FILES[k]}" for k in ("flow_dir", "flow_acc") if ds.present[k]}
        if files:
            heads = geotiff.read_headers(spark, files)
            for r in heads.where("problem is not null").select("label", "problem").collect():
                ds.findings.append((r.problem.split(":")[0], "ERROR", "Raster", r.label, r.problem))
            ds.rasters = heads.where("problem is null")
    return ds


def validate(spark: SparkSession, path: str, strict: bool = False, skip_rasters: bool = False, sample_pct: float = 1.0, second_layer: bool = False) -> DataFrame:
    """All diagnostics of a dataset, capped per check. skip_rasters leaves out the raster rules only. second_layer adds what
    compiling guarantees beyond the contract: geometry metadata, and the manifest by its declaration."""
    ds = open_dataset(spark, path)
    m = ds.manifest
    parts = []
    wanted = ["manifest", "catchments", "graph", *(["snap"] if m and m["has_snap"] else []), *(["flow_dir", "flow_acc"] if m and m["has_rasters"] else [])]
    missing = [(f"file_presence.{k}", "ERROR", "FilePresence", k, f"{FILES[k]} is missing") for k in wanted if not ds.present[k]]
    parts.append(D.literal(spark, [*ds.findings, *missing]) if ds.findings or missing else D.none(spark))
    box = system = None
    if second_layer and m:
        problems = [(f"manifest.declared.{f}", "ERROR", "Manifest", "manifest", f"{f} {text}") for f, text in declared_problems(m)]
        parts.append(D.literal(spark, problems) if problems else D.none(spark))
    if m:
        row = spark.createDataFrame([tuple(m[f.name] for f in MANIFEST.fields)], MANIFEST)
        parts.append(checks.manifest(row))
        if checks.buildable(row).first().ok:
            box, system = m["bbox"], m["crs"]
    c, g, s = (ds.tables.get(t) for t in ("catchments", "graph", "snap"))
    for name, t in (("catchments", c), ("snap", s)):
        if t is not None:
            if second_layer:
                problems = [(f"schema.{name}.geo", "ERROR", "Schema", name, x) for x in footers.geo_problems(f"{path}/{FILES[name]}")]
                parts.append(D.literal(spark, problems) if problems else D.none(spark))
            parts.append(checks.row_groups(footers.row_groups(spark, [f"{path}/{FILES[name]}"]), name))
    if c is not None:
        required = {"id": ["id"], "area_km2": ["area_km2"], "bbox": list(BOX), "geometry": ["geometry"]}
        rules = checks.null_rules("catchments", required) + checks.id_rules("catchment") + checks.measure_rules("area_km2", "ids.catchment_area") + checks.box_rules("catchment", True)
        parts += [D.each(c, rules, "catchments", checks.ROW), checks.duplicates(c, "catchments", "catchment"), checks.geometry(checks.exact_sample(c, sample_pct), "catchments", "catchment", (3, 6))]
        if m and m["has_up_area"]:
            parts.append(checks.up_area(c, True))
        if m and m["bbox"] and len(m["bbox"]) == 4:
            parts.append(checks.enclosure(checks.union_box(c).withColumn("bbox", F.array(*[F.lit(x) for x in m["bbox"]]))))
        if m and m["atom_count"] is not None:
            parts.append(checks.atom_count(c.agg(F.count(F.lit(1)).alias("n")).withColumn("declared", F.lit(m["atom_count"]))))
    if g is not None:
        rules = checks.null_rules("graph", {"id": ["id"], "upstream_ids": ["upstream_ids"]}) + checks.id_rules("graph")
        parts += [D.each(g, rules, "graph", checks.ROW), checks.duplicates(g, "graph", "graph"), checks.upstream_entries(g)]
        left = network.blocked(hierarchy.build(g))
        few = left.agg(F.count(F.lit(1)).alias("n")).join(left.orderBy("id").limit(10).agg(F.sort_array(F.collect_list("id")).alias("ids")))
        parts.append(D.where(few, F.col("n") > 0, "graph.cycle_detected", "GraphInvariant", "graph", F.format_string("%d atoms on or downstream of a cycle, among them %s", "n", F.array_join(F.col("ids").cast("array<string>"), ", "))))
    if c is not None and g is not None:
        refs = g.select("_row", F.explode("upstream_ids").alias("ref"))
        parts += [checks.coverage(c, g), checks.dangling(refs, c, "referential.upstream_not_in_catchments", "upstream id")]
    if s is not None:
        required = {"id": ["id"], "catchment_id": ["catchment_id"], "weight": ["weight"], "is_mainstem": ["is_mainstem"], "bbox": list(BOX), "geometry": ["geometry"]}
        rules = checks.null_rules("snap", required) + checks.snap_id_rules() + checks.measure_rules("weight", "ids.snap_weight") + checks.box_rules("snap", False)
        parts += [D.each(s, rules, "snap", checks.ROW), checks.duplicates(s, "snap", "snap"), checks.geometry(s, "snap", "snap", (1, 2))]
        if c is not None:
            parts.append(checks.dangling(s.select("_row", F.col("catchment_id").alias("ref")), c, "referential.snap_catchment_not_in_catchments", "catchment"))
    if ds.rasters is not None and not skip_rasters:
        parts.append(checks.raster(ds.rasters, box, system))
    d = D.cap(Workspace(spark, "findings").cut(D.union(parts)))
    return D.strict(d) if strict else d


def main(argv: list[str] | None = None) -> int:
    """Command line: validate a folder, print a report, 0 if valid."""
    import argparse

    a = argparse.ArgumentParser(prog="rillstone")
    a.add_argument("path")
    a.add_argument("--format", choices=("text", "json"), default="text")
    a.add_argument("--strict", action="store_true")
    a.add_argument("--skip-rasters", action="store_true")
    a.add_argument("--sample-pct", type=float, default=1.0)
    o = a.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    d = validate(spark, o.path, o.strict, o.skip_rasters, o.sample_pct).cache()
    print(D.as_json(d) if o.format == "json" else D.as_text(d))
    return 0 if D.counts(d).first().valid else 1


if __name__ == "__main__":
    raise SystemExit(main())
