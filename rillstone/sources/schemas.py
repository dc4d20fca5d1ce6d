"""Column contracts of the dataset's tables and of the diagnostics table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    kind: str  # as pyarrow prints the type
    nullable: bool


_BOX = tuple(Column(f"bbox_{x}", "float", False) for x in ("minx", "miny", "maxx", "maxy"))
CATCHMENTS = (Column("id", "int64", False), Column("area_km2", "float", False), Column("up_area_km2", "float", True), *_BOX, Column("geometry", "binary", False))
GRAPH = (Column("id", "int64", False), Column("upstream_ids", "list<item: int64>", False))
SNAP = (Column("id", "int64", False), Column("catchment_id", "int64", False), Column("weight", "float", False), Column("is_mainstem", "bool", False), *_BOX, Column("geometry", "binary", False))
TABLES = {"catchments": CATCHMENTS, "graph": GRAPH, "snap": SNAP}
#: The files of a dataset.
FILES = {"manifest": "manifest.json", "catchments": "catchments.parquet", "graph": "graph.arrow", "snap": "snap.parquet", "flow_dir": "flow_dir.tif", "flow_acc": "flow_acc.tif"}
BOX = tuple(c.name for c in _BOX)

MANIFEST = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("format_version", "fabric_name", "fabric_version")]
    + [T.StructField("fabric_level", T.LongType()), T.StructField("crs", T.StringType())]
    + [T.StructField(n, T.BooleanType()) for n in ("has_up_area", "has_rasters", "has_snap")]
    + [T.StructField("flow_dir_encoding", T.StringType()), T.StructField("terminal_sink_id", T.LongType()), T.StructField("topology", T.StringType()), T.StructField("region", T.StringType())]
    + [T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("atom_count", T.LongType()), T.StructField("created_at", T.StringType()), T.StructField("adapter_version", T.StringType())]
)

#: Every check yields these. row: the place in the file (null if there is none); sub orders findings of one row.
DIAGNOSTIC = "check_id string, severity string, category string, artifact string, row long, sub int, message string"
