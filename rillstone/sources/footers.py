"""What only a file's footer tells: declared types and nullability, row groups, statistics. No data pages are read."""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from rillstone.sources.arrow_ipc import _filesystem
from rillstone.sources.schemas import BOX, Column


def arrow_schema(path: str, kind: str) -> pa.Schema:
    fs, p = _filesystem(path)
    with fs.open_input_file(p) as f:
        return pa.ipc.open_file(f).schema if kind == "arrow" else pq.ParquetFile(f).schema_arrow


def schema_findings(schema: pa.Schema, contract: tuple[Column, ...], artifact: str) -> list[tuple]:
    """(check_id, severity, category, artifact, message): columns missing, of another type or nullability. Extra columns
    are allowed."""
    out = []
    for c in contract:
        k = schema.get_field_index(c.name)
        if k < 0:
            out.append(("schema.missing_column", "ERROR", "Schema", artifact, f"column {c.name} is missing"))
            continue
        f = schema.field(k)
        if pa.types.is_large_binary(f.type) and c.kind == "binary" or pa.types.is_large_list(f.type) and c.kind.startswith("list"):
            out.append(("schema.large_variant", "ERROR", "Schema", artifact, f"column {c.name} is {f.type}, not {c.kind}"))
        elif str(f.type) != c.kind:
            out.append(("schema.wrong_type", "ERROR", "Schema", artifact, f"column {c.name} is {f.type}, not {c.kind}"))
        elif f.nullable and not c.nullable:
            out.append(("schema.wrong_nullability", "ERROR", "Schema", artifact, f"column {c.name} may be null"))
        elif c.nullable and not f.nullable:
            out.append(("schema.wrong_nullability", "WARN", "Schema", artifact, f"column {c.name} is declared without nulls"))
    return out


def row_groups(spark: SparkSession, files: list[str], columns: tuple[str, ...] = BOX) -> DataFrame:
    """path, row_group, n_rows, has_stats (for all of columns), read from the footers by tasks, not by the driver."""

    def run(frames):
        for pdf in frames:
            rows = []
            for path in pdf["path"]:
                fs, p = _filesystem(path)
                with fs.open_input_file(p) as f:
                    meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    rg = meta.row_group(g)
                    have = {rg.column(k).path_in_schema for k in range(rg.num_columns) if rg.column(k).statistics is not None and rg.column(k).statistics.has_min_max}
                    rows.append((path, g, rg.num_rows, set(columns) <= have))
            yield pd.DataFrame(rows, columns=["path", "row_group", "n_rows", "has_stats"])

    df = spark.createDataFrame(pd.DataFrame({"path": files}, dtype="str"), "path string").repartition(max(1, min(len(files), 2000)))
    return df.mapInPandas(run, "path string, row_group int, n_rows long, has_stats boolean")


def geo_metadata(types: list[str], box: list[float] | None = None) -> bytes:
    """The `geo` entry of GeoParquet 1.1 for a WKB column `geometry`; no crs means longitude and latitude."""
    column: dict = {"encoding": "WKB", "geometry_types": sorted(types)}
    if box:
        column["bbox"] = box
    return json.dumps({"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column}}, sort_keys=True).encode()


def geo_problems(path: str) -> list[str]:
    """What keeps a file from being GeoParquet; empty if nothing does."""
    fs, p = _filesystem(path)
    with fs.open_input_file(p) as f:
        schema = pq.ParquetFile(f).schema_arrow
    raw = (schema.metadata or {}).get(b"geo")
    if raw is None:
        return ["no geo metadata"]
    try:
        geo = json.loads(raw)
    except ValueError:
        return ["geo metadata is no JSON"]
    out = [] if str(geo.get("version", "")).startswith("1.") else ["version is not 1.x"]
    primary = geo.get("primary_column")
    if primary not in geo.get("columns", {}):
        out.append("primary column is not described")
    elif primary not in schema.names:
        out.append("primary column is missing")
    elif geo["columns"][primary].get("encoding") != "WKB":
        out.append("encoding is not WKB")
    return out
